"""WARC archives and their capture index.

Pages are written as WARC 1.1 records by Spark's text writer (a record is UTF-8 text, and the line separator is the two
empty lines that end a record), and read back by their Content-Length.  Each archive gives one locally sorted run of
capture entries; the runs are stored, exchanged by key range, and merged by a loser tree into capture histories in the
global order of URL key and timestamp.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import shared_path, staged

END = "\r\n\r\n"
#: Payloads from this size on are stored once; the others of equal payload become revisit records.
LEAST_REVISIT = 1000
#: Bytes after which an archive is full (a reading task holds one archive's bytes); entries that one merging task holds.
ARCHIVE_BYTES, MERGE_ENTRIES = 32_000_000, 200_000
#: Bytes of a record beside its payload and URL, about.
HEAD_BYTES = 600
INDEX_SCHEMA = (
    "url_key string, ts string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "url string, archive string, offset bigint, length bigint"
)


# --- writing ---------------------------------------------------------------------------------------------------------
def plan_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages as captures: page_id, url, payload, payload_bytes, sha1, record_type, refers_to.

    Of equal payloads of LEAST_REVISIT bytes or more, that of the largest page_id is the response and the others revisit
    it.  A null html is the empty payload.  A row with a null page_id is a response, as nothing could name it; rows that
    repeat the largest page_id are all responses.  Only digests and ids are grouped; payloads move once, to their
    archives' partitions.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1(F.encode("payload", "UTF-8")))
    heads = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("sha1").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    old = F.col("head").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") < F.col("head"))
    return rows.join(heads, "sha1", "left").select(
        "page_id", "url", F.when(old, F.lit("")).otherwise(F.col("payload")).alias("payload"), "payload_bytes", "sha1",
        F.when(old, "revisit").otherwise("response").alias("record_type"), F.when(old, F.col("head")).alias("refers_to"),
    )


def _header_safe(c: Column) -> Column:
    """A URL for a header line: control characters, spaces and per cent signs before them are per-cent encoded by the reader's rule."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "%", "%25"), "\r", "%0D"), "\n", "%0A")


def _plain_url(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def records(captures: DataFrame, *others: str) -> DataFrame:
    """`record`: each capture as the text of a WARC record without its final two empty lines; and the other columns.

    The block is an HTTP response; a revisit's block has its headers only, with the Content-Length of the payload it
    stands for.  Captures without a date get one second for each page_id from 2024-01-01T00:00:00Z on.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    digest = F.col("sha1")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.col("page_id"), F.lit(0)) % 3_000_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        F.coalesce(line("WARC-Record-ID", name(F.col("page_id"))), F.lit("WARC-Record-ID: <urn:page:none>\r\n")),
        line("WARC-Date", date), F.coalesce(line("WARC-Target-URI", _header_safe(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.coalesce(F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("WARC-Refers-To", name(F.col("refers_to")))), F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", (F.octet_length(http) + F.octet_length("payload")).cast("string")), F.lit("\r\n"),
    )
    return captures.select(*others, F.concat(head, http, F.col("payload")).alias("record"))


def write_archives(captures: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes the records under path as gzip files of archive_bytes (unpacked) and one record at most.

    A running sum of sizes along each partition says which of its archives a record goes to; payloads stay in the JVM.
    """

    @F.pandas_udf("long")
    def archive(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before = 0
        for s in sizes:
            ends = before + s.cumsum()
            yield (ends - s) // archive_bytes
            before = int(ends.iloc[-1]) if len(s) else before

    size = F.octet_length("payload") + F.coalesce(F.octet_length("url"), F.lit(0)) + F.lit(HEAD_BYTES).cast("long")
    records(captures.withColumn("archive", archive(size)), "archive").write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)


# --- reading ---------------------------------------------------------------------------------------------------------
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)


def unpacked(content: bytes) -> bytes:
    """The archive's own bytes; offsets in the index refer to them."""
    return gzip.decompress(content) if content.startswith(b"\x1f\x8b") else content


def parse_archive(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an uncompressed archive; headers have lower-case names.

    A record without a length or cut short raises ValueError: a damaged archive is not skipped in silence.
    """
    at = 0
    while at < len(content):
        head_end = content.find(b"\r\n\r\n", at)
        m = _LENGTH.search(content, at, head_end + 2) if head_end > 0 and content.startswith(b"WARC/", at) else None
        if m is None:
            raise ValueError(f"no WARC record at byte {at}")
        start = head_end + 4
        end = start + int(m[1])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        headers = dict(line.split(": ", 1) for line in content[at:head_end].decode().split("\r\n")[1:])
        yield at, end + 4 - at, {k.lower(): v for k, v in headers.items()}, content[start:end]
        at = end + 4


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, lower case, without scheme and leading www; then path and query."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0]
    m = re.match(r"([^/?]*)(.*)", rest, re.S)
    labels = m[1].lower().split(".")
    if labels[0] == "www":
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")" + (m[2] or "/")


def capture_entry(archive: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
    """An entry in the columns of INDEX_SCHEMA.  Digest and size of a response are those of the payload itself."""
    page = headers["warc-record-id"][len("<urn:page:") : -1]
    kind = headers["warc-type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        size, digest = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1]), headers["warc-payload-digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    refers = headers["warc-refers-to"][len("<urn:page:") : -1] if "warc-refers-to" in headers else None
    url = _plain_url(headers["warc-target-uri"]) if "warc-target-uri" in headers else None
    return url_key(url), headers["warc-date"], None if page == "none" else int(page), kind, None if refers is None else int(refers), size, digest, url, archive, offset, length


def _order(entry: tuple) -> tuple:
    """URL key, timestamp, then page_id (null first), archive and offset, so that the order is total."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[8], entry[9]


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """The capture entries of the archives under path; those of one archive are a run, sorted by URL key and timestamp."""
    schema = T.StructType([*T._parse_datatype_string(INDEX_SCHEMA).fields, T.StructField("place", T.LongType())])

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                entries = sorted((capture_entry(name, *r) for r in parse_archive(unpacked(content.as_py()))), key=_order)
                for at in range(0, len(entries), 10_000):
                    yield _batch(entries[at : at + 10_000], at, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


class LoserTree:
    """Merges k sorted runs: the root holds the least head, and each inner node the loser of the match played there."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(self.runs))
        self.heads = [self._next(i) for i in range(len(self.runs))] or [None]
        self.nodes = [0] * self.k
        winners = {self.k + i: i for i in range(self.k)}
        for at in range(self.k - 1, 0, -1):
            a, b = winners[2 * at], winners[2 * at + 1]
            winners[at], self.nodes[at] = (a, b) if self._before(a, b) else (b, a)
        self.nodes[0] = winners[1] if self.k > 1 else 0

    def _next(self, i: int):
        x = next(self.runs[i], None)
        return None if x is None else (self.key(x), i, x)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def __iter__(self):
        while (head := self.heads[w := self.nodes[0]]) is not None:
            yield head[2]
            self.heads[w] = self._next(w)
            at = (w + self.k) // 2
            while at > 0:
                if self._before(self.nodes[at], w):
                    w, self.nodes[at] = self.nodes[at], w
                at //= 2
            self.nodes[0] = w


def merge_runs(runs: DataFrame, merge_entries: int = MERGE_ENTRIES) -> DataFrame:
    """Capture histories in global order: partition after partition, and inside each by URL key, timestamp and page_id.

    runs: as index_runs gives them, read twice (staged runs save parsing the archives again).  Ranges are cut on the whole
    sort key, so a URL key with many captures spreads over tasks, and into as many as keep a task's runs near
    merge_entries entries (about 1 kB each); those of its range are all that a task holds.  Column `seq` numbers the entries of a partition.
    """
    spark = runs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // merge_entries))
    key = [F.col("url_key"), F.col("ts"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("offset")]
    out = T.StructType([*[f for f in runs.schema.fields if f.name != "place"], T.StructField("seq", T.LongType())])

    def run(batches):
        names, parts = [f.name for f in out.fields][:-1], {}
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in names)):
                parts.setdefault(row[8], []).append(row)
        merged = LoserTree([parts[a] for a in sorted(parts)], _order)
        part, at = [], 0
        for entry in merged:
            part.append(entry)
            if len(part) == 10_000:
                yield _batch(part, at, out)
                part, at = [], at + len(part)
        if part:
            yield _batch(part, at, out)

    # rows of a run arrive in the run's own order, as sorting by (archive, place) puts them
    return runs.repartitionByRange(n, *key).sortWithinPartitions("archive", "place").mapInArrow(run, out)


def _batch(entries: list[tuple], at: int, schema: T.StructType) -> pa.RecordBatch:
    columns = [*zip(*entries), range(at, at + len(entries))]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for c, f in zip(columns, schema.fields)], names=[f.name for f in schema.fields])


def archive_pages(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Writes pages as WARC archives under path (default: a new place in the shared folder), reads them back and returns
    the merged capture histories, in the columns of INDEX_SCHEMA and seq.

    Nulls: see plan_captures; a null URL has the key `)/`.  Repeated rows become records of their own.  Extra columns are
    left out.  An empty table gives archives without records and an empty result.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(plan_captures(pages, **columns), path)
    return merge_runs(staged(index_runs(spark, path), "capture-runs"))
