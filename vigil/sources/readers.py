"""Readers of log shapes: each takes a path or a table of lines and returns rows of an explicit schema.

Lines are read by Spark's text source and parsed by native expressions; nothing is inferred from the data.  A null line
gives no row.  State that runs along a file (headers, record numbers) is a window over that file's lines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import last_wins
from ..operators.joins import small
from ..operators.ordered import Ordered

Reader = Callable[[SparkSession, str], DataFrame]


def json_lines(spark: SparkSession, path: str, schema: str, *markers: str) -> DataFrame:
    """Rows of JSON lines; with markers, only of lines that hold one of them, tested before any line is parsed."""
    lines = spark.read.text(path)
    if markers:
        hit = F.lit(False)
        for m in markers:
            hit = hit | F.col("value").contains(m)
        lines = lines.where(hit)
    return lines.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")


def map_of_lists(spark: SparkSession, path: str, item: str) -> DataFrame:
    """(name, pos, fields of item) of JSON lines that map a name to a list of items."""
    maps = spark.read.text(path).select(F.explode(F.from_json("value", f"map<string, array<struct<{item}>>>")).alias("name", "items"))
    return maps.select("name", F.posexplode("items").alias("pos", "item")).select("name", "pos", "item.*")


def nested_list(spark: SparkSession, path: str, key: str, key_type: str, items: str) -> DataFrame:
    """(key, pos, item, reason) of JSON lines with a list of texts; a record whose list cannot be read is one row with a reason."""
    r = spark.read.text(path).select(F.from_json("value", f"{key} {key_type}, {items} string").alias("r")).select("r.*")
    parsed = r.select(key, F.from_json(items, "array<string>").alias("list"))
    rows = parsed.where("list is not null").select(key, F.posexplode("list").alias("pos", "item"), F.lit(None).cast("string").alias("reason"))
    bad = parsed.where("list is null").select(key, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("item"), F.lit("no list").alias("reason"))
    return rows.unionByName(bad)


def headed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of CSV files with a header and quoted line ends."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)


def csv_fields(text: Column) -> Column:
    """The fields of a CSV line; quoted ones may hold commas and doubled quotes.  Null where quotes do not match."""
    field = r'((?:"(?:[^"]|"")*+"|[^",]*+)),'
    parts = F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(field), F.lit(1))
    plain = F.transform(parts, lambda p: F.when(p.startswith('"'), F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"'))).otherwise(p))
    return F.when(F.length(F.array_join(parts, ",")) == F.length(text), plain)


def csv_sections(lines: DataFrame, file: str, line: str, text: str, is_header: Column) -> DataFrame:
    """(file, line, fields, reason) of joined exports: a header line names the columns until the next one.

    A line that has no header before it, another number of fields or quotes that do not match has null fields and a
    reason.  Header lines and null lines give no row.
    """
    along = Ordered(lines.withColumn("_header", is_header), [file], [line])
    named = along.last(along.rows, F.when(F.col("_header"), F.col(text)), "_names")
    cut = named.where(~F.col("_header") & F.col(text).isNotNull()).select(file, line, csv_fields(F.col("_names")).alias("_names"), csv_fields(F.col(text)).alias("_values"))
    reason = F.when(F.col("_names").isNull(), "no header").when(F.col("_values").isNull(), "open quotes").when(F.size("_names") != F.size("_values"), "other number of fields")
    return cut.select(file, line, F.when(reason.isNull(), last_wins(F.col("_names"), F.col("_values"))).alias("fields"), reason.alias("reason"))


def framed_records(lines: DataFrame, file: str, line: str, text: str, header: str) -> DataFrame:
    """(file, record, head, fields) of records that start with a line like `header` and go on with `Name: value` lines.

    Of a repeated name the last line counts.  Lines before the first header belong to no record.
    """
    along = Ordered(lines, [file], [line])
    starts = F.col(text).rlike(header)
    numbered = along.total(along.rows, starts.cast("long"), "record").where("record > 0")
    name, value = F.regexp_extract(text, r"^\s*([^:]+):\s*(.*)$", 1), F.regexp_extract(text, r"^\s*([^:]+):\s*(.*)$", 2)
    last = numbered.withColumns({"name": F.when(~starts, name), "v": value}).groupBy(file, "record", "name").agg(F.max_by("v", line).alias("v"), F.max(F.when(starts, F.col(text))).alias("head"))
    pairs = F.collect_list(F.when(F.col("name").isNotNull() & (F.col("name") != ""), F.struct("name", "v")))
    return last.groupBy(file, "record").agg(F.max("head").alias("head"), F.map_from_entries(pairs).alias("fields"))


def rotation_age(name: Column) -> Column:
    """The number of a rotated log: 0 for the log itself, and higher for older ones.  Null for a null name."""
    return F.when(name.isNotNull(), F.coalesce(F.regexp_extract(name, r"\.(\d+)$", 1).try_cast("bigint"), F.lit(0)))


def oldest_first(lines: DataFrame, log: str, file: str, line: str, name: str = "place") -> DataFrame:
    """lines with their place, from 1, along all files of a log, the oldest file first.

    Lines are numbered inside their file and moved on by the lines of older files, so no task holds a whole log.
    """
    aged = lines.withColumn("_age", rotation_age(F.col(file)))
    sizes = aged.groupBy(F.col(log).alias("_log"), F.col("_age").alias("_a")).agg(F.count("*").alias("_n"))
    older = Window.partitionBy("_log").orderBy(F.col("_a").desc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_log", "_a", F.coalesce(F.sum("_n").over(older), F.lit(0)).alias("_start"))
    inside = aged.withColumn(name, F.row_number().over(Window.partitionBy(log, "_age").orderBy(line)))
    moved = inside.join(small(starts), F.col(log).eqNullSafe(F.col("_log")) & F.col("_age").eqNullSafe(F.col("_a")))
    return moved.withColumn(name, F.col(name) + F.col("_start")).drop("_age", "_log", "_a", "_start")


def copy_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of tab-separated COPY text as strings, with `good` false for lines of another width.

    `\\N` is null; `\\t`, `\\n`, `\\r` and doubled backslashes are unescaped.
    """
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(parts.alias("p"), (F.size(parts) == len(columns)).alias("good"))
    return rows.select(*[_uncopy(F.when(F.col("good"), F.get("p", F.lit(i)))).alias(c) for i, c in enumerate(columns)], "good")


def _uncopy(value: Column) -> Column:
    plain = F.replace(value, F.lit("\\\\"), F.lit("\0"))
    for code, char in (("t", "\t"), ("n", "\n"), ("r", "\r")):
        plain = F.replace(plain, F.lit("\\" + code), F.lit(char))
    return F.when(value != "\\N", F.replace(plain, F.lit("\0"), F.lit("\\")))


def projected(df: DataFrame, schema: str) -> DataFrame:
    """df in the columns of a schema: columns it lacks are null, others go before the scan."""
    want = df.sparkSession.createDataFrame([], schema).schema
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])


def joined_objects(df: DataFrame, raw: str, schema: str) -> DataFrame:
    """df with pos and the fields of each of the JSON objects that stand back to back in `raw`; braces inside strings part nothing."""
    tokens = F.regexp_extract_all(raw, F.lit(r'"(?:\\.|[^"\\])*+"?|[^"]++'), F.lit(0))
    cut = F.transform(tokens, lambda x: F.when(x.startswith('"'), x).otherwise(F.regexp_replace(x, r"\}\s*\{", "}\0{")))
    objects = F.split(F.array_join(cut, ""), "\0")
    rows = df.select("*", F.posexplode(objects).alias("pos", "_object")).drop(raw)
    return rows.withColumn("_r", F.from_json("_object", schema)).drop("_object").select("*", "_r.*").drop("_r")


def by_shape(lines: DataFrame, text: str, shapes: list[tuple[str, str, dict[str, Column]]], file: str | None = None, line: str | None = None) -> DataFrame:
    """(shape, columns) of lines, each read as the first shape (name, pattern, columns) that it fits, in one pass over the lines.

    With file and line, the first line of a file that has a text tells the shape of the whole file.  Columns that a shape
    lacks are null; lines of no shape, and those of files without a text, give no row.
    """
    told = text
    if file is not None:
        first = lines.where(F.length(F.trim(text)) > 0).groupBy(F.col(file).alias("_file")).agg(F.min_by(text, line).alias("_told"))
        lines, told = lines.join(small(first), F.col(file).eqNullSafe(F.col("_file"))), "_told"
    shape = F.lit(None).cast("string")
    for name, pattern, _ in reversed(shapes):
        shape = F.when(F.col(told).rlike(pattern), name).otherwise(shape)
    routed = lines.withColumn("_shape", shape).where("_shape is not null")
    out = {}
    for name, _, columns in reversed(shapes):
        for c, value in columns.items():
            out[c] = F.when(F.col("_shape") == name, value).otherwise(out.get(c, F.lit(None)))
    return routed.select(F.col("_shape").alias("shape"), *[value.alias(c) for c, value in out.items()])


def tagged_union(spark: SparkSession, path: str, members: dict[str, str]) -> DataFrame:
    """Rows of JSON lines that hold one of several members, with `tag`; lines with none of them go.

    members: the fields of each member by its name.  Fields that a member lacks are null.
    """
    whole = ", ".join(f"{name} struct<{fields}>" for name, fields in members.items())
    r = spark.read.text(path).select(F.from_json("value", whole).alias("r")).select("r.*")
    out = None
    for name in members:
        rows = r.where(F.col(name).isNotNull()).select(F.lit(name).alias("tag"), f"{name}.*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


# The form of the events in exported logs.
XML_EVENT = (
    "System struct<Provider: struct<_Name: string>, TimeCreated: struct<_SystemTime: string>, Computer: string, Channel: string, EventID: string, EventRecordID: string>, "
    "EventData struct<Data: array<struct<_Name: string, _VALUE: string>>>, broken string"
)
XML_DATA = r"""<Data\b[^>]*?\bName=["']([^"'>]+)["'][^>]*>([^<]*(?:<(?!/Data>)[^<]*)*)</Data>"""
XML_SYSTEM = {"Computer": None, "Channel": None, "EventID": None, "EventRecordID": None, "Provider": "Name", "TimeCreated": "SystemTime"}


def xml_events(spark: SparkSession, path: str, *markers: str) -> DataFrame:
    """(raw, recovered, fields) of the <Event> elements of XML files: their named Data, and what the system says of them.

    Files are cut at the end of each event, so large ones are read by many tasks, and with markers only events that hold
    one of them are parsed.  Events that are no XML, say for a bare `&`, are recovered by the delimiters of their fields.
    Of a repeated name the last value counts; a Data element without text is empty.  Of an event that a file's end cuts
    off, what is there is read as the event, recovered where an element is open.
    """
    raw = F.concat(F.regexp_extract("value", r"(?s)<Event[\s>].*", 0), F.lit("</Event>"))
    rows = spark.read.option("lineSep", "</Event>").text(path).where(F.col("value").rlike(r"<Event[\s>]")).select(raw.alias("raw"))
    if markers:
        rows = rows.where(reduce(or_, [F.col("raw").contains(m) for m in markers]))
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = rows.withColumn("e", F.from_xml("raw", XML_EVENT, options)).withColumn("recovered", F.col("e").isNull() | F.col("e.broken").isNotNull())
    data = F.filter(F.coalesce("e.EventData.Data", F.array()), lambda d: d["_Name"].isNotNull())
    names, values = F.transform(data, lambda d: d["_Name"]), F.transform(data, lambda d: F.coalesce(d["_VALUE"], F.lit("")))
    found = [(F.lit(tag), F.col(f"e.System.{tag}" if attribute is None else f"e.System.{tag}._{attribute}")) for tag, attribute in XML_SYSTEM.items()]
    rough = [(F.lit(tag), F.regexp_extract("raw", rf"(?s)<{tag}[^>]*>(.*?)</{tag}>" if attribute is None else rf"""<{tag}\b[^>]*\b{attribute}=['"]([^'"]*)""", 1)) for tag, attribute in XML_SYSTEM.items()]
    loose = [F.regexp_extract_all("raw", F.lit(XML_DATA), F.lit(i)) for i in (1, 2)]
    whole = _present(F.concat(names, F.array(*[n for n, _ in found])), F.concat(values, F.array(*[v for _, v in found])))
    guess = _present(F.concat(loose[0], F.array(*[n for n, _ in rough])), F.transform(F.concat(loose[1], F.array(*[F.nullif(v, F.lit("")) for _, v in rough])), xml_text))
    return parsed.select("raw", "recovered", F.when(F.col("recovered"), guess).otherwise(whole).alias("fields"))


def _present(names: Column, values: Column) -> Column:
    """A map of the names that have a value."""
    return F.map_filter(last_wins(names, values), lambda _, v: v.isNotNull())


def xml_text(text: Column) -> Column:
    """text with the five entities of XML resolved."""
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{entity};"), F.lit(char))
    return text


def named_attributes(df: DataFrame, text: str) -> DataFrame:
    """df without `text`, one row for each name="value" pair in it, with pos; by pattern, so malformed markup is read too."""
    pattern = F.lit(r'([A-Za-z-]+)="([^"]*)"')
    names, values = (F.regexp_extract_all(text, pattern, F.lit(i)) for i in (1, 2))
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("name"), F.get(values, i).alias("value")))
    return df.withColumn("_pairs", pairs).drop(text).select("*", F.posexplode("_pairs").alias("pos", "_p")).select("*", "_p.*").drop("_pairs", "_p")


class Registry:
    """Readers by the name of their dataset."""

    def __init__(self):
        self.readers: dict[str, Reader] = {}

    def register(self, name: str) -> Callable[[Reader], Reader]:
        def put(reader: Reader) -> Reader:
            if name in self.readers:
                raise ValueError(f"a reader named {name} exists")
            self.readers[name] = reader
            return reader

        return put

    def read(self, spark: SparkSession, folder: str, *names: str) -> DataFrame:
        """The rows of the named readers, or of all of them, in one table with `dataset`."""
        out = None
        for name in names or sorted(self.readers):
            rows = self.readers[name](spark, folder).withColumn("dataset", F.lit(name))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        if out is None:
            raise ValueError("no reader is registered")
        return out
