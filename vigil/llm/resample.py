"""Importance resampling towards a target distribution.

Words and runs of words are hashed into buckets.  A bucket's gain is the log ratio of its share among the target's
features and among all features of the corpus; a document's weight is the mean gain of its features, and a Gumbel draw
on top makes the highest scores a sample without replacement.

Hashes are CRC-32, which is linear but for its length: each byte contributes a word that depends on the byte and on its
distance from the end.  Tables give these words, `bitwise_xor.reduceat` adds them over the spans of all features of a batch
at once, and a constant for the length completes them.  Long spans are cut into blocks whose sums are moved to their
distance by tables of zero bytes.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh, staged, without
from ._text import batches_by_bytes

#: Bytes of a block, the distances that the position table covers.
BLOCK = 32
#: Bytes of texts taken together, and bytes of features hashed together.
BATCH_BYTES, HASH_BYTES = 2_000_000, 1_000_000
#: A place between words, where a long text may be cut when features are single words.
GAP = regex.compile("[\\x00-\\x2f]")
_POLY = 0xEDB88320


@functools.cache
def position_table() -> np.ndarray:
    """[distance from the end, byte] -> what that byte contributes, for distances below BLOCK."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLY), t >> 1).astype(np.uint32)
    rows = [t]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> 8) ^ t[rows[-1] & 255])
    return np.array(rows)


@functools.cache
def zeros_table(power: int) -> np.ndarray:
    """[byte of the register, its value] -> the register after 2**power zero bytes."""
    if power == 0:
        t = position_table()[0]
        return np.array([(v >> 8) ^ t[v & 255] for v in (np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4))])
    return np.array([after_zeros_once(row, power - 1) for row in zeros_table(power - 1)])


def after_zeros_once(values: np.ndarray, power: int) -> np.ndarray:
    t = zeros_table(power)
    return t[0][values & 255] ^ t[1][(values >> 8) & 255] ^ t[2][(values >> 16) & 255] ^ t[3][values >> 24]


def after_zeros(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each register after its own number of zero bytes, by the bits of that number."""
    values, power = values.copy(), 0
    while len(counts) and int(counts.max()) >> power:
        some = np.flatnonzero((counts >> power) & 1)
        values[some] = after_zeros_once(values[some], power)
        power += 1
    return values


@functools.cache
def short_constants() -> np.ndarray:
    return length_constants(np.arange(1024))


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of as many zero bytes."""
    return after_zeros(np.full(len(lengths), 0xFFFFFFFF, np.uint32), lengths) ^ np.uint32(0xFFFFFFFF)


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of data[start:end] for each span; spans may overlap and may be empty."""
    lengths = ends - starts
    blocks = -(-lengths // BLOCK)
    span = np.repeat(np.arange(len(starts)), blocks)
    behind = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))  # blocks between this one and the span's end
    high = ends[span] - behind * BLOCK
    low = np.maximum(high - BLOCK, starts[span])
    sums, table = np.zeros(len(span), np.uint32), position_table().ravel()
    edges = np.r_[0, np.cumsum(high - low)]
    for a in range(0, len(span), step := max(1, HASH_BYTES // BLOCK)):
        b = min(a + step, len(span))
        at = edges[a : b + 1] - edges[a]
        size = np.diff(at)
        index = np.arange(at[-1]) + np.repeat(low[a:b] - at[:-1], size)
        distance = np.repeat(high[a:b], size) - 1 - index
        sums[a:b] = np.bitwise_xor.reduceat(table[distance * 256 + data[index]], at[:-1])
    far = np.flatnonzero(behind)
    sums[far] = after_zeros(sums[far], behind[far] * BLOCK)
    out = np.zeros(len(starts), np.uint32)
    full = np.flatnonzero(blocks)
    if len(full):
        out[full] = np.bitwise_xor.reduceat(sums, (np.cumsum(blocks) - blocks)[full])
    short, constants = lengths < 1024, np.zeros(len(lengths), np.uint32)
    constants[short] = short_constants()[lengths[short]]
    constants[~short] = length_constants(lengths[~short])
    return out ^ constants


#: A-Z in lower case; the bytes of words: digits, small letters, and all of characters beyond ASCII.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def features(texts: list[str], orders: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of each text, and for each feature its text and its bucket)."""
    flat = LOWER[np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)]
    ends_of_texts = np.cumsum([len(t) + 1 if t.isascii() else len(t.encode()) + 1 for t in texts])
    inside = WORD[flat]
    after = np.r_[False, inside[:-1]] & ~inside  # the place behind each word, where one space goes
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    sizes = np.flatnonzero(after) - starts
    text = np.searchsorted(ends_of_texts, starts, "right")
    flat[after] = 32
    words = flat[inside | after]
    starts = np.cumsum(sizes + 1) - sizes - 1
    of, bucket = [], []
    for k in range(orders[0], orders[1] + 1):
        first = np.arange(max(0, len(starts) - k + 1))
        first = first[text[first] == text[first + k - 1]]
        of.append(text[first])
        bucket.append(crc32_spans(words, starts[first], starts[first + k - 1] + sizes[first + k - 1]) % np.uint32(buckets))
    return np.bincount(text, minlength=len(texts)), np.concatenate(of), np.concatenate(bucket).astype(np.int64)


def parts_of(column: pa.Array, orders: tuple[int, int]):
    """(number of the row, text) in lists of about BATCH_BYTES; long texts in pieces where no feature can reach over a cut."""
    return batches_by_bytes([t or "" for t in column.to_pylist()], BATCH_BYTES, BATCH_BYTES, GAP if orders[1] == 1 else None)


def bucket_counts(df: DataFrame, text_col: str, orders: tuple[int, int], buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: added up in tasks first, so no more than `buckets` rows leave a task or reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in parts_of(b.column(0), orders):
                total += np.bincount(features([t for _, t in part], orders, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, floored; one is added to every count."""
    b, s, t = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in zip(source.tolist(), target.tolist())], np.int64)


def weigh(df: DataFrame, gains: np.ndarray, text_col: str, orders: tuple[int, int]) -> DataFrame:
    """df without text_col, with n_words, n_features and weight: the floored mean gain of the text's features, 0 without any."""
    rest = df.drop(text_col)
    schema, names = rest.schema, rest.columns
    for c in ("n_words", "n_features", "weight"):
        schema = schema.add(c, "long")
    new = schema.names

    def run(batches):
        for b in batches:
            words, n, total = (np.zeros(len(b), np.int64) for _ in range(3))
            for part in parts_of(b.column(text_col), orders):
                at = np.array([i for i, _ in part])
                n_words, of, bucket = features([t for _, t in part], orders, len(gains))
                np.add.at(words, at, n_words)
                np.add.at(n, at, np.bincount(of, minlength=len(at)))
                np.add.at(total, at[of], gains[bucket])
            columns = [b.column(c) for c in names] + [pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=new)

    return df.mapInArrow(run, schema)


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", orders: tuple[int, int] = (1, 1), buckets: int = 10_000, rate: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """df without its texts, with n_words, n_features, weight, score and rank: 1, 2, 3... of those drawn, else null.

    Features are runs of orders[0] to orders[1] words, repeats counted.  `rate` per cent of the documents that have
    min_words words are drawn, by the highest scores, ties to the smaller id, null ids last; rows of one id and score are
    put in any order.  Null and empty texts have no words and weight 0.  Texts are used whole.  Without a target, or with
    an empty one, all its counts are 0.  Columns named as the new ones are replaced; an empty table gives an empty result.
    Texts are read twice, once for the counts and once for the weights; only the counts' `buckets` numbers, a number
    for each score, and the size of each range of ranks go through the driver.
    """
    spark = df.sparkSession
    df = without(df, *({"n_words", "n_features", "weight", "score", "rank"} - {id_col.lower(), text_col.lower()}))
    gains = gains_of(bucket_counts(df, text_col, orders, buckets), bucket_counts(target, target_col, orders, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = staged(weigh(df, gains, text_col, orders).withColumn("score", F.col("weight") + gumbel), "scores")
    able = F.col("n_words") >= min_words
    # scores are whole numbers in a range that the gains bound, so there are few of them at any size
    by_score = sorted(map(tuple, scored.where(able).groupBy("score").count().collect()), reverse=True)
    draw, cutoff, seen = rate * sum(n for _, n in by_score) // 100, None, 0
    for score, n in by_score:
        if seen >= draw:
            break
        cutoff, seen = score, seen + n
    if cutoff is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = able & (F.col("score") >= cutoff)
    order = [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_last()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place, at, part, before = fresh(scored.columns, "place", "at", "part", "before")
    # the place in the table as a last key, so that a repeated row can be dealt to several ranges
    ranges = scored.where(near).withColumn(place, F.monotonically_increasing_id()).repartitionByRange(parts, *order, F.col(place)).sortWithinPartitions(*order, place).drop(place)
    dealt = staged(ranges.withColumn(at, F.monotonically_increasing_id()), "ranks").withColumn(part, F.shiftright(at, 33))
    sizes, starts, total = dict(map(tuple, dealt.groupBy(part).count().collect())), [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    offsets = F.broadcast(spark.createDataFrame(starts, f"{part} long, {before} long"))  # a row for each range
    rank = F.col(before) + F.col(at).bitwiseAND((1 << 33) - 1) + 1
    ranked = dealt.join(offsets, part).withColumn("rank", F.when(rank <= draw, rank)).drop(part, before, at)
    rest = scored.where(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return rest.unionByName(ranked)
