"""MinHash near-duplicates by bottom-k sketches.

One 64-bit hash function orders the shingles of every document; the k smallest values are its sketch.
  1. Documents with equal shingle sets become one class.
  2. Inverted lists of retained values give candidates.  A pair that reaches the threshold shares many of its smallest
     values, so it also shares one of the rarer ones: a document joins only the lists of its rarest retained values
     (prefix filter), and passages that very many documents share drop out by themselves.
  3. Short lists give their pairs at once.  A long list is dealt into blocks of documents, and a task compares a block in
     memory; it passes on a spanning forest of the similar ones, never all pairs.  Of a list of several blocks, one
     document of each part that is connected by then is compared with those of other parts, level by level; only members
     that still lie apart from the list's largest part meet the other blocks, two at a time.
  4. The union sketch of two documents estimates their similarity and drops the rest.  Components of what is left are
     the candidate groups.
  5. In each candidate group, exact Jaccard on full sets decides; a spanning forest of the confirmed links gives the
     components.  A group of one block is compared as a whole.  A larger one is first settled inside its blocks, then by
     its candidate links; what then still lies apart is compared with everything outside its own component, two
     blocks at a time, so a group that settles moves each of its sets a few times only.

Nothing is capped.  What the sketches may miss is a pair at the threshold whose overlap falls short of MISS, the
probability that the limits are computed for.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import ASCII_LOWER, ASCII_UPPER, cut, release, staged, with_filter
from .components import connected_components

WORDS = 5
#: Retained values of a sketch; how many of them make inverted lists.
SKETCH, LISTED = 128, 32
#: Chance that a pair exactly at the threshold has fewer common values than is asked for.
MISS = 1e-7
#: Members of a list whose pairs are made at once; documents and shingles of a block; pairs estimated, and documents read, at a time.
SHORT, BLOCK, BLOCK_SHINGLES, PAIRS, TEXTS = 32, 1024, 2_000_000, 1000, 1000
#: Bytes of full sets whose pairs are counted together.
PAIR_BYTES = 4_000_000
#: Documents from which on a confirmed part of a large group is joined to others by their candidate links first.
PART = 4
_WORD = regex.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    x = (x ^ (x >> np.uint64(29))) * _P
    return x ^ (x >> np.uint64(32))


@functools.lru_cache(maxsize=100_000)
def _word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; with fewer than `width` words, of the whole sequence."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    n = min(width, len(words))
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = _mix(out * _P + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def fewest_common(k: int, threshold: float, miss: float = MISS) -> int:
    """The largest c such that fewer than c of k draws succeed with a chance of `miss` at most."""
    below = 0.0
    for c in range(k + 1):
        below += math.comb(k, c) * threshold**c * (1 - threshold) ** (k - c)
        if below > miss:
            return max(1, c)
    return k


def sketches(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, digest, sketch): number of shingles, digest of the full set (null if empty), packed bottom-k values."""

    def run(batches):
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            sets = [shingles(t, width) for t in b.column(1).to_pylist()]
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary())],
                names=["id", "n", "digest", "sketch"],
            )

    return df.select(id_col, text_col).mapInArrow(run, "id bigint, n bigint, digest binary, sketch binary")


def _values(sketch: DataFrame) -> DataFrame:
    """(id, k, n, v): a row for each of the LISTED smallest values."""

    def run(batches):
        for b in batches:
            values = [np.frombuffer(s, np.int64)[:LISTED] for s in b.column(3).to_pylist()]
            sizes = [len(v) for v in values]
            take = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))], names=["id", "k", "n", "v"])

    return sketch.select("id", "k", "n", "sketch").mapInArrow(run, "id bigint, k int, n bigint, v bigint")


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """How many values each set on the left shares with each on the right: products of incidence matrices, some columns at a time."""
    sets, n = left + right, len(left)
    owner = np.repeat(np.arange(len(sets)), np.fromiter(map(len, sets), np.int64, len(sets)))
    at = np.unique(np.concatenate(sets), return_inverse=True)[1]
    in_left, in_right = np.bincount(at[owner < n], minlength=at.max(initial=0) + 1) > 0, np.bincount(at[owner >= n], minlength=at.max(initial=0) + 1) > 0
    number = np.cumsum(in_left & in_right) - 1
    keep = (in_left & in_right)[at]
    owner, at = owner[keep], number[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((n, len(right)), np.float32)
    for low in range(0, int(at.max(initial=-1)) + 1, columns):
        here = slice(*np.searchsorted(at, [low, low + columns]))
        x = np.zeros((len(sets), columns), np.float32)
        x[owner[here], at[here] - low] = 1
        out += x[:n] @ x[n:].T
    return np.rint(out).astype(np.int64)


def estimated(left: list[np.ndarray], right: list[np.ndarray], n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard of each pair, estimated from the bottom values of the union of two sketches; exact if both hold their full sets.

    Of a sketch that was cut off nothing is known above its largest value, so values count up to the lower of both limits.
    """
    limit = lambda sets, n: np.array([s[-1] if k > len(s) else np.uint64(2**64 - 1) for s, k in zip(sets, n.tolist())], np.uint64)
    below = lambda sets, limits: np.array([np.searchsorted(s, limits, "right") for s in sets])
    if not left or not right:
        return np.zeros((len(left), len(right)))
    common = common_counts(left, right)
    return common / np.maximum(1, below(left, limit(right, n_right)) + below(right, limit(left, n_left)).T - common)


def pair_estimates(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """estimated() for pairs of packed sketches, one from each list, all at once."""
    size_a, size_b = (np.fromiter(map(len, x), np.int64, len(x)) // 8 for x in (a, b))
    limits = [np.where(n > size, np.array([int.from_bytes(s[-8:], "little") for s in x], np.uint64), np.uint64(2**64 - 1)) for x, n, size in ((a, n_a, size_a), (b, n_b, size_b))]
    values = np.frombuffer(b"".join(a) + b"".join(b), np.uint64)
    pair = np.r_[np.repeat(np.arange(len(a)), size_a), np.repeat(np.arange(len(b)), size_b)]
    keep = values <= np.minimum(*limits)[pair]
    values, pair = values[keep], pair[keep]
    order = np.lexsort((values, pair))
    values, pair = values[order], pair[order]
    same = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
    common = np.bincount(pair[1:][same], minlength=len(a))
    return common / np.maximum(1, np.bincount(pair, minlength=len(a)) - common)


def common_of_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """How many values each packed set of one list shares with its partner in the other, all pairs at once."""
    sizes = np.fromiter((len(x) // 8 for x in a + b), np.int64, 2 * len(a))
    values, pair = np.frombuffer(b"".join(a + b), np.uint64), np.repeat(np.r_[np.arange(len(a)), np.arange(len(a))], sizes)
    order = np.lexsort((values, pair))
    values, pair = values[order], pair[order]
    return np.bincount(pair[1:][(values[1:] == values[:-1]) & (pair[1:] == pair[:-1])], minlength=len(a))


def spanning(linked: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """(row, column) links of a spanning forest of a boolean link matrix; same: rows and columns are the same documents."""
    rows, columns = linked.shape
    seen_row, seen_column, out = np.zeros(rows, bool), np.zeros(columns, bool), []
    for first in np.argsort(-linked.sum(1), kind="stable").tolist():
        if seen_row[first]:
            continue
        seen_row[first] = True
        if same:
            seen_column[first] = True
        waiting = [(first, True)]
        while waiting:
            i, is_row = waiting.pop()
            line, seen = (linked[i], seen_column) if is_row else (linked[:, i], seen_row)
            for j in np.flatnonzero(line & ~seen).tolist():
                seen[j] = True
                out.append((i, j) if is_row else (j, i))
                if same:
                    waiting.append((j, True))
                else:
                    waiting.append((j, not is_row))
    return out


def _sides(rows: list, side_at: int) -> tuple[list, list, bool]:
    """The rows of the two blocks of a key; one block stands on both sides."""
    left = [r for r in rows if not r[side_at]]
    right = [r for r in rows if r[side_at]]
    return (left, right, False) if right else (left, left, True)


def _forest_batches(batches, columns: list[str], links_of):
    """Rows come sorted by `key`; links_of(rows of one key) gives (id, id) pairs.  Holds one key's rows at a time."""
    now, rows = None, []

    def batch(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    for b in batches:
        for key, *row in zip(b.column("key").to_pylist(), *(b.column(c).to_pylist() for c in columns)):
            if key != now:
                if len(rows) > 1:
                    yield batch(links_of(rows))
                now, rows = key, []
            rows.append(row)
    if len(rows) > 1:
        yield batch(links_of(rows))


def _dealt(members: DataFrame, group: str, own: str, meets: str) -> DataFrame:
    """members of block `own` of a group, dealt to the pairs with blocks 0 to meets - 1.

    `key` names (group, i, j) with i <= j, `side` the block in it (0: i, 1: j); a block with itself has side 0 only.
    """
    rows = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(meets) - 1)))
    low, high = F.least(own, "other"), F.greatest(own, "other")
    return rows.withColumn("key", F.concat_ws("/", F.col(group), low, high)).withColumn("side", ((F.col(own) == high) & (low != high)).cast("int")).drop("other")


def _block(id_col: str, blocks: str):
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.col(blocks))


def candidate_links(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links of classes (id, k, n, sketch) that may reach the threshold: each pair that does is connected by them.

    k tells classes of one id apart; their links are links of the id.
    """
    listed_least = fewest_common(LISTED, threshold)
    # a set is whole in its listed values if its partners' must be too; the threshold itself holds for them
    whole = F.col("n") <= math.floor(LISTED * threshold)
    have = F.least("n", F.lit(LISTED))
    least = F.when(whole, F.ceil(have * threshold - 1e-9)).otherwise(F.ceil(have * listed_least / LISTED - 1e-9))
    values = _values(classes)
    often = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = values.join(often, "v")
    rarest = Window.partitionBy("id", "k").orderBy("df", "v")
    per_class = Window.partitionBy("id", "k")
    lists = cut(
        shared.withColumn("place", F.row_number().over(rarest)).withColumn("common", F.count("*").over(per_class))
        # values that no other document has come before all others in the order by frequency
        .where(F.col("place") + have - F.col("common") <= have - least + 1)
        .select("id", "k", "n", "v", "df")
    )
    release(classes.sparkSession)
    near_size = (F.col("b.n") >= F.col("a.n") * threshold - 1e-9) & (F.col("a.n") >= F.col("b.n") * threshold - 1e-9)
    short = lists.where(F.col("df") <= SHORT).select("id", "n", "v")
    pairs = cut(short.alias("a").join(short.alias("b"), (F.col("a.v") == F.col("b.v")) & (F.col("a.id") < F.col("b.id")) & near_size).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
    sk = classes.select("id", "k", "n", "sketch")
    # sketches are most of what this step shuffles; most of them are in no pair
    ends = [with_filter(sk, "id", pairs.select(x), "_asked").where("_asked") for x in "ab"]
    one, two = (s.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for s, x in zip(ends, "ab"))
    cutoff = fewest_common(SKETCH, threshold) / SKETCH

    def may_reach(est: np.ndarray, small: np.ndarray, large: np.ndarray) -> np.ndarray:
        return (est >= np.where(large <= SKETCH, threshold, cutoff) - 1e-9) & (small >= threshold * large - 1e-9)

    def near(left: list, right: list) -> np.ndarray:
        """Which of left (n, packed sketch) may reach the threshold with which of right."""
        n, m = np.array([r[0] for r in left]), np.array([r[0] for r in right])
        est = estimated([np.frombuffer(r[1], np.uint64) for r in left], [np.frombuffer(r[1], np.uint64) for r in right], n, m)
        return may_reach(est, np.minimum.outer(n, m), np.maximum.outer(n, m))

    def passed(batches):
        for b in batches:
            for at in range(0, len(b), PAIRS):
                part = b.slice(at, PAIRS)
                n, m = (part.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
                est = pair_estimates(part.column("s_a").to_pylist(), part.column("s_b").to_pylist(), n, m)
                yield part.select(["a", "b"]).filter(pa.array(may_reach(est, np.minimum(n, m), np.maximum(n, m))))

    few = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(passed, "a bigint, b bigint")

    def links_of(rows):
        left, right, same = _sides(rows, 3)
        if not left or not right:
            return []
        linked = near([r[1:3] for r in left], [r[1:3] for r in right])
        return [(left[i][0], right[j][0]) for i, j in spanning(linked, same) if left[i][0] != right[j][0]]

    def compared(dealt: DataFrame) -> DataFrame:
        """Links inside each key of dealt (key, side, id, k)."""
        rows = dealt.select("key", "side", "id", "k").join(sk, ["id", "k"]).repartition("key").sortWithinPartitions("key", "id")
        return rows.select("key", "id", "n", "sketch", "side").mapInArrow(lambda it: _forest_batches(it, ["id", "n", "sketch", "side"], links_of), "a bigint, b bigint")

    hot = lists.where(F.col("df") > SHORT).select("id", "k", "v")
    # of the holders of a value, the prefix leaves few as members; lists of several blocks are at most one for BLOCK members
    several = hot.groupBy("v").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")).where("blocks > 1")
    hot = hot.join(several, "v", "left").select("id", "k", "v", F.coalesce("blocks", F.lit(1)).cast("long").alias("blocks"))
    inside = hot.select("id", "k", F.concat_ws("/", "v", _block("id", "blocks")).alias("key"), F.lit(0).alias("side"))
    large = cut(hot.where("blocks > 1"))
    if not large.limit(1).count():
        return few.unionByName(compared(inside))
    links = cut(few.unionByName(compared(inside)))
    while True:
        apart = _parts_of(large, links)
        found = cut(compared(_one_of_each(apart))) if apart is not None else None
        if found is None or not found.limit(1).count():
            break
        links = cut(links.unionByName(found))
    return links if apart is None else links.unionByName(compared(_rest_dealt(apart)))


def _parts_of(large: DataFrame, links: DataFrame) -> DataFrame | None:
    """(id, k, v, part) of the lists whose members the links leave in several parts; None if there is no such list."""
    done = connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("part"))
    parts = cut(large.select("id", "k", "v").join(done, "id", "left").withColumn("part", F.coalesce("part", "id")))
    several = parts.groupBy("v").agg((F.min("part") < F.max("part")).alias("apart")).where("apart").select("v")
    apart = cut(parts.join(several, "v", "left_semi"))
    return apart if apart.limit(1).count() else None


def _one_of_each(apart: DataFrame) -> DataFrame:
    """The member of the smallest id of each part of a list of two members or more, dealt to blocks of such members: (key, side, id, k)."""
    one = apart.groupBy("v", "part").agg(F.min(F.struct("id", "k")).alias("m"), F.count("*").alias("n")).where("n > 1").select("v", "m.id", "m.k")
    sizes = one.groupBy("v").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    return one.join(sizes, "v").select("id", "k", F.concat_ws("/", "v", _block("id", "blocks")).alias("key"), F.lit(0).alias("side"))


def _rest_dealt(apart: DataFrame) -> DataFrame:
    """Members outside a list's largest part, dealt to meet every block of the list, and that part to meet theirs: (key, side, id, k)."""
    sizes = apart.groupBy("v", "part").agg(F.count("*").alias("m"))
    main = sizes.groupBy("v").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.max("m").alias("m_main"), F.sum("m").alias("m_all"))
    blocks = main.select("v", "main", F.ceil((F.col("m_all") - F.col("m_main")) / BLOCK).cast("long").alias("rest_blocks"), F.ceil(F.col("m_main") / BLOCK).cast("long").alias("main_blocks"))
    is_main = F.col("part") == F.col("main")
    rows = apart.join(blocks, "v").withColumn("own_blocks", F.when(is_main, F.col("main_blocks")).otherwise(F.col("rest_blocks")))
    own = _block("id", "own_blocks") + F.when(is_main, F.col("rest_blocks")).otherwise(0)
    meets = F.when(is_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks"))
    return _dealt(rows.select("id", "k", "v", own.alias("own"), meets.alias("meets")), "v", "own", "meets")


def _full_sets(texts: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """members (id and other columns) with `set`, made again from their texts, and no others."""

    names = members.columns

    def sets_of(batches):
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            packed = [shingles(t, width).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(packed, pa.binary())], names=[*names, "set"])

    schema = T.StructType([*members.schema.fields, T.StructField("set", T.BinaryType())])
    return texts.join(members, "id").select(*names, "text").mapInArrow(sets_of, schema)


def _reach(x: list[np.ndarray], y: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which pairs have den * intersection >= num * union; empty sets reach nothing."""
    common = common_counts(x, y)
    union = np.add.outer(np.fromiter(map(len, x), np.int64, len(x)), np.fromiter(map(len, y), np.int64, len(y))) - common
    return (common > 0) & (den * common >= num * union)


def _links_by_key(dealt: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): a spanning forest of the confirmed links of each key.  dealt: key, id, set, side."""

    def links_of(rows):
        left, right, same = _sides(rows, 2)
        if not left or not right:
            return []
        x, y = ([np.frombuffer(r[1], np.uint64) for r in side] for side in (left, right))
        return [(left[i][0], right[j][0]) for i, j in spanning(_reach(x, y, num, den), same) if left[i][0] != right[j][0]]

    rows = dealt.select("key", "id", "set", "side").repartition("key").sortWithinPartitions("key", "id")
    return rows.mapInArrow(lambda it: _forest_batches(it, ["id", "set", "side"], links_of), "a bigint, b bigint")


def _confirmed_pairs(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def run(batches):
        for b in batches:
            packed = [b.column(c).to_pylist() for c in ("x", "y")]
            ends = np.cumsum([len(p) + len(q) for p, q in zip(*packed)])
            at = 0
            while at < len(b):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_BYTES)))
                x, y = packed[0][at:to], packed[1][at:to]
                common = common_of_pairs(x, y)
                union = np.array([len(p) + len(q) for p, q in zip(x, y)]) // 8 - common
                yield b.slice(at, to - at).select(["a", "b"]).filter(pa.array((common > 0) & (den * common >= num * union)))
                at = to

    one, two = (sets.select(F.col("id").alias(i), F.col("set").alias(v)) for i, v in (("a", "x"), ("b", "y")))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def confirmed_links(texts: DataFrame, groups: DataFrame, candidates: DataFrame, threshold: tuple[int, int], width: int) -> DataFrame:
    """(a, b) spanning links of the pairs of a group whose Jaccard on full sets reaches the threshold.

    texts: id, text; groups: node, component, n; candidates: the links (a, b) that made the groups.
    """
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    blocks = sizes.select("component", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    members = groups.join(blocks, "component").select(F.col("node").alias("id"), "component", "blocks").withColumn("own", _block("id", "blocks"))
    inside = F.concat_ws("/", "component", "own").alias("key")
    large = cut(members.where("blocks > 1"))
    if not large.limit(1).count():
        return _links_by_key(_full_sets(texts, members.select("id", inside), width).withColumn("side", F.lit(0)), *threshold)
    few = _links_by_key(_full_sets(texts, members.where("blocks = 1").select("id", inside), width).withColumn("side", F.lit(0)), *threshold)
    sets = staged(_full_sets(texts, large, width), "sets")
    first = cut(_links_by_key(sets.select("id", "set", inside, F.lit(0).alias("side")), *threshold))

    def settled(links: DataFrame) -> DataFrame:
        """large with `part`: the component that confirmed links give so far."""
        done = connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("part"))
        return cut(large.select("id", "component").join(done, "id", "left").withColumn("part", F.coalesce("part", "id")))

    parts = settled(first)
    # a group of near copies is now in a part for each block: one candidate link of two such parts is tried, others wait
    sizeable = parts.groupBy("part").count().where(F.col("count") >= PART).select("part")
    inner = parts.join(sizeable, "part", "left_semi")
    ends = [inner.select(F.col("id").alias(i), F.col("part").alias(f"part_{i}")) for i in "ab"]
    across = candidates.join(ends[0], "a").join(ends[1], "b").where("part_a <> part_b")
    across = across.groupBy(F.least("part_a", "part_b"), F.greatest("part_a", "part_b")).agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
    second = cut(first.union(_confirmed_pairs(across, sets, *threshold)))
    parts = settled(second)
    # the largest part of a group meets the rest; parts of the rest meet everything
    by_part = parts.groupBy("component", "part").agg(F.count("*").alias("m"))
    main = by_part.groupBy("component").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.max("m").alias("m_main"), F.sum("m").alias("m_all")).where("m_all > m_main")
    shingles_each = F.greatest(F.lit(1.0), F.col("shingles") * BLOCK / (F.col("members") * BLOCK_SHINGLES))
    per_block = BLOCK / shingles_each
    dealt = (
        main.join(sizes, "component")
        .select("component", "main", F.ceil((F.col("m_all") - F.col("m_main")) / per_block).cast("long").alias("rest_blocks"), F.ceil(F.col("m_main") / per_block).cast("long").alias("main_blocks"))
    )
    is_main = F.col("part") == F.col("main")
    open_parts = parts.join(dealt, "component").withColumn("own_blocks", F.when(is_main, F.col("main_blocks")).otherwise(F.col("rest_blocks")))
    open_parts = open_parts.select(
        "id", "component", (_block("id", "own_blocks") + F.when(is_main, F.col("rest_blocks")).otherwise(0)).alias("own"),
        F.when(is_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")).alias("meets"),
    )
    third = _links_by_key(_dealt(open_parts, "component", "own", "meets").join(sets.select("id", "set"), "id"), *threshold)
    return few.union(second).union(third)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (80, 100), width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of df.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z became lower case.  A document's set is that of its distinct shingles of `width`
    words; with fewer words, the whole sequence as one; without words or text, empty.  Two documents are linked if
    den * intersection >= num * union, with (num, den) = threshold; empty sets are linked with nothing.  component_id is
    the smallest id that links reach, the document's own included; kept says whether it is the document's own.

    Rows with a null id have a null component and kept true: nothing could refer to them.  Rows that repeat an id are one
    document, with the links of all its texts.  Texts are read whole, however long.  Extra columns are left out; an
    empty table gives an empty result.
    """
    t = threshold[0] / threshold[1]
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = cut(sketches(docs, "id", "text", width))
    ids = made.where("id is not null and digest is not null")
    same_head = Window.partitionBy("head").orderBy("digest")
    heads = cut(ids.groupBy("digest").agg(F.min("id").alias("head")).withColumn("k", F.row_number().over(same_head)))
    classes = ids.select("id", "n", "sketch", "digest").join(heads.select(F.col("head").alias("id"), "digest", "k"), ["id", "digest"])
    classes = cut(classes.dropDuplicates(["id", "k"]).select("id", "k", "n", "sketch"))
    release(df.sparkSession)
    candidates = cut(candidate_links(classes, t))
    release(df.sparkSession)
    sizes = classes.groupBy(F.col("id").alias("node")).agg(F.sum("n").alias("n"))
    groups = cut(connected_components(candidates).join(sizes, "node"))
    # of the texts, hardly more than those in groups are shuffled to their members
    texts = with_filter(docs.where("id is not null and text is not null"), "id", groups.select("node"), "_asked").where("_asked").drop("_asked")
    confirmed = confirmed_links(texts, groups, candidates, threshold, width)
    repeated = ids.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    owned = ids.join(repeated, "id", "left_semi").select("id", "digest").distinct().join(heads, "digest").select("id", "head")
    same_id = owned.join(owned.groupBy("id").agg(F.min("head").alias("least")), "id").where("head <> least").select(F.col("least").alias("a"), F.col("head").alias("b"))
    joined = connected_components(cut(confirmed.union(same_id)))
    of_class = heads.join(joined.select(F.col("node").alias("head"), "component"), "head", "left").select("digest", F.coalesce("component", "head").alias("component"))
    return (
        made.select("id", "n", "digest").join(of_class, "digest", "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
