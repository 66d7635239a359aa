"""Which of very many literal patterns a text holds.

Patterns and texts meet at one gram: of the four-byte pieces of a pattern, the one that the fewest texts hold.  A text that
holds the pattern holds this gram, so an equi-join finds every pair, and rare grams keep the pairs few.  A pattern with a
gram that no text holds drops out at once.  What is found is then confirmed on the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut, staged
from .joins import small

WIDTH = 4
#: Different grams of all patterns up to which tasks look them up themselves (8 bytes each) and pass no other grams on.
LOOKUP_GRAMS = 1_000_000
#: Patterns that a row of the index holds; a gram with more has several rows.
ROW_PATTERNS = 500
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, and no other letters."""
    return F.translate(text, _UPPER, _LOWER)


def grams(text: str, width: int) -> np.ndarray:
    """The distinct pieces of `width` bytes of a text, as numbers that also hold the width."""
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    if len(raw) < width:
        return np.zeros(0, np.int64)
    code = np.full(len(raw) - width + 1, width, np.int64)
    for k in range(width):
        code = code << 8 | raw[k : len(raw) - width + 1 + k]
    return np.unique(code)


def _grams_of(df: DataFrame, key: str, text: str, widths: list[int] | None, known: np.ndarray | None) -> DataFrame:
    """(key, gram): the grams of each text, of all `widths`, or of the pattern's own; only those in `known`, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 500) for i in range(0, len(b), 500)):
                found = []
                for t in part.column(1).to_pylist():
                    own = [grams(t, w) for w in widths or [min(WIDTH, len(t.encode()))]]
                    g = np.concatenate(own)
                    found.append(g if known is None else g[known[np.minimum(np.searchsorted(known, g), len(known) - 1)] == g])
                at = np.repeat(np.arange(len(found)), [len(g) for g in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], names=["key", "gram"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {dict(df.dtypes)[key]}, gram bigint")


def first_literal(df: DataFrame, rules: DataFrame, text: str, order: str, value: str, name: str = "rule", any_case: bool = True) -> DataFrame:
    """df with `name`: the value of the first rule (literal, order, value) whose literal the text holds, or null.

    Rules are taken by `order` (not null), then by value.  any_case: A-Z match a-z.  Null and empty literals fit nothing, null texts hold
    nothing.  Neither the number of rules nor that of texts is bounded; equal texts are looked at once.
    """
    fold = ascii_lower if any_case else (lambda c: c)
    wanted = rules.where("literal is not null and literal <> ''").groupBy(fold(F.col("literal")).alias("pattern")).agg(F.min(F.struct(F.col(order).alias("order"), F.col(value).alias("value"))).alias("rule"))
    # staged, as texts are read for their grams and again to confirm; texts that differ by case are two, so that none is folded twice
    whole = df.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct()
    texts = staged(whole.select(fold(F.col("text")).alias("text"), F.md5("text").alias("key")), "texts", free=False)
    wanted = cut(wanted.withColumn("n_bytes", F.least(F.lit(WIDTH), F.octet_length("pattern"))))
    of_patterns = cut(_grams_of(wanted, "pattern", "pattern", None, None))
    widths = sorted(r.n_bytes for r in wanted.select("n_bytes").distinct().collect())  # WIDTH numbers at most
    different = of_patterns.select("gram").distinct()
    few = different.limit(LOOKUP_GRAMS + 1).count() <= LOOKUP_GRAMS
    known = np.sort(np.array([r.gram for r in different.collect()], np.int64)) if few else None
    of_texts = cut(_grams_of(texts, "key", "text", widths, known)) if widths else None
    if of_texts is None:
        return df.withColumn(name, F.lit(None).cast(rules.schema[value].dataType))
    held = of_texts.groupBy("gram").agg(F.count("*").alias("n"))
    # a gram that no text holds has no row here, and then its pattern is in no text
    rarity = of_patterns.withColumnRenamed("key", "pattern").join(held, "gram", "left")
    rarest = rarity.groupBy("pattern").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.bool_and(F.col("n").isNotNull()).alias("all")).where("all")
    sizes = rarest.groupBy("gram").agg(F.ceil(F.count("*") / ROW_PATTERNS).alias("parts"))
    listed = F.collect_list(F.struct(F.col("rule.order").alias("order"), F.col("rule.value").alias("value"), "pattern"))
    index = rarest.join(wanted, "pattern").join(sizes, "gram").groupBy("gram", F.pmod(F.xxhash64("pattern"), F.col("parts")).alias("part")).agg(listed.alias("rules"))
    met = of_texts.join(small(index.select("gram", "rules")), "gram").select("key", "rules")
    fits = F.array_min(F.filter("rules", lambda r: F.contains(F.col("text"), r["pattern"])))
    best = met.join(texts, "key").select("key", fits.alias("fit")).where("fit is not null").groupBy("key").agg(F.min("fit").alias("fit"))
    return df.withColumn("_key", F.md5(text)).join(best.select(F.col("key").alias("_key"), F.col("fit.value").alias(name)), "_key", "left").drop("_key")


def indicator_upgrade(commands: DataFrame, indicators: DataFrame, text: str, group: str | None = None, label: str = "label") -> DataFrame:
    """commands whose unknown label became malicious where the text holds an indicator (column `indicator`), in any case of A-Z.

    With `group` (say a shell input's id), an unknown row also follows a malicious one of its group.  There may be any
    number of indicators.  Null texts and groups are left as they are.
    """
    rules = indicators.select(F.col("indicator").alias("literal"), F.lit(0).alias("place"), F.lit(True).alias("hit"))
    out = first_literal(commands, rules, text, "place", "hit", "_hit")
    out = out.withColumn(label, F.when((F.col(label) == "unknown") & F.col("_hit"), "malicious").otherwise(F.col(label))).select(*commands.columns)
    if group is None:
        return out
    bad = out.where((F.col(label) == "malicious") & F.col(group).isNotNull()).select(F.col(group).alias("_bad")).distinct()
    joined = out.join(bad, F.col(group) == F.col("_bad"), "left")
    return joined.withColumn(label, F.when((F.col(label) == "unknown") & F.col("_bad").isNotNull(), "malicious").otherwise(F.col(label))).drop("_bad")
