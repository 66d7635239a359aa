"""Mixing sources to target weights.

The token mass of each cell (source, language, topic) is raked by iterative proportional fitting until the marginals are
the targets.  A document is then kept with the probability that its cell's weight gives, calibrated so that no
probability exceeds one.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from . import topics
from ._common import cut, fresh, staged, without
from .bpe import vocabulary

#: Cells up to this number are raked on the driver (about 100 bytes each); beyond it they are raked as a DataFrame.
DRIVER_CELLS = 200_000
#: A target share is the present share to this power, normalised: below 1 small groups gain.
TEMPERATURES = {"source": 0.85, "lang": 0.85, "topic": 0.9}
DRAW_BITS = 53
#: Texts that a task looks at together.
TEXTS = 2000
#: Raking ends once no marginal share is off by CLOSE, on the driver and as a DataFrame alike, or with a warning after ROUNDS.
ROUNDS, CLOSE = 500, 1e-10
NO_TARGET = "no category of a margin has both tokens and a target"


def described(df: DataFrame, tokenizer: str, text_col: str, tokens: str, vector: str | None, keep_text: bool) -> DataFrame:
    """df with `tokens`, the number of BPE tokens of the whole text (0 for null), and `vector`, how its words are used (null without words)."""
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]
    new = [StructField(tokens, LongType())] + ([StructField(vector, BinaryType())] if vector else [])
    schema = StructType([*kept, *new])

    def run(batches):
        bpe = vocabulary(tokenizer, topics.bucket_of if vector else None)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            n, used = bpe.count(texts, topics.BUCKETS if vector else 0)
            columns = [pa.array(n)]
            if vector:
                columns.append(pa.array([v if t and not t.isspace() else None for t, v in zip(texts, topics.word_vectors(used))], pa.binary()))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), *columns], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def tempered(mass: dict, power: float) -> dict:
    """Target shares: present shares to a power, normalised."""
    total = sum(mass.values())
    raw = {k: (v / total) ** power if v else 0.0 for k, v in mass.items()} if total else {}
    s = sum(raw.values())
    return {k: v / s for k, v in raw.items()}


def _report(worst: float, rounds: int, close: float) -> None:
    warnings.warn(f"raking has not settled after {rounds} rounds: a marginal share is off by {worst:.3g}, above {close:.3g}; the targets may contradict each other", RuntimeWarning, stacklevel=3)


def rake(mass: np.ndarray, index: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, close: float = CLOSE) -> np.ndarray:
    """Iterative proportional fitting.  mass: token mass of each cell; index[m]: each cell's category in marginal m; targets[m]: its shares.

    Returns the weight of each cell, whose fitted share is mass * weight.  Targets of categories without mass are spread over the others.
    Warns if a share is still off by `close` or more after `rounds`.
    """
    total = mass.sum()
    if not total:
        return np.ones_like(mass)
    w = np.ones_like(mass) / total
    for _ in range(rounds):
        worst = 0.0
        for at, target in zip(index, targets):
            have = np.bincount(at, weights=mass * w, minlength=len(target))
            want = np.where(have > 0, target, 0)
            if not want.sum():
                raise ValueError(NO_TARGET)
            want = want / want.sum()
            factor = np.divide(want, have, out=np.ones_like(want), where=have > 0)
            worst = max(worst, float(np.abs(have - want).max()))
            w = w * factor[at]
        if worst < close:
            return w
    _report(worst, rounds, close)
    return w


def _rake_frame(cells: DataFrame, margins: list[str], targets: dict[str, dict] | None, powers: dict[str, float], rounds: int = ROUNDS, close: float = CLOSE) -> DataFrame:
    """rake() by the same rules for more cells than the driver should hold: the cells stay a DataFrame, cut after each margin."""
    total = cells.agg(F.sum("mass")).first()[0]
    if not total:
        return cells.withColumn("w", F.lit(1.0))
    now, want = cells.withColumn("w", F.lit(1.0 / total)), {}
    for m in margins:
        share = cells.groupBy(F.col(m).alias("k")).agg(F.sum("mass").alias("t"))
        if targets and targets.get(m):
            kind = StructType([StructField("g", cells.schema[m].dataType), StructField("given", DoubleType())])
            given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[m].items()], kind)
            raw = share.join(given, F.col("k").eqNullSafe(F.col("g")), "left").select("k", F.coalesce("given", F.lit(0.0)).alias("want"))
        else:
            raw = share.select("k", F.when(F.col("t") > 0, F.pow(F.col("t") / total, F.lit(float(powers.get(m, 1.0))))).otherwise(0.0).alias("want"))
        want[m] = cut(raw)
    for _ in range(rounds):
        worst = 0.0
        for m in margins:
            have = now.groupBy(F.col(m).alias("h")).agg(F.sum(F.col("mass") * F.col("w")).alias("have")).where("have > 0")
            both = have.join(want[m], F.col("h").eqNullSafe(F.col("k"))).select("k", "have", "want")
            s = both.agg(F.sum("want")).first()[0]
            if not s:
                raise ValueError(NO_TARGET)
            share = F.col("want") / s
            worst = max(worst, both.agg(F.max(F.abs(F.col("have") - share))).first()[0])
            factor = both.select("k", (share / F.col("have")).alias("f"))
            now = cut(now.join(factor, F.col(m).eqNullSafe(F.col("k")), "left").withColumn("w", F.col("w") * F.coalesce("f", F.lit(1.0))).drop("k", "f"))
        if worst < close:
            return now
    _report(worst, rounds, close)
    return now


def calibrated(sums, budget: float) -> float:
    """The scale at which cells kept with probability min(1, scale * weight) have `budget` of all tokens to expect.

    sums(scale): mass of the cells at probability 1, and weighted mass of the others.  Cells only ever join the first, so this ends.
    """
    capped, rest = sums(0.0)
    total, scale = capped + rest, 0.0
    while rest > 0 and (more := (budget * total - capped) / rest) > scale * (1 + 1e-12):
        scale = more
        capped, rest = sums(scale)
    return scale


def mix(
    df: DataFrame, margins: tuple[str, ...] = ("source", "lang", "topic"), targets: dict[str, dict] | None = None, powers: dict[str, float] = TEMPERATURES, id_col: str = "doc_id",
    text_col: str = "text", tokenizer: str | None = None, topic_within: str = "lang", keep_text: bool = True, budget: float | None = None, seed: int = 29, driver_cells: int = DRIVER_CELLS,
) -> DataFrame:
    """df with n_tokens, topic (where it has none), weight, probability and sampled.

    tokenizer: a byte-level BPE file, which every executor has.  Each text is read once, for its n_tokens and its words;
    what the later steps need is staged in the shared folder, with the text only if keep_text.  Without a tokenizer, df
    brings n_tokens (null: 0) and topic itself.  topic: fitted on the words of all texts, set against texts of the same
    topic_within; `none` for texts without words.

    weight: the raked share of a token of the cell, relative to the unraked one.  probability: weight scaled so that a
    sample has `budget` of all tokens to expect, where no document has more than 1; without a budget, the largest scale at
    which no probability exceeds 1, so that the sample's expected marginals are the targets exactly.  sampled: a draw
    from a hash of id_col, the same in every run, for repeated ids alike.

    targets: {margin: {category: share}}; categories they leave out get weight 0; margins without one get shares to the
    power in `powers`.  Null categories are categories of their own, also in targets.  Cells without tokens (null or empty texts) have weight 1.  Columns named as the new ones are
    replaced; an empty table gives an empty result.
    """
    given = [c.lower() for c in df.columns]
    fitted = "topic" in margins and "topic" not in given
    if tokenizer is None and (fitted or "n_tokens" not in given):
        raise ValueError("without a tokenizer the table needs n_tokens and topic")
    df = without(df, *[c for c in ("weight", "probability", "sampled") + (("n_tokens",) if tokenizer else ()) if c not in margins])
    if tokenizer:
        vector, mean = fresh([*df.columns, "n_tokens", "topic"], "vector", "mean")
        rows = staged(described(df, tokenizer, text_col, "n_tokens", vector if fitted else None, keep_text), "mixing")
        if fitted:
            rows = topics.with_means(rows, topic_within, vector, mean)
            rows = rows.withColumn("topic", topics.nearest_topic(vector, mean, topics.fit_topics(rows, vector, mean))).drop(vector, mean)
    else:
        rows = (df if keep_text else without(df, text_col)).withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)).cast("long"))
    cells = cut(rows.groupBy(*margins).agg(F.sum("n_tokens").cast("double").alias("mass")))
    few = cells.limit(driver_cells + 1).count() <= driver_cells
    if few:
        got = sorted((tuple(r) for r in cells.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r[:-1]))
        mass = np.array([r[-1] for r in got], float)
        index, want = [], []
        for k, m in enumerate(margins):
            names = list(dict.fromkeys(r[k] for r in got))
            place = {n: i for i, n in enumerate(names)}
            at = np.array([place[r[k]] for r in got], np.int64)
            here = dict(zip(names, np.bincount(at, weights=mass, minlength=len(names)).tolist())) if len(got) else {}
            share = (targets or {}).get(m) or tempered(here, powers.get(m, 1.0))
            index.append(at)
            want.append(np.array([share.get(n, 0.0) for n in names], float))
        w = rake(mass, index, want) * mass.sum() if len(got) else mass
        w = np.where(mass > 0, w, 1.0)
        top = float(w.max()) if len(w) else 1.0
        schema = ", ".join(f"`{m}` {rows.schema[m].dataType.simpleString()}" for m in margins) + ", weight double"
        weights = F.broadcast(df.sparkSession.createDataFrame([(*r[:-1], float(x)) for r, x in zip(got, w)], schema))
        sums = lambda s: (float(mass[s * w >= 1].sum()), float((mass * w)[s * w < 1].sum()))
    else:
        done = _rake_frame(cells, list(margins), targets, powers)
        total = done.agg(F.sum("mass"), F.sum(F.col("mass") * F.col("w"))).first()
        scaled = F.col("w") * (total[0] / total[1]) if total[0] else F.lit(1.0)
        weighed = cut(done.select(*margins, "mass", F.when(F.col("mass") > 0, scaled).otherwise(1.0).alias("weight")))
        weights = weighed.drop("mass")
        top = weights.agg(F.max("weight")).first()[0]
        full = lambda s: F.col("weight") * s >= 1
        sums = lambda s: tuple(weighed.agg(F.coalesce(F.sum(F.when(full(s), F.col("mass"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full(s), F.col("mass") * F.col("weight"))), F.lit(0.0))).first())
    scale = 1.0 / top if budget is None else calibrated(sums, budget)
    keys = fresh(rows.columns, *[f"cell_{m}" for m in margins])
    on = [F.col(f"`{m}`").eqNullSafe(F.col(k)) for m, k in zip(margins, keys)]
    joined = rows.join(weights.select(*[F.col(m).alias(k) for m, k in zip(margins, keys)], "weight"), on, "left").drop(*keys)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << DRAW_BITS)) / F.lit(float(1 << DRAW_BITS))
    return joined.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * scale)).withColumn("sampled", draw < F.col("probability"))
