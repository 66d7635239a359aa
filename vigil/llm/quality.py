"""Quality rules by weak supervision.

Each rule votes good or bad on a document, or abstains.  Expectation-maximisation over the counts of all vote patterns
estimates every rule's accuracy on good and on bad documents without labels, and the posterior probability that a
document is good takes the place of "all rules must pass".
"""

from __future__ import annotations

import functools
import math
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import without

GOOD, BAD, ABSTAIN = 1, 0, -1
#: Texts that a task looks at together.
TEXTS = 1000
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
#: Frequent function words (English, German, French, Spanish); having them speaks for prose, lacking them says nothing.
FUNCTION_WORDS = frozenset(b"the of and to in a is that for it as was with be by on not this are have der die und das ist nicht ein zu den von mit sich auf le la les de et des un une est que dans en du pour el los las y se del con por su no".split())
_OTHER, _UPPER, _LETTER, _SYMBOL, _SPACE, _SHOUT = range(6)

FEATURES = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(), "n_repeat_words": T.LongType(),
    "n_lines": T.LongType(), "n_distinct_words": T.LongType(), "n_letters": T.LongType(), "n_upper": T.LongType(), "n_shouts": T.LongType(), "n_function_words": T.LongType(),
}


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k[0] == "L":
            kinds[c] = _UPPER if k in ("Lu", "Lt") else _LETTER
    for chars, kind in ((SYMBOLS, _SYMBOL), (SPACES, _SPACE), ("!", _SHOUT)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """How many words lie in a window of three words that the text has twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * distinct + ids[1:]
    if distinct > 1_000_000:  # three ids in one number need fewer
        pair, distinct_pairs = np.unique(pair, return_inverse=True)[1], distinct
        gram = pair[:-1] * distinct_pairs + ids[2:]
    else:
        gram = pair[:-1] * distinct + ids[2:]
    _, at, n = np.unique(gram, return_inverse=True, return_counts=True)
    again = n[at] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def features_of(text: str | None) -> tuple[int, ...]:
    """The values of FEATURES of a whole text; all zero for null."""
    text = text or ""
    kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=6)
    words = text.encode().split()  # on the six ASCII white-space characters, and no others
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words), len(text) - int(kinds[_SPACE]), int(kinds[_SYMBOL]), len(lines) - len(set(lines)), repeated_words(ids, max(1, len(seen))),
        len(lines), len(seen), int(kinds[_UPPER] + kinds[_LETTER]), int(kinds[_UPPER]), int(kinds[_SHOUT]), sum(w.lower() in FUNCTION_WORDS for w in words),
    )


@dataclass(frozen=True)
class Rule:
    """Votes BAD where `bad` holds, GOOD where `good` holds, and otherwise abstains; both are SQL conditions over FEATURES."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", "false"),
    Rule("capitals", "n_upper > 0.3 * n_letters", "false"),
    Rule("repetition", "n_repeat_words > 0.3 * n_words", "false"),
    Rule("letters", "n_letters < 0.8 * word_chars", "n_letters > 0.9 * word_chars"),
    Rule("exclamations", "n_shouts > 0.2 * n_words", "false"),
    # distinct words grow about with the root of a text's length
    Rule("vocabulary", "n_words >= 50 and n_distinct_words < 2 * sqrt(n_words)", "n_distinct_words > 0.4 * n_words or n_distinct_words > 5 * sqrt(n_words)"),
    Rule("duplicate lines", "n_dup_lines > 0.3 * n_lines and n_lines > 3", "false"),
    Rule("word length", "word_chars < 3 * n_words or word_chars > 12 * n_words", "false"),
    Rule("function words", "false", "n_function_words > 0.12 * n_words"),
)


def with_features(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """df with the columns of FEATURES, from whole texts; columns of these names are replaced."""
    df = without(df, *[f for f in FEATURES if f != text_col])
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in FEATURES.items())])

    def run(batches):
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            values = list(zip(*map(features_of, b.column(text_col).to_pylist()))) or [()] * len(FEATURES)
            old = [b.column(b.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*old, *(pa.array(v, pa.int64()) for v in values)], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def votes(rules=RULES) -> Column:
    """Array of the rules' votes.  A text without words gets no vote."""
    vote = lambda r: F.when(F.col("n_words") == 0, ABSTAIN).when(F.expr(r.bad), BAD).when(F.expr(r.good), GOOD).otherwise(ABSTAIN)
    return F.array(*map(vote, rules))


#: Votes of each kind that every rule has beforehand on either class, so that no chance is 0.
PSEUDO = 0.5


@dataclass(frozen=True)
class Model:
    """prior: share of good documents; chance[r][y][v]: how likely rule r gives vote v (BAD, GOOD, ABSTAIN) on y (BAD, GOOD)."""

    prior: float
    chance: tuple[tuple[tuple[float, float, float], ...], ...]

    def accuracy(self, r: int) -> float:
        """How often rule r is right where it votes."""
        (bad, _), good = (self.chance[r][BAD][:2], self.chance[r][GOOD])
        right = self.prior * good[GOOD] + (1 - self.prior) * bad
        return right / (right + self.prior * good[BAD] + (1 - self.prior) * self.chance[r][BAD][GOOD])

    def posterior(self, vote: Column) -> Column:
        """The probability that a document with these votes is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for r, (bad, good) in enumerate(self.chance):
            w = [math.log(g / b) for g, b in zip(good, bad)]
            odds = odds + F.when(vote[r] == GOOD, w[GOOD]).when(vote[r] == BAD, w[BAD]).otherwise(w[ABSTAIN])
        return 1 / (1 + F.exp(-odds))


def likeliest(bad: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest vote distributions of bad and good documents, given how often each vote was counted on either.

    Under the rule that a bad vote is at least as likely on bad documents, and a good vote on good ones.  A bound that is
    not kept by itself holds with equality in the optimum; for each choice of such bounds the optimum is in closed form:
    the two classes share the pooled rate of that vote, and the other votes share what is left as they were counted.
    """

    def with_equal(votes: tuple[int, ...]) -> list[np.ndarray]:
        if not votes:
            return [n / n.sum() for n in (bad, good)]
        if len(votes) == 2:
            return [(bad + good) / (bad + good).sum()] * 2
        v, out = votes[0], []
        rate = (bad[v] + good[v]) / (bad + good).sum()
        for n in (bad, good):
            p = n * (1 - rate) / (n.sum() - n[v])
            p[v] = rate
            out.append(p)
        return out

    best, most = None, -math.inf
    for votes in ((), (BAD,), (GOOD,), (BAD, GOOD)):
        p, q = with_equal(votes)
        value = float(bad @ np.log(p) + good @ np.log(q))
        if p[BAD] >= q[BAD] - 1e-12 and q[GOOD] >= p[GOOD] - 1e-12 and value > most:
            best, most = (p, q), value
    return best


def expected(patterns: np.ndarray, chance: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(probability of a good document, log likelihood) of each pattern."""
    one, rules = np.arange(len(patterns)), range(patterns.shape[1])
    bad, good = (math.log(x) + sum((np.log(chance[r, y])[patterns[one, r]] for r in rules), np.zeros(len(patterns))) for x, y in ((1 - prior, BAD), (prior, GOOD)))
    return 1 / (1 + np.exp(bad - good)), np.logaddexp(bad, good)


def objective(patterns: np.ndarray, counts: np.ndarray, chance: np.ndarray, prior: float) -> float:
    """What the rounds raise: the log likelihood of all documents, and of half a vote of each kind for each rule and class."""
    return float(counts @ expected(patterns, chance, prior)[1] + PSEUDO * np.log(chance).sum())


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 0.8, trace: list[float] | None = None) -> Model:
    """EM over vote patterns (one row each) and how many documents have them.

    It begins with rules that are right four times in five where they vote.  A rule's bad votes never count for a
    document nor its good votes against it, so the two classes cannot change places.  Every round gives distributions
    that sum to 1 and raises the objective, whose values go to `trace`.  Without documents, the starting values are the
    result.
    """
    n_rules = patterns.shape[1]
    chance = np.tile(np.array([[0.4, 0.1, 0.5], [0.1, 0.4, 0.5]]), (n_rules, 1, 1))
    total = counts.sum()
    for _ in range(rounds if total else 0):
        good = counts * expected(patterns, chance, prior)[0]
        before = chance.copy()
        prior = float(min(max(good.sum() / total, 0.02), 0.98))
        for r in range(n_rules):
            n = [np.bincount(patterns[:, r] % 3, weights=mass, minlength=3) + PSEUDO for mass in (counts - good, good)]
            chance[r, BAD], chance[r, GOOD] = likeliest(*n)
        if trace is not None:
            trace.append(objective(patterns, counts, chance, prior))
        if np.abs(before - chance).max() < 1e-9:
            break
    return Model(prior, tuple(tuple(tuple(map(float, x)) for x in table) for table in chance))


def fit(featured: DataFrame, rules=RULES) -> Model:
    """The model of all rows.  Only the counts of vote patterns come to the driver: 3 ** len(rules) of them at most."""
    rows = featured.groupBy(votes(rules).alias("v")).count().collect()
    rows = sorted((tuple(r["v"]), r["count"]) for r in rows)
    return estimate(np.array([v for v, _ in rows], np.int64).reshape(-1, len(rules)), np.array([n for _, n in rows], float))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_quality(df: DataFrame, text_col: str = "text", keep_text: bool = True, threshold: float = 0.5, rules=RULES) -> DataFrame:
    """df with FEATURES, votes, base_failed, posterior (probability of a good document) and kept.

    kept: not base_failed, and posterior >= threshold.  The texts are read twice, once for the model and once for the
    verdicts; nothing is kept in between.  Texts are read whole, however long.  A null or empty text has no words: it fails the base rule.  Repeated rows are
    judged alike, and each counts in the model.  Extra columns pass; those named as new ones are replaced.  An empty
    table gives an empty result.
    """
    df = without(df, *[c for c in ("votes", "base_failed", "posterior", "kept") if c != text_col])
    model = fit(with_features(df.select(text_col), text_col, keep_text=False), rules)
    featured = with_features(df, text_col, keep_text).withColumn("votes", votes(rules)).withColumn("base_failed", base_failed())
    return featured.withColumn("posterior", model.posterior(F.col("votes"))).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
