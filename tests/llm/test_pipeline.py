"""The pipeline's stages against what they promise, on a small table."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as p
from vigil.llm import neardup

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert set(after.columns) == set(p.COLUMNS), name
        ids = [r.doc_id for r in after.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(before), name
        if name == "near-duplicates":
            again = neardup.near_duplicates(after, threshold=(80, 100))
            assert again.where("not kept").count() == 0
        before, docs = {r.doc_id: r.text for r in after.collect()}, after
    done = p.encode(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in done) == sorted(before)
    assert all(r.round_trip and r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in done)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda df: sorted((r.doc_id, bytes(r.ids)) for r in df.collect())
    assert key(p.run(spark, SF)) == key(docs)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = lambda t: t + " more"
    made = [(None, a), (None, a), (None, None), (1, b), (3, a), (3, a), (3, b), (5, near(a)), (6, c), (6, near(c)), (7, ""), (7, ""), (8, None), (8, None), (9, near(c))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in made], "doc_id bigint, text string, lang string, source string, n_chars int").repartition(3)
    key = lambda rows: sorted(rows, key=str)
    want = [(None, a), (None, a), (None, None), (1, b), (3, a), (6, c), (7, ""), (8, None)]
    got = p.near_duplicates(spark, docs, SF)
    assert got.columns == list(p.COLUMNS) and key((r.doc_id, r.text) for r in got.collect()) == key(want)
    # without repeated ids nothing is numbered anew
    got = p.near_duplicates(spark, docs.where("doc_id is null or doc_id in (1, 5, 9)"), SF)
    assert key((r.doc_id, r.text) for r in got.collect()) == key([(None, a), (None, a), (None, None), (1, b), (5, near(a)), (9, near(c))])


def test_stages_of_odd_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars int"
    empty = spark.createDataFrame([], schema)
    for name, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
    prose = lambda i: " ".join(f"the word{i} of {j} and more" for j in range(i, i + 30))
    made = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n", "en", None, 2), (None, prose(0), "en", "s", 9), (4, prose(500), None, "s", 9), (4, prose(500), None, "s", 9), (5, prose(900) + " word" * 60_000, "en", "s", 9), (6, "!!! ### $$$ " * 40, "en", "s", 9)]
    docs = spark.createDataFrame(made, schema).withColumns({"vector": F.lit(1), "id": F.lit(2), "KEPT": F.lit(3)}).repartition(3)
    kept = {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, SF)
        kept[name] = [r.doc_id for r in out.collect()]
        assert set(out.columns) == (set(p.COLUMNS) if name != "bpe" else {"doc_id", "source", "lang", "n_tokens", "ids", "round_trip"})
    assert not {1, 2, 3} & set(kept["quality rules"]) and {None, 4} <= set(kept["quality rules"]) and kept["quality rules"].count(4) == 2
    assert sorted(kept["near-duplicates"], key=str) == [1, 2, 3, 4, 5, 6, None]
    assert len(set(kept["mixing"])) and kept["mixing"].count(4) in (0, 2) and len(kept["bpe"]) == len(made)


def test_run_against_plain_stages(spark):
    """The rows of run() from a plain version of every stage, chained: a likelihood of votes, all pairs, loops, the library."""
    from collections import Counter

    from tokenizers import Tokenizer

    from vigil.llm import mixing, quality

    from test_operators import BPE, brute_components, plain_topics

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    featured = spark.createDataFrame([(i, *quality.features_of(d.text)) for i, d in enumerate(docs)], ["i", *quality.FEATURES])
    votes = {r.i: tuple(r.v) for r in featured.select("i", quality.votes().alias("v")).collect()}
    counts = Counter(votes.values())
    model = quality.estimate(np.array(sorted(counts)), np.array([counts[v] for v in sorted(counts)], float))

    def good(v):
        one, two = model.prior, 1 - model.prior
        for r, x in enumerate(v):
            one, two = one * model.chance[r][1][x], two * model.chance[r][0][x]
        return one / (one + two) >= 0.5

    docs = [d for i, d in enumerate(docs) if good(votes[i]) and (d.text or "").split()]
    groups = brute_components([(d.doc_id, d.text) for d in docs], 80, 100)
    docs = [d for d in docs if d.doc_id in {i for i, _, _, kept in groups if kept}]
    tokenizer = Tokenizer.from_file(BPE)
    ids = {d.doc_id: tokenizer.encode(d.text, add_special_tokens=False).ids for d in docs}
    cell = {d.doc_id: (d.source, d.lang, t) for d, t in zip(docs, plain_topics([d.text for d in docs], [d.lang for d in docs]))}
    mass = Counter()
    for i, c in cell.items():
        mass[c] += len(ids[i])
    total = sum(mass.values())
    x = {c: n / total for c, n in mass.items()}
    share = lambda k, y: {n: sum(v for c, v in y.items() if c[k] == n) for n in {c[k] for c in y}}
    want = [mixing.tempered(share(k, mass), mixing.TEMPERATURES[m]) for k, m in enumerate(("source", "lang", "topic"))]
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            have = share(k, x)
            x = {c: v * want[k][c[k]] / have[c[k]] for c, v in x.items()}
    weight = {c: x[c] * total / mass[c] for c in mass}
    top = max(weight.values())
    draws = dict(spark.createDataFrame([(d.doc_id,) for d in docs], "id bigint").select("id", F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(1 << 53)) / F.lit(float(1 << 53))).collect())
    sample = {i for i, c in cell.items() if draws[i] < weight[c] / top}
    got = {r.doc_id: r for r in p.run(spark, SF).collect()}
    assert set(got) == sample and len(sample) > 20
    assert all(np.frombuffer(got[i].ids, "<u4").tolist() == ids[i] and got[i].round_trip and got[i].n_tokens == len(ids[i]) for i in sample)


def test_ids_at_the_end_of_their_range_and_settings(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, top = spark.conf.get(key), (1 << 63) - 1
    rows = [(top, "one text of its own", "en", "a", 1), (top, "another text altogether", "en", "a", 2), (top, "another text altogether", "en", "a", 2), (5, "a third", "en", "a", 3), (-(1 << 63), "fourth", "en", "a", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = p.near_duplicates(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted({(i, t) for i, t, *_ in rows})
    assert p.mix_sources(spark, docs.limit(0), "").count() == 0 and spark.conf.get(key) == before
