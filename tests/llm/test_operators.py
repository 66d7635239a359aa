"""Small cases of every operator: nulls, empty texts and tables, ties, repeated rows, clashing columns, and brute force."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import bpe, chat, components, mixing, neardup, quality, sharding, tokencount, topics, topk, urlfilter, warc
from vigil.llm.queries import tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "It's 42 o'clock!! <|endoftext|> über 日本語\n\n  x", "word " * 3000, "x" * 20000, "é" * 700 + "1" * 700, "tail  \n"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- op1 -------------------------------------------------------------------------------------------------------------
def brute_top(vectors, k, every):
    v = []
    for i, x in vectors:
        if i is not None and x and not any(c is None or not np.isfinite(c) for c in x):
            v.append((i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in x)))
    out = []
    for at, (i, q) in enumerate(v):
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, w)), j) for to, (j, w) in enumerate(v) if to != at and len(w) == len(q))[:k]
            out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s)]
    return sorted(out, key=str)


def test_topk_of_repeated_ids(spark):
    """Every row is a candidate and asks for itself, whatever its id."""
    some = [(50, [1.0, 1.0]), (7, [1.0, 0.0]), (7, [0.0, 5.0]), (50, [1.0, 1.0]), (50, [2.0, -1.0]), (100, [1.0, 1.0]), (7, [1.0, 0.0])]
    df = spark.createDataFrame(some, "vec_id bigint, embedding array<float>")
    for k in (1, 2, 5):
        assert rows(topk.top_k(df, k=k)) == brute_top(some, k, 50)
    far = spark.createDataFrame([(50, [1e30, 1.0]), (0, [1.0, 1.0]), (1, [2.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(far).collect()] == [(0, 1, 1, 2 * 256 * 512)]


def test_topk_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [(i, rng.normal(0, 0.3, 6).astype(np.float32).tolist()) for i in range(60)]
    same = [(100 + i, base[0][1]) for i in range(25)]  # a hot vector, with ties
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, []), (205, [1.0, 2.0]), (210, [3.0, 4.0]), (None, [1.0] * 6), (10, base[10][1]), (20, [9.0] * 6)]
    df = spark.createDataFrame(base + same + odd, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("x"))
    assert rows(topk.top_k(df, query_every=5)) == brute_top(base + same + odd, 5, 5)
    assert topk.top_k(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(0, [1e6, -1e6]), (1, [1e6, 3e6]), (2, [-1e6, 5e5])], "vec_id bigint, embedding array<double>")
    assert [r.score for r in topk.top_k(huge).orderBy("rank").collect()] == [256**2 * int(-2e12), 256**2 * int(-1.5e12)][::-1]


# --- op2 -------------------------------------------------------------------------------------------------------------
def test_chat_round_trip(spark):
    rnd = random.Random(1)
    bits = ["<s>", "</s>", "<\\s>", "<\\\\s>", "[INST]", "[/INST]", "<|im_end|>", "\n", "\\", "<", "[", "ok", "日", "%0A"]
    talks = [(c, t, rnd.choice(["user", "assistant", "system", "a\nb%", None, ""]), rnd.choice([None, "".join(rnd.choices(bits, k=8))])) for c in [1, 2, None] for t in range(20)] + [(1, 3, "user", "again")]
    df = spark.createDataFrame(talks, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    made = chat.format_conversations(df)
    back = chat.read_turns(made)
    got = sorted(((r.conv, r.turn, r.role, r.text) for r in back.collect()), key=str)
    assert got == sorted(((c, t, r or "", x or "") for c, t, r, x in talks), key=str)
    for r in made.collect():
        inner = r.formatted[len(chat.OPEN) : -len(chat.CLOSE)]
        assert not any(mark in inner for mark in chat.CONTROL)
    for r in chat.digest_conversations(back).collect():
        turns = sorted([(t, role or "", x or "") for c, t, role, x in talks if c == r.conv_id])
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        loss = "".join(b for _, a, b in turns if a == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest_conversations(chat.read_turns(chat.format_conversations(df.limit(0)))).count() == 0


def test_chat_layouts(spark):
    records = [
        '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 3}', '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}',
        '{"instruction": "a", "output": "b"}', '{"instruction": "a", "input": "c", "output": "b"}', '{"prompt": "a", "response": "b"}', '{"prompt": "a", "completion": "b"}', '{"other": 1}', "no json", None,
    ]
    df = spark.createDataFrame(list(enumerate(records)), "id bigint, record string")
    got = {}
    for r in chat.turns_from_json(df, "id", "record").orderBy("conv", "turn").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    pair = [("user", "a"), ("assistant", "b")]
    assert got == {0: pair, 1: pair, 2: pair, 3: [("user", "a\nc"), ("assistant", "b")], 4: pair, 5: pair, 6: [(None, None)], 7: [(None, None)], 8: [(None, None)]}
    with pytest.raises(ValueError):
        chat.turns_from_rows(df, "id", "record")
    more = [
        '{"prompt": "x", "messages": [{"role": "user", "content": "a"}]}', '{"system": "s", "prompt": "a", "response": "b"}', '{"system": "s", "instruction": "a", "output": "b", "id": 7}', '{"messages": [{"role": "user", "content": null}]}',
        '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image"}, "b"]}]}', '{"question": "q", "context": "c", "answer": "a", "messages": []}', '{"system": null, "input": "", "instruction": "a", "output": "b"}',
    ]
    got = {}
    for r in chat.turns_from_json(spark.createDataFrame(list(enumerate(more)), "id bigint, record string"), "id", "record").orderBy("conv", "turn").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    assert got == {0: [("user", "a")], 1: [("system", "s"), *pair], 2: [("system", "s"), *pair], 3: [("user", "")], 4: [("user", "a\nb")], 5: [("user", "c\nq"), ("assistant", "a")], 6: pair}
    assert chat.turns_from_json(df.limit(0), "id", "record").count() == 0


def test_chat_odd_records(spark):
    deep = "[" * 100_000 + "]" * 100_000
    records = [
        '{"messages[]": {"role": "user", "content": "a"}}', '{"messages": [{"role": "user", "content": "\\ud83d"}, {"role": "a\\udc00", "content": "\\ud83d\\ude00"}]}', '{"prompt": ' + deep + ', "response": "b"}',
        '{"messages": [{"role": "model", "content": 3}, "loose", {"role": null, "content": null}], "text": "x", "role": "y"}', '{"instruction": "a", "output": ' + "9" * 5000 + "}", '{"prompt": "' + "long " * 100_000 + '", "response": null}', "", "[]",
    ]
    df = spark.createDataFrame([(None if i == 7 else i, r) for i, r in enumerate(records * 2)], "id bigint, record string").withColumn("turn", F.lit("clash"))
    got = {}
    for r in chat.turns_from_json(df, "id", "record").orderBy("conv", "turn").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    none = [(None, None)]
    assert got[0] == got[2] == got[4] == got[6] == none and got[1] == [("user", "\ufffd"), ("a\ufffd", "\U0001f600")]
    assert got[3] == [("assistant", "3"), ("", "loose"), ("", "")] and got[5] == none and len(got[None]) == 1
    # turn rows keep their roles, whatever other columns there are
    rows_ = spark.createDataFrame([(1, 0, "human", "a" * 200_000, "p"), (1, 1, "gpt", None, "p"), (1, 1, "gpt", None, "p")], "conv_id bigint, turn bigint, role string, text string, prompt string")
    back = chat.read_turns(chat.format_conversations(rows_))
    assert sorted((r.turn, r.role, len(r.text)) for r in back.collect()) == [(0, "human", 200_000), (1, "gpt", 0), (1, "gpt", 0)]
    assert [(r.n_turns, r.loss_chars) for r in chat.digest_conversations(back).collect()] == [(3, 0)]


# --- op3 -------------------------------------------------------------------------------------------------------------
def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("x.com", "", "block"), ("a.x.com", "/p", "allow"), (None, "/", "block")]
    urls = [None, "", "no scheme", "http://", "http://Example.ORG/es/1?q#f", "http://www.example.org/en/12", "http://example.org/en/2", "https://notexample.org/es/", "ftp://a.x.com/p/q", "ftp://a.x.com/q", "http://x.com", "http://É.org?x://y/", "a://b://c/d", "http://org"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls)], "page_id bigint, url string").withColumn("rule", F.lit(7))
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in urlfilter.judge_urls(df, spark.createDataFrame(rules, urlfilter.RULE_SCHEMA)).collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].translate(upper), m[2]) if m else ("", "")
        fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best[3], best[4] if best else "allow"), r.url
    odd = df.withColumns({c: F.lit(1) for c in ("h", "p", "b_rule", "b_verdict", "short", "digest", "tried", "r_host", "best", "HOST")})
    got = urlfilter.judge_urls(odd, spark.createDataFrame(rules, urlfilter.RULE_SCHEMA))
    assert rows(got.select("page_id", "rule", "verdict")) == rows(urlfilter.judge_urls(df, spark.createDataFrame(rules, urlfilter.RULE_SCHEMA)).select("page_id", "rule", "verdict")) and "b_rule" in got.columns
    long = spark.createDataFrame([(1, "http://example.org/" + "x/" * 50_000)], "page_id bigint, url string")
    assert urlfilter.judge_urls(long, spark.createDataFrame(rules + [("org", "/" + "x/" * n, "block") for n in range(1, 300)], urlfilter.RULE_SCHEMA)).first().rule == "org/" + "x/" * 299
    assert urlfilter.judge_urls(df.limit(0), spark.createDataFrame([], urlfilter.RULE_SCHEMA)).count() == 0


# --- op4, op5 --------------------------------------------------------------------------------------------------------
def test_bpe_as_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    df = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id bigint, text string").withColumn("IDS", F.lit(0))
    for r in bpe.roundtrip(df, BPE).collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == t.decode(ids, skip_special_tokens=False) == (r.text or "")
    both = bpe.decode_ids(bpe.encode_texts(df, BPE), BPE)
    assert both.where("decoded <> coalesce(text, '')").count() == 0
    assert bpe.roundtrip(df.limit(0), BPE).count() == 0
    assert bpe.ByteBPE(BPE).decode(np.array([159, 50256], "<u4").tobytes()).endswith("<|endoftext|>")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_as_the_library(spark, name, monkeypatch):
    path = tokenizer_path(name)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumn("n_tokens", F.lit("old"))
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda x: len(model.encode(x))
    else:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        count = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    for r in tokencount.count_tokens(df, path).collect():
        n = count(r.text or "")
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
    assert tokencount.count_tokens(df.limit(0), path).count() == 0
    twice = tokencount.count_tokens(df.union(df).select("text"), path)
    assert twice.count() == 2 * len(TEXTS) and twice.distinct().count() == len(TEXTS)
    # long texts are split for every kind of vocabulary, and split texts count as whole ones
    call, boundary = tokencount.counter(path)
    assert boundary is not None
    from vigil.llm._text import batches_by_bytes

    rnd = random.Random(8)
    bits = ["Word ", "It's 4x ", "ünd ", "a  b ", "\n", "<|endoftext|> ", "日本 ", "e\u0301 x\u0300 ", "1 2 ", "A ", "., "]
    for text in ["".join(rnd.choices(bits, k=60)) for _ in range(300)]:
        got = [piece for part in batches_by_bytes([text], 10**9, 20, boundary) for _, piece in part]
        assert len(got) > 1 and sum(call(got)) == count(text), text


def test_pieces_cut_at_word_ends():
    from vigil.llm._text import batches_by_bytes, pieces

    words = bpe.ByteBPE(BPE).pattern
    for text in TEXTS[1:]:
        assert "".join(pieces(text, 5)) == text
        assert [w for p in pieces(text, 5) for w in words.findall(p)] == words.findall(text)
    assert [[i for i, _ in b] for b in batches_by_bytes(["aa", "bb", "cc"], 4, 10)] == [[0, 1], [2]]
    sizes = [sum(len(p.encode()) for _, p in b) for b in batches_by_bytes(["é" * 9, "a" * 3, "日" * 40, "b" * 500, ""] * 20, 1000, 100)]
    assert max(sizes) < 1.6 * min(sizes[:-1])
    assert list(batches_by_bytes([], 4, 10)) == [] and list(batches_by_bytes(["", ""], 4, 10)) == [[(0, ""), (1, "")]]


# --- op6 -------------------------------------------------------------------------------------------------------------
def test_shards_are_exact(spark):
    df = spark.range(1003, numPartitions=5).withColumn("slot", F.lit("x")).withColumn("place", F.col("id") % 3)
    got = sharding.shard_rows(df, shards=16, cell_rows=10)
    assert got.columns == ["id", "place", "shard", "slot"]
    by = {}
    for r in got.collect():
        by.setdefault(r.shard, []).append((r.slot, r.id))
    assert sorted(by) == list(range(16)) and {len(x) for x in by.values()} == {62, 63}
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in by.values())
    assert sorted(i for x in by.values() for _, i in x) == list(range(1003))
    assert rows(got) == rows(sharding.shard_rows(df, shards=16, cell_rows=10))  # the same in every run
    assert sharding.shard_rows(df.limit(0)).count() == 0
    assert sorted(r.shard for r in sharding.shard_rows(df.limit(3)).collect()) == [0, 1, 2]


def test_shards_against_a_plain_version(spark):
    """Every row's shard and slot: the whole matrix at once, permutations by numpy, and ranks by the same hashes."""
    texts = [None, "", "same", "same", "long " * 20_000] * 41
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(4, "id").sortWithinPartitions("id")
    h = lambda seed: F.xxhash64(F.lit(seed), F.col("place"))
    all_rows = df.withColumn("place", F.monotonically_increasing_id()).select("id", "place", h(17).alias("order"), h(18).alias("cell")).collect()
    by_part: dict = {}
    for r in sorted(all_rows, key=lambda r: r.place):
        by_part.setdefault(r.place >> 33, []).append(r)
    counts, n = [len(x) for x in by_part.values()], len(texts)

    def matrix(low, high, places):
        if high - low == 1:
            return [places]
        mid = (low + high) // 2
        left = np.random.default_rng([17, low, high]).multivariate_hypergeometric(places, sum(counts[low:mid]), method="marginals")
        return matrix(low, mid, left) + matrix(mid, high, places - left)

    shards = 7
    dealt: dict = {s: [] for s in range(shards)}
    cells = -(-n // (shards * 10))
    for i, (row, part) in enumerate(zip(matrix(0, len(counts), np.array([n // shards + (s < n % shards) for s in range(shards)])), by_part.values())):
        for s, r in zip(np.random.default_rng([17, i]).permutation(np.repeat(np.arange(shards), row)).tolist(), part):
            dealt[s].append((r.cell % cells, r.order, r.place, r.id))
    want = sorted((i, s, slot) for s, x in dealt.items() for slot, (*_, i) in enumerate(sorted(x)))
    assert sorted((r.id, r.shard, r.slot) for r in sharding.shard_rows(df, shards=shards, cell_rows=10).collect()) == want
    assert len(want) == n


def test_matrix_has_its_margins_and_law():
    counts, places = np.array([5, 0, 7, 1, 20]), np.array([10, 3, 20])
    seen = []
    for seed in range(400):
        m = np.array([sharding.matrix_row(counts, places, i, seed) for i in range(5)])
        assert (m.sum(1) == counts).all() and (m.sum(0) == places).all() and (m >= 0).all()
        seen.append(m)
    assert np.abs(np.mean(seen, 0) - np.outer(counts, places) / 33).max() < 0.35
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(rng, 3 * 10**9, 10**9, 1000) for _ in range(2000)]
    assert abs(np.mean(big) - 750) < 2 and abs(np.std(big) - 13.69) < 1.2


# --- op7 -------------------------------------------------------------------------------------------------------------
def brute_components(docs, num, den):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        n = len(sets[i] & sets[j])
        if n and den * n >= num * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            up[b] = a
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def test_near_duplicates_brute_force(spark, monkeypatch):
    num, rnd = 80, random.Random(7)
    word = lambda: "".join(rnd.choices("abcdeFGé", k=4))
    shared = " ".join(word() for _ in range(30))
    docs = [None, "", "  \n", "one two", "One  TWO", "one two three four five", "ONE two three\tfour five"]
    for size in (12, 60, 300):
        base = [word() for _ in range(size)]
        for _ in range(40):
            x = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                x[rnd.randrange(size)] = word()
            docs.append(" ".join(x))
    docs += [" ".join([shared, *(word() for _ in range(rnd.randint(1, 80)))]) for _ in range(60)]
    rnd.shuffle(docs)
    docs = list(enumerate(docs, 5))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("digest", F.lit(1))
    want = brute_components(docs, num, 100)
    assert sorted(map(tuple, neardup.near_duplicates(df, threshold=(num, 100)).collect())) == want
    # lists and groups that are dealt into several blocks give the same
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SHORT", 4)
    assert sorted(map(tuple, neardup.near_duplicates(df.repartition(3), threshold=(num, 100)).collect())) == want


def test_a_large_group_is_dealt_a_few_times(spark, monkeypatch):
    """Near copies of one template settle inside blocks and by one of each part, so that the rest of the list is small."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SHORT", 4)
    rnd, dealt = random.Random(9), []
    template = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(480):
        words = list(template)
        words[rnd.randrange(300)] = f"own{i}"
        texts.append((i, " ".join(words)))
    far = [(1000 + i, " ".join(template[:60] + [f"z{i}x{j}" for j in range(200)])) for i in range(40)]
    for name in ("_one_of_each", "_rest_dealt"):
        made = getattr(neardup, name)
        monkeypatch.setattr(neardup, name, lambda df, made=made: dealt.append(made(df).count()) or made(df))
    rows_ = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(texts + far, "doc_id bigint, text string")).collect()}
    assert all(rows_[i] == 0 for i in range(480)) and all(rows_[i] == i for i, _ in far)
    assert sum(dealt) < 10 * 520


def test_pairs_counted_together(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [[np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(40)] for _ in "ab"]
    got = neardup.common_of_pairs(*[[s.tobytes() for s in side] for side in sets])
    assert got.tolist() == [len(np.intersect1d(a, b)) for a, b in zip(*sets)]


def test_near_duplicates_odd_tables(spark):
    schema = "doc_id bigint, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = neardup.near_duplicates(spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (4, None)], schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 3, True), (3, 1, 3, True), (3, 1, 3, True), (4, 0, 4, True)], key=str)


def test_near_duplicates_of_repeated_ids(spark):
    """Rows of one id are one document with the links of all its texts."""
    v, w, x = (" ".join(f"{c}{i}" for i in range(40)) for c in "vwx")
    made = [(3, w), (3, v), (5, v + " more"), (6, w + " more"), (7, v), (7, x), (9, x + " more"), (8, "alone here"), (8, "alone here"), (8, None)]
    got = neardup.near_duplicates(spark.createDataFrame(made, "doc_id bigint, text string").repartition(3)).collect()
    assert len(got) == len(made) and {(r.doc_id, r.component_id) for r in got} == {(i, 3) for i in (3, 5, 6, 7, 9)} | {(8, 8)}


def test_pair_estimates_are_those_of_blocks():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 30)).astype(np.uint64)) for _ in range(40)]
    n = np.array([len(s) + (i % 3 == 0) * 9 for i, s in enumerate(sets)])
    whole = neardup.estimated(sets, sets, n, n)
    i, j = map(np.ravel, np.indices(whole.shape))
    pairs = neardup.pair_estimates([sets[k].tobytes() for k in i], [sets[k].tobytes() for k in j], n[i], n[j])
    assert np.allclose(pairs, whole.ravel()) and len(neardup.pair_estimates([], [], n[:0], n[:0])) == 0


def test_large_groups_settle_or_part(spark, monkeypatch):
    """One candidate group of several blocks: a large part, small parts apart, and parts that only blocks outside reveal."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    docs = []
    for c in range(4):  # clusters that share about 70 %, each of near copies, and some that drop out
        own = base[:84] + [f"c{c}_{i}" for i in range(16)]
        for _ in range(40 if c == 0 else 9):
            x = list(own)
            x[rnd.randrange(100)] = f"r{rnd.random()}"
            docs.append(" ".join(x))
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "id bigint, text string")
    ids = [i for i, _ in docs]
    groups = spark.createDataFrame([(i, 0, 96) for i in ids], "node bigint, component bigint, n bigint")
    candidates = spark.createDataFrame([(0, i) for i in ids[1:]], "a bigint, b bigint")  # a star: the others' own links are not among them
    want = {i: c for i, _, c, _ in brute_components(docs, 85, 100)}
    got = dict(components.connected_components(neardup.confirmed_links(df, groups, candidates, (85, 100), 5)).collect())
    assert {i: got.get(i, i) for i in ids} == want and 4 < len(set(want.values())) < 20


def test_near_duplicates_few_members_of_a_wide_list(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SHORT", 4)
    none = np.zeros(0, np.uint64)
    some = [np.arange(3, dtype=np.uint64), np.arange(4, dtype=np.uint64)]
    assert neardup.estimated([], some, np.array([]), np.array([3, 4])).shape == (0, 2) and neardup.estimated(some, [none][:0], np.array([3, 4]), np.array([])).shape == (2, 0)
    # all hold one value; a filler of 32 values has rarer ones of its own partners, so few come to the wide list as members
    rnd = random.Random(3)
    value = lambda: rnd.randrange(1 << 40, 1 << 62)
    hot = [value() for _ in range(32)]
    made, i = [], 0
    for _ in range(40):  # pairs of fillers: 31 values of the two alone, and one that all hold
        own = [value() for _ in range(31)]
        for _ in range(2):
            made.append((i, 1, 32, np.sort(np.array([*own, hot[0]], np.uint64)).tobytes()))
            i += 1
    for k in (1, 2, 3):  # and few sets that have only wide values in common with any other
        for _ in range(2):
            made.append((i, 1, 32, np.sort(np.array(hot[:31] + [value()], np.uint64)).tobytes()))
            i += 1
    df = spark.createDataFrame(made, "id bigint, k int, n bigint, sketch binary")
    got = dict(components.connected_components(neardup.candidate_links(df, 0.8)).collect())
    assert got == {j: j - j % 2 if j < 80 else 80 for j in range(86)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 130)] + [(7, 130), (1, 2), (2, 3), (3, 1), (5, 5)]
    got = dict(components.connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert got == {7: 7, **{i: 7 for i in range(100, 131)}, 1: 1, 2: 1, 3: 1}


# --- op8 -------------------------------------------------------------------------------------------------------------
def test_mixing_meets_the_targets(spark, monkeypatch):
    rnd = random.Random(2)
    docs = [(i, " ".join(["w"] * rnd.randint(1, 30)), rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["hot"] * 6 + ["a", "b"]), "t" + str(i % 2)) for i in range(3000)] + [(9999, None, "en", "a", "t0")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, topic string").withColumn("weight", F.lit("old"))
    target = {"source": {"hot": 0.4, "a": 0.4, "b": 0.2}}
    for cells in (mixing.DRIVER_CELLS, 3):  # on the driver, and as a DataFrame
        got = mixing.mix(df, targets=target, driver_cells=cells, tokenizer=BPE).cache()
        mass = dict(got.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("probability"))).collect())
        total = sum(mass.values())
        assert all(abs(mass[k] / total - v) < 1e-3 for k, v in target["source"].items())
        assert got.agg(F.max("probability")).first()[0] <= 1 and got.count() == 3001
        kept = got.where("sampled").agg(F.sum("n_tokens")).first()[0]
        assert abs(kept - total) < 0.15 * total
        assert got.where("doc_id = 9999").first().n_tokens == 0
        # a budget is met by the expectation, though no document has a probability above 1
        got = mixing.mix(df, targets=target, driver_cells=cells, tokenizer=BPE, budget=0.9)
        kept, total = got.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).first()
        assert abs(kept - 0.9 * total) < 1e-6 * total and got.agg(F.max("probability")).first()[0] <= 1
    assert mixing.mix(df.limit(0), tokenizer=BPE).count() == 0
    with pytest.raises(ValueError, match="n_tokens"):
        mixing.mix(df)


def test_mixing_paths_agree(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(["w"] * rnd.randint(1, 30)), rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randrange(2)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, topic int").withColumn("n_tokens", F.when(F.col("doc_id") != 5, F.size(F.split("text", " "))))
    for targets in (None, {"source": {"hot": 0.3, "a": 0.5, None: 0.2, "absent": 0.1}, "topic": {0: 0.6, 1: 0.4}}):
        one, two = ({r.doc_id: r for r in mixing.mix(df, ("source", "topic"), targets, driver_cells=n).collect()} for n in (mixing.DRIVER_CELLS, 3))
        assert all(abs(one[i].weight - two[i].weight) < 1e-7 and abs(one[i].probability - two[i].probability) < 1e-7 and one[i].sampled == two[i].sampled for i in one) and len(one) == len(two) == 400
        if targets:
            assert all((two[i].weight == 0) == (s == "b") for i, _, s, _ in docs)
            mass = dict.fromkeys(["hot", "a", None], 0.0)
            for r in two.values():
                if r.source != "b":
                    mass[r.source] += r.n_tokens * r.weight
            assert all(abs(mass[k] / sum(mass.values()) - targets["source"][k]) < 1e-6 for k in mass)


def test_mixing_reports_targets_that_contradict(spark):
    df = spark.createDataFrame([(1, "a b", "en", "x", "t"), (2, "a", "de", "y", "t")], "doc_id bigint, text string, lang string, source string, topic string")
    clash = {"lang": {"en": 0.9, "de": 0.1}, "source": {"x": 0.1, "y": 0.9}}
    with pytest.warns(RuntimeWarning, match="not settled"):
        mixing.mix(df, targets=clash, tokenizer=BPE)
    cells = df.groupBy("lang", "source").agg(F.sum(F.lit(1.0)).alias("mass"))
    with pytest.warns(RuntimeWarning, match="not settled"):
        mixing._rake_frame(cells, ["lang", "source"], clash, {}, rounds=2)
    for n in (mixing.DRIVER_CELLS, 1):
        with pytest.raises(ValueError, match="no category"):
            mixing.mix(df, targets={"lang": {"fr": 1.0}}, driver_cells=n, tokenizer=BPE)


def test_rake_against_plain_loops():
    rng = np.random.default_rng(0)
    mass = rng.random((3, 4))
    a, b = np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4])
    x = mass / mass.sum()
    for _ in range(2000):
        x = x * (a / x.sum(1))[:, None]
        x = x * (b / x.sum(0))
    i, j = np.indices(mass.shape)
    w = mixing.rake(mass.ravel(), [i.ravel(), j.ravel()], [a, b])
    assert np.abs((mass.ravel() * w).reshape(3, 4) - x).max() < 1e-9


def plain_topics(texts, langs):
    """fit_topics by plain loops over all texts at once."""
    counts = np.zeros((len(texts), topics.BUCKETS))
    for i, t in enumerate(texts):
        for w in (t or "").split(" "):
            counts[i, zlib.crc32(w.strip(" .,;:!?()[]{}<>\"'|*#-_").lower().encode()) % topics.BUCKETS] += 1
    has = np.array([bool(t and t.strip()) for t in texts])
    v = np.rint(4096 * np.sqrt(counts / counts.sum(1, keepdims=True)))
    means = {g: v[[i for i in range(len(texts)) if langs[i] == g and has[i]]].mean(0).astype(np.float32) for g in set(langs)}
    x = np.array([np.rint(v[i] - means[langs[i]]) for i in range(len(texts))])
    centres, bias = np.random.default_rng(5).standard_normal((topics.TOPICS, topics.BUCKETS)), np.zeros(topics.TOPICS)
    for _ in range(topics.ROUNDS):
        at = np.array([np.argmax([row @ c - b for c, b in zip(centres, bias)]) for row in x])
        centres = np.array([x[has & (at == k)].mean(0) if (has & (at == k)).any() else centres[k] for k in range(topics.TOPICS)])
        sizes = np.array([(has & (at == k)).sum() for k in range(topics.TOPICS)])
        bias = np.where(sizes > 0, (centres**2).sum(1) / 2, np.inf)
    centres = centres[np.argsort(-sizes, kind="stable")][: (sizes > 0).sum()]
    return [f"topic {1 + int(np.argmax(row @ centres.T - (centres**2).sum(1) / 2))}" if h else "none" for row, h in zip(x, has)]


def test_mixing_query_against_plain_loops(spark):
    """The rows of op8_mixing from library token counts, plain k-means, plain raking and the hash draw."""
    from tokenizers import Tokenizer

    from vigil.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    tokens = [len(x.ids) for x in Tokenizer.from_file(BPE).encode_batch([d.text or "" for d in docs], add_special_tokens=False)]
    named = plain_topics([d.text for d in docs], [d.lang for d in docs])
    cells: dict = {}
    for d, t, n in zip(docs, named, tokens):
        cells[d.source, d.lang, t] = cells.get((d.source, d.lang, t), 0) + n
    total = sum(cells.values())
    x = {c: n / total for c, n in cells.items()}
    share = lambda k, y: {name: sum(v for c, v in y.items() if c[k] == name) for name in {c[k] for c in y}}
    want = [mixing.tempered(share(k, cells), mixing.TEMPERATURES[m]) for k, m in enumerate(("source", "lang", "topic"))]
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            have = share(k, x)
            x = {c: v * want[k][c[k]] / have[c[k]] if have[c[k]] else v for c, v in x.items()}
    weight = {c: x[c] / (cells[c] / total) if cells[c] else 1.0 for c in cells}
    top = max(weight.values())
    got = {r.doc_id: r for r in queries.op8_mixing(spark, sf).collect()}
    draws = dict(spark.createDataFrame([(d.doc_id,) for d in docs], "id bigint").select("id", F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(1 << 53)) / F.lit(float(1 << 53))).collect())
    assert len(got) == len(docs) == 200
    for d, t, n in zip(docs, named, tokens):
        r, w = got[d.doc_id], weight[d.source, d.lang, t]
        assert (r.source, r.lang, r.topic, r.n_tokens) == (d.source, d.lang, t, n)
        assert abs(r.weight - w) < 1e-6 * max(1, w) and abs(r.probability - min(1, w / top)) < 1e-6
        assert r.sampled == (draws[d.doc_id] < r.probability)


def test_mixing_odd_rows(spark):
    docs = [(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (1, "other words", "en", "x"), (None, "", None, None), (None, None, None, None), (4, "  \n", "de", "y"), (5, "w" * 50_000 + " word" * 50_000, "de", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").withColumns({"vector": F.lit(1), "mean": F.lit("m"), "G": F.lit(2), "cell_lang": F.lit(3), "probability": F.lit("old")})
    got = mixing.mix(df, tokenizer=BPE)
    assert set(got.columns) == {"doc_id", "text", "lang", "source", "vector", "mean", "G", "cell_lang", "n_tokens", "topic", "weight", "probability", "sampled"}
    back = got.collect()
    assert sorted(((r.doc_id, r.text, r.lang, r.source, r["vector"], r["mean"]) for r in back), key=str) == sorted(((*d, 1, "m") for d in docs), key=str)
    assert {r.topic for r in back if not (r.text or "").strip()} == {"none"} and all(r.weight == 1 for r in back if r.n_tokens == 0)
    assert len({(r.sampled, r.topic) for r in back if r.text == "a b c"}) == 1  # repeated rows alike


# --- op9 -------------------------------------------------------------------------------------------------------------
def plain_features(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = list(zip(w, w[1:], w[2:]))
    cover = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_quality_features_and_em(spark):
    rnd = random.Random(4)
    bits = ["a", "the", "B!", "x#", "|", "\n", "same line\n", " ", "\t", "é", "\x85", "日本"]
    texts = [None, "", "\n\n", "a b c a b c", "a a a a"] + ["".join(rnd.choice(bits) + " " * rnd.randint(0, 1) for _ in range(rnd.randint(0, 90))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("kept", F.lit("?"))
    for r in quality.judge_quality(df).collect():
        f = plain_features(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == f, r.text
        assert r.base_failed == (f[0] < 50 or 100 * f[4] > 50 * f[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert quality.judge_quality(df.limit(0)).count() == 0
    long = np.arange(10, dtype=np.int64)
    assert quality.repeated_words(np.r_[long, long[:4]], 2_000_000) == quality.repeated_words(np.r_[long, long[:4]], 10) == 8


def test_em_finds_planted_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(40_000) < 0.75
    votes = np.full((40_000, 4), quality.ABSTAIN)
    for r, (right, says) in enumerate([(0.95, 0.9), (0.9, 0.8), (0.8, 0.7), (0.7, 0.6)]):
        v = np.where(rng.random(40_000) < right, good, ~good).astype(int)
        votes[:, r] = np.where(rng.random(40_000) < says, v, quality.ABSTAIN)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = quality.estimate(patterns, counts.astype(float))
    assert abs(m.prior - 0.75) < 0.02
    assert np.abs(np.array([m.accuracy(r) for r in range(4)]) - [0.95, 0.9, 0.8, 0.7]).max() < 0.03


def plain_em(votes_, rounds, prior=0.8):
    """EM over single documents; a bound that is broken is kept by pooling its vote over both classes."""
    chance = [[{0: 0.4, 1: 0.1, -1: 0.5}, {0: 0.1, 1: 0.4, -1: 0.5}] for _ in votes_[0]]
    for _ in range(rounds):
        weight = []
        for v in votes_:
            bad, good = 1 - prior, prior
            for r, x in enumerate(v):
                bad, good = bad * chance[r][0][x], good * chance[r][1][x]
            weight.append(good / (bad + good))
        prior = min(max(sum(weight) / len(votes_), 0.02), 0.98)
        for r in range(len(chance)):
            n = [{x: 0.5 + sum(w if y else 1 - w for v, w in zip(votes_, weight) if v[r] == x) for x in (0, 1, -1)} for y in (0, 1)]
            p = [{x: c / sum(m.values()) for x, c in m.items()} for m in n]
            broken = [x for x, (a, b) in ((0, (0, 1)), (1, (1, 0))) if p[a][x] < p[b][x]]
            if broken:
                assert len(broken) == 1
                x = broken[0]
                rate = (n[0][x] + n[1][x]) / (sum(n[0].values()) + sum(n[1].values()))
                p = [{z: rate if z == x else c * (1 - rate) / (sum(m.values()) - m[x]) for z, c in m.items()} for m in n]
            chance[r] = p
    return prior, chance


def test_quality_em_is_plain_em(spark):
    rnd = random.Random(8)
    docs = []
    for _ in range(400):
        good = rnd.random() < 0.7
        docs.append(tuple(rnd.choices([0, 1, -1], [0.1, 0.5, 0.4] if good else [0.5, 0.1, 0.4])[0] for _ in range(4)) + (rnd.choice([0, 1, -1]), rnd.choice([1, -1])))
    count = {d: docs.count(d) for d in set(docs)}
    patterns, counts = np.array(list(count)), np.array(list(count.values()), float)
    trace = []
    model = quality.estimate(patterns, counts, rounds=25, trace=trace)
    prior, chance = plain_em(docs, 25)
    assert abs(model.prior - prior) < 1e-9
    for table, plain in zip(model.chance, chance):
        for y in (0, 1):
            assert np.allclose(table[y], [plain[y][0], plain[y][1], plain[y][-1]], atol=1e-9) and abs(sum(table[y]) - 1) < 1e-12
    assert all(b >= a - 1e-9 for a, b in zip(trace, trace[1:]))


def test_votes_are_fitted_under_their_order():
    rng = np.random.default_rng(0)
    for _ in range(60):
        bad, good = rng.integers(0, 50, 3) + 0.5, rng.integers(0, 50, 3) + 0.5
        p, q = quality.likeliest(bad, good)
        value = bad @ np.log(p) + good @ np.log(q)
        for _ in range(100):
            t = rng.random() * 0.1
            a, b = (1 - t) * p + t * rng.dirichlet([1, 1, 1]), (1 - t) * q + t * rng.dirichlet([1, 1, 1])
            assert a[0] < b[0] or b[1] < a[1] or bad @ np.log(a) + good @ np.log(b) <= value + 1e-9


def test_quality_against_labels(spark):
    """Held out: the labels are not used by the model."""
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge_quality(docs.join(labels, "doc_id"), keep_text=False).where("n_words >= 50")
    right = got.where("(posterior >= 0.5) = (quality = 1)").count() / got.count()
    assert right > 0.97


# --- op10 ------------------------------------------------------------------------------------------------------------
def test_warc_round_trip(spark, tmp_path):
    big, big2 = "é" * 600, "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 60
    pages = [(1, "http://b.example/x?y", big), (5, "http://www.a.example/%0A \n\r%", big), (3, None, big), (4, "http://a.example/", "small"), (6, "u://a", "small"), (7, "http://a.example/", None), (8, "x", big2), (9, "x", big2), (None, "x", big2), (9, "x", big2)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("sha1", F.lit("clash"))
    got = warc.archive_pages(df.repartition(3)).collect()
    want = []
    for i, u, h in pages:
        h = (h or "").encode()
        head = max((j for j, _, x in pages if j is not None and (x or "").encode() == h), default=None) if len(h) >= 1000 else i
        old = i is not None and i != head
        want.append((i, u, len(h), hashlib.sha1(h).hexdigest(), "revisit" if old else "response", head if old else None))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    order = [(r.url_key, r.ts) for r in got]
    assert order == sorted(order)  # partition after partition
    assert warc.archive_pages(df.limit(0)).count() == 0
    # archives are full by bytes: large payloads and many small ones alike
    many = spark.createDataFrame([(i, "http://h/", ("x" if i % 2 else "é") * (30_000 if i % 10 == 0 else 10) + str(i)) for i in range(200)] + [(999, None, "z" * 3_000_000)], "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "archives")
    warc.write_archives(warc.plan_captures(many), path, archive_bytes=100_000)
    lengths = warc.index_runs(spark, path).groupBy("archive").agg(F.sum("length").alias("n"), F.max("length").alias("most")).collect()
    assert len(lengths) > 3 and all(r.n <= 100_000 * 1.1 + r.most for r in lengths)
    back = warc.merge_runs(warc.index_runs(spark, path)).collect()
    assert sorted(r.page_id for r in back) == [*range(200), 999] and max(r.payload_bytes for r in back) == 3_000_000
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7])
def test_loser_tree(k):
    rnd = random.Random(k)
    runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(20))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
