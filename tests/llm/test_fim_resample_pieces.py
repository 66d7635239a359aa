"""Fill-in-the-middle, importance resampling and SentencePiece: plain versions, exact round trips, odd tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import fim, piecebpe, resample
from vigil.llm.queries import tokenizer_path

PIECES = tokenizer_path("piece_bpe_32k.model")


def draws(seed, i):
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    return [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]


# --- op11 ------------------------------------------------------------------------------------------------------------
def plain_fim(i, text):
    text, (h1, h2, h3, h4) = text or "", draws(1, i)
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fim_as_slices(spark):
    rnd = random.Random(3)
    bits = ["a", "é", "日", "😀", "<", ">", "P", "S", "M", "<S", "<M>", "\n", " ", "\x00"]
    texts = [None, "", "<P>", "x" * 300_000, "日😀" * 40_000, *("".join(rnd.choices(bits[:10] + bits[11:], k=rnd.randint(0, 30))) for _ in range(400)), *("".join(rnd.choices(bits, k=9)) for _ in range(50))]
    rows = [*enumerate(texts), (None, "null id"), (7, "same"), (7, "same")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"FORM": F.lit(1), "n": F.lit("old"), "extra": F.lit(2)})
    made = fim.restored(fim.transform(df))
    got = [(r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in made.collect()]
    want = [(i, t, *plain_fim(i, t), t or "") for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str) and {g[3] for g in got} == {"plain", "psm", "spm"}
    assert set(made.columns) == {"doc_id", "text", "extra", *fim.NEW, "restored"}
    assert fim.restored(fim.transform(df.limit(0))).count() == 0


def test_rotations_come_back():
    marks = [b"<P>", b"<S>", b"<M>"]
    for text in (b"", b"a", "é日x".encode(), b"<S", b"<<P"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                for form in ("psm", "spm"):
                    assert fim.restore(fim.arrange(text, a, b, form, marks), form, marks) == text
    buf = bytearray(b"..abcdeXY..")
    fim.rotate(buf, 2, 7, 9)
    assert buf == b"..XYabcde.."
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("aa", "ab", "c"), ("xy", "yz", "q")):
        with pytest.raises(ValueError):
            fim.check_marks(bad)
    with pytest.raises(ValueError):
        fim.restore(b"nothing", "psm", marks)


# --- op12 ------------------------------------------------------------------------------------------------------------
def test_crc_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    sizes = np.r_[0, 1, 2, 31, 32, 33, 63, 64, 65, 1023, 1024, 1025, 100_000, rng.integers(0, 300, 500)]
    starts = np.r_[np.zeros(13, np.int64), rng.integers(0, 100_000, 500)]
    got = resample.crc32_spans(data, starts, starts + sizes)
    assert got.tolist() == [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, sizes)]
    assert resample.crc32_spans(data, starts[:0], starts[:0]).tolist() == []


def plain_features(text, orders):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in range(orders[0], orders[1] + 1) for i in range(len(words) - k + 1)]


def plain_resample(docs, target, orders, buckets, rate, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in plain_features(text, orders)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text, orders)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    rows, able = [], []
    for at, (i, text) in enumerate(docs):
        words, fs = plain_features(text, orders)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        score = weight + math.floor(-1000 * math.log(-math.log((draws(seed, i)[0] + 0.5) / 4294967296)))
        rows.append([i, len(words), len(fs), weight, score, None])
        able += [(-score, i is None, i or 0, at)] * (len(words) >= least)
    for rank, (*_, at) in enumerate(sorted(able)[: rate * len(able) // 100], 1):
        rows[at][-1] = rank
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("orders", [(1, 1), (1, 3), (2, 2)])
def test_resampling_as_a_loop(spark, orders, monkeypatch):
    monkeypatch.setattr(resample, "BATCH_BYTES", 3000)
    monkeypatch.setattr(resample, "HASH_BYTES", 256)
    rnd = random.Random(2)
    word = lambda: rnd.choice(["a", "B", "word", "É", "日本", "x1", "l" * 70, "Ünder"])
    text = lambda n: "".join(word() + rnd.choice([" ", ", ", "\n", "\t", "-"]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 12))) for i in range(160)] + [(500, None), (501, ""), (502, "!?"), (503, text(4000)), (504, "y" * 9000 + " z q r"), (None, text(9)), (None, text(9)), (7, text(8))]
    target = [text(5), None, "", "word word x1"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"rank": F.lit("old"), "extra": F.lit(1), "place": F.lit(0), "_at": F.lit(0)})
    out = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), orders=orders, buckets=97, rate=30, min_words=3, seed=5)
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=str)
    assert got == plain_resample(docs, target, orders, 97, 30, 3, 5)
    assert "extra" in out.columns and "text" not in out.columns


def test_resampling_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(i, "a b c d e") for i in [1, 1, 1, None, 2]], "doc_id bigint, text string")
    assert resample.resample(none, some).count() == 0
    few = resample.resample(some, none, min_words=5, rate=100).collect()  # repeated rows take a rank each
    assert sorted(r["rank"] for r in few) == [1, 2, 3, 4, 5]
    assert [r["rank"] for r in resample.resample(some, none, min_words=9).collect()] == [None] * 5


# --- op13 ------------------------------------------------------------------------------------------------------------
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_as_the_library(spark, monkeypatch):
    rnd = random.Random(6)
    bits = [*"abcdeéß日本語 の\n\t'<0x>=-_.1234", "  ", "\x00", "ﬁ", "　", "😀", "the", "ing", "tion", "▁", "▁▁▁", "        ", "...", "http://"]
    odd = [None, "", " ", "  ", "   a   ", "▁a", "\x00a", "<s></s><unk><0x0A>", " " * 3000, "=" * 3000, "x" * 20_000, "word " * 3000, "ab" * 5000, "é" * 700, "日本語" * 2000]
    texts = odd + ["".join(rnd.choices(bits, k=rnd.randint(1, 60))) for _ in range(3000)]
    lib = library()
    for sizes in ((1_000_000, 500_000, 4_000_000, 16), (300, 100, 1000, 1)):
        for name, value in zip(("BATCH_BYTES", "PIECE_BYTES", "CACHE_CHARS", "QUEUE"), sizes):
            monkeypatch.setattr(piecebpe, name, value)
        model = piecebpe.PieceBPE(PIECES)
        got = model.encode([t or "" for t in texts])
        want = lib.encode([t or "" for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
        assert [model.decode(g) for g in got] == lib.decode(want)
    monkeypatch.undo()
    df = spark.createDataFrame([*enumerate(texts[:200]), (0, texts[40]), (0, texts[40])], "doc_id bigint, text string").withColumn("IDS", F.lit("old")).withColumn("extra", F.lit(1))
    made = piecebpe.roundtrip(df, PIECES)
    for r in made.collect():
        ids = lib.encode(r.text or "")
        assert (r.ids, r.decoded, r.extra) == (ids, lib.decode(ids), 1)
    apart = piecebpe.decode_ids(piecebpe.encode_texts(df, PIECES), PIECES)
    assert sorted(map(str, apart.collect())) == sorted(map(str, made.select(apart.columns).collect()))
    assert piecebpe.roundtrip(df.limit(0), PIECES).count() == 0


def test_other_models_are_refused(tmp_path):
    with open(PIECES, "rb") as f:
        raw = f.read()
    at = raw.rindex(b"identity") - 2  # the normaliser's name; a character map behind it
    spec = raw[at:] + b"\x12\x01x"
    (tmp_path / "m.model").write_bytes(raw[: at - 2] + b"\x1a" + bytes([len(spec)]) + spec)
    with pytest.raises(ValueError):
        piecebpe.PieceBPE(str(tmp_path / "m.model"))


def test_counting_keeps_chunks_that_come_again(monkeypatch):
    from vigil.llm import bpe, topics
    from vigil.llm.queries import tokenizer_path

    texts = [" ".join(f"often{i % 7} only{n}x{i}  é{i % 3}" for i in range(50)) for n in range(40)]
    plain = bpe.ByteBPE(tokenizer_path("byte_bpe_50k.json"), topics.bucket_of)
    want = plain.count(texts, topics.BUCKETS)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 2000)
    monkeypatch.setattr(bpe, "BATCH_BYTES", 1000)
    small, learned = bpe.ByteBPE(tokenizer_path("byte_bpe_50k.json"), topics.bucket_of), []
    learn = small._learn
    monkeypatch.setattr(small, "_learn", lambda: (learned.extend(small.numbers.fresh), learn()))
    for _ in range(2):
        got = small.count(texts, topics.BUCKETS)
        assert all((a == b).all() for a, b in zip(got, want))
    assert small.encode(texts) == plain.encode(texts)
    assert learned.count(" often3") < 5 and small.chars <= 2000 + 2 * 1000
