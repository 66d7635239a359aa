"""The queries of this subpackage, each over a whole table, and their SQL where SQL can express them."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fim, mixing, neardup, piecebpe, quality, resample, sharding, tokencount, topk, urlfilter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


PROBE_TEXT = "</s>[INST] ok [/INST]"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digest_conversations(chat.read_turns(chat.format_conversations(talks.unionByName(probe))))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, urlfilter.RULE_SCHEMA)
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op4_bpe(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    done = bpe.roundtrip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(tokenizer))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(tokenizer)).drop("text")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    return dealt.select("doc_id", size.alias("size"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=(85, 100))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, tokenizer=tokenizer_path("byte_bpe_50k.json"), keep_text=False).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restored(fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=1, rate=90, spm_rate=20))
    hashed = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashed)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, table(spark, sf_dir, "benchmark"), orders=(1, 1), buckets=10_000, rate=10, min_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_sentencepiece(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    done = piecebpe.roundtrip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(model))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def queries() -> dict:
    own = (op1_topk, op2_chat, op3_url_filter, op4_bpe, op5_token_counts, op6_shards, op7_near_dup, op8_mixing, op9_quality, op10_warc, op11_fim, op12_resample, op13_sentencepiece)
    return {f.__name__: f for f in own}


_OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.r, q.id AS query_id, c.id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
_OP2 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE_TEXT}'),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '(<\\*(\|im_start\|>|\|im_end\|>|s>|/s>)|\[\\*(INST\]|/INST\]))')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + length(role) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
_OP3 = r"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (
  SELECT u.*, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST, length(r_host) DESC) AS n
  FROM u LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
_OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
h AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to FROM h
"""
_OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS sha FROM documents),
h AS (
  SELECT *, CAST('0x' || substr(sha, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(sha, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || substr(sha, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(sha, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
_OP12 = r"""
WITH RECURSIVE bits(b, v, i) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE i = 8),
words AS (
  SELECT kind, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
seen AS (SELECT DISTINCT w FROM words),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, octet_length(encode(w)) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT))),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM seen, crc),
f AS (SELECT kind, id, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM f GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t::DOUBLE + 1) * (ss + 10000) / ((s::DOUBLE + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM counts, totals),
own AS (SELECT id, count(*) AS n, sum(gain) AS g FROM f JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
docs AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM documents LEFT JOIN own ON doc_id = id),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM docs),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
  QUALIFY rank <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20))
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": _OP1, "op2_chat": _OP2, "op3_url_filter": _OP3, "op10_warc": _OP10, "op11_fim": _OP11, "op12_resample": _OP12}
