"""Registered queries over whole tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..lineage import shared_path
from ..operators import imports as M
from ..operators import joins as J
from ..operators import selection as S
from ..operators.evidence import observed_times
from ..sources.tables import Tables
from .prelude import LAUNCHES, SHELL, TELEMETRY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, prelude: str = ""):
    """Registers a function of Tables under its own name, with the SQL of its result."""

    def put(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            # a recursive query brings its own WITH RECURSIVE
            SQL[f.__name__] = (f"WITH {prelude} {sql}" if prelude else sql).strip()
        return f

    return put


HOUR = 3_600_000_000


# --- labels and projections ------------------------------------------------------------------------------------------
@query("SELECT dataset, label, pgm_base, count(*) AS n FROM launches GROUP BY ALL", LAUNCHES)
def launch_counts(t: Tables) -> DataFrame:
    return t.launches.groupBy("dataset", "label", "pgm_base").agg(F.count("*").alias("n"))


@query("SELECT record_id, dataset_label, ai_label, override_label, label FROM shell", SHELL)
def final_label(t: Tables) -> DataFrame:
    return t.shell.select("record_id", "dataset_label", "ai_label", "override_label", "label")


@query("SELECT record_id, pgm_base FROM launches", LAUNCHES)
def program_basename(t: Tables) -> DataFrame:
    return t.launches.select("record_id", "pgm_base")


@query("SELECT dataset || ':' || record_id AS address FROM launches", LAUNCHES)
def record_ids(t: Tables) -> DataFrame:
    return t.launches.select(F.concat_ws(":", "dataset", "record_id").alias("address"))


@query("SELECT record_id, session_id FROM shell", SHELL)
def session_fallback(t: Tables) -> DataFrame:
    return t.shell.select("record_id", "session_id")


@query("SELECT event_id, CASE WHEN k < 10 THEN kind WHEN k < 50 THEN CAST(host AS VARCHAR) ELSE 'other' END AS name FROM telemetry", TELEMETRY)
def alias_coalesce(t: Tables) -> DataFrame:
    missing = F.when(F.col("k") < 50, " - ").otherwise("(null)")
    first = F.when(F.col("k") < 10, F.col("kind")).otherwise(missing)
    second = F.when(F.col("k") < 50, F.col("host").cast("string")).otherwise("")
    return t.telemetry.select("event_id", C.first_usable(first, second, F.lit("other")).alias("name"))


@query("SELECT page_id, CASE WHEN contains(url, 'example.org') THEN 'linux' WHEN regexp_matches(url, '\\.(com|net)/') THEN 'windows' ELSE 'unknown' END AS os FROM pages")
def infer_os(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select("page_id", F.when(url.contains("example.org"), "linux").when(url.rlike(r"\.(com|net)/"), "windows").otherwise("unknown").alias("os"))


@query("SELECT event_id, CASE WHEN k % 3 = 0 THEN 'login-' || k WHEN k % 3 = 1 THEN host || '/' || strftime(make_timestamp(t), '%Y-%m-%d') ELSE 'host-' || host END AS session_key FROM telemetry", TELEMETRY)
def session_key(t: Tables) -> DataFrame:
    login = F.when(F.col("k") % 3 == 0, F.concat(F.lit("login-"), "k"))
    day = F.when(F.col("k") % 3 == 1, F.concat_ws("/", "host", F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd")))
    return t.telemetry.select("event_id", F.coalesce(login, day, F.concat(F.lit("host-"), "host")).alias("session_key"))


@query(
    r"""SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, invocation FROM (
  SELECT conv_id, turn, unnest(parts) AS invocation, unnest(range(len(parts))) AS pos
  FROM (SELECT conv_id, turn, list_filter(list_transform(string_split_regex(text, '[.,\n]+'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM conversations WHERE role = 'user'))"""
)
def explode_invocations(t: Tables) -> DataFrame:
    parts = F.filter(F.transform(F.split("text", r"[.,\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    return t.conversations.where("role = 'user'").select("conv_id", "turn", F.posexplode(parts).alias("pos", "invocation"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'input' WHEN 'view' THEN 'output' WHEN 'signup' THEN 'connect' WHEN 'error' THEN 'close' ELSE 'metadata' END AS kind FROM events")
def event_kind(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for x in ("click", "input", "view", "output", "signup", "connect", "error", "close")])
    return t.events.select("event_id", F.coalesce(names[F.col("event_type")], F.lit("metadata")).alias("kind"))


@query("SELECT event_id, CASE WHEN host > 0 AND k > 0 AND k % 7 <> 0 THEN 'h' || host || ' ' || k || ' t ' || (k * 600) % 70000 END AS endpoints FROM telemetry WHERE k * 600 % 70000 BETWEEN 1 AND 65535 UNION ALL SELECT event_id, NULL FROM telemetry WHERE NOT k * 600 % 70000 BETWEEN 1 AND 65535", TELEMETRY)
def endpoint_tuple(t: Tables) -> DataFrame:
    k = F.col("k")
    port = F.when(k % 7 == 0, F.concat(F.lit("+"), k)).otherwise(k.cast("string"))  # a sign is no digit
    found = M.endpoints(F.when(F.col("host") > 0, F.concat(F.lit("h"), "host")).otherwise(""), port, F.lit("t"), (k * 600) % 70000)
    return t.telemetry.select("event_id", F.concat_ws(" ", found["source"], found["source_port"], found["target"], found["target_port"]).alias("e"), found.alias("f")).select("event_id", F.when(F.col("f").isNotNull(), F.col("e")).alias("endpoints"))


@query("SELECT event_id, CASE WHEN k <> 0 THEN '{0-' || k || '}' END AS id FROM telemetry", TELEMETRY)
def sentinel_nulls(t: Tables) -> DataFrame:
    return t.telemetry.select("event_id", C.usable_id(F.concat(F.lit("{0-"), "k", F.lit("}"))).alias("id"))


@query("SELECT page_id, html AS plain, html || chr(10) || 'é&#' AS decoded FROM pages")
def unwrap_text(t: Tables) -> DataFrame:
    """Whole pages in the wrappings of exports, and their texts again."""
    html = F.col("html")
    escaped = F.replace(F.replace(html, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&#60;"))
    inner = F.regexp_extract(F.to_json(F.struct(escaped.alias("a"))), r'(?s)^\{"a":"(.*)"\}$', 1)
    plain = M.exported_text(F.concat(F.lit("INPUT:  "), inner), json_escapes=True, entities=True, prefixes=("INPUT:",))
    decoded = M.exported_text(F.concat(escaped, F.lit("&#10;&#xE9;&#")), entities=True)
    return t.pages.where("html is not null").select("page_id", plain.alias("plain"), decoded.alias("decoded")).unionByName(t.pages.where("html is null").select("page_id", F.lit(None).cast("string").alias("plain"), F.lit(None).cast("string").alias("decoded")))


@query("SELECT event_id, side, who FROM (SELECT event_id, unnest(['actor', 'child']) AS side, unnest([host, k]) AS who FROM telemetry) WHERE who % 2 = 0", TELEMETRY)
def actor_child_fanout(t: Tables) -> DataFrame:
    rows = F.array(F.struct(F.lit("actor").alias("side"), F.col("host").alias("who")), F.struct(F.lit("child").alias("side"), F.col("k").cast("long").alias("who")))
    return t.telemetry.select("event_id", F.inline(rows)).where("who % 2 = 0")


@query("SELECT event_id, kind, CASE WHEN kind = 'error' AND k > 50 THEN 'malicious' WHEN kind = 'error' THEN 'malicious-group' WHEN kind IN ('view', 'click') THEN 'benign' ELSE 'unknown' END AS label, CASE WHEN kind = 'error' AND k <= 50 THEN host END AS group_id FROM telemetry", TELEMETRY)
def label_ladder(t: Tables) -> DataFrame:
    label = F.when((F.col("kind") == "error") & (F.col("k") > 50), "malicious").when(F.col("kind") == "error", "malicious-group").when(F.col("kind").isin("view", "click"), "benign").otherwise("unknown")
    return t.telemetry.select("event_id", "kind", label.alias("label"), F.when(label == "malicious-group", F.col("host")).alias("group_id"))


# --- filters ---------------------------------------------------------------------------------------------------------
@query("SELECT event_id, host, t FROM telemetry WHERE kind = 'signup' AND k IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)", TELEMETRY)
def process_event_filter(t: Tables) -> DataFrame:
    return t.telemetry.where((F.col("kind") == "signup") & F.col("k").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)).select("event_id", "host", "t")


@query(r"SELECT record_id FROM launches WHERE NOT regexp_matches(pgm, '^(-|null|\(null\)|[a-z]+:)$')", LAUNCHES)
def drop_placeholders(t: Tables) -> DataFrame:
    return t.launches.where(~F.col("pgm").rlike(r"^(-|null|\(null\)|[a-z]+:)$")).select("record_id")


@query("SELECT record_id FROM shell WHERE ai_label IS NULL OR ai_label = 'unknown'", SHELL)
def label_candidates(t: Tables) -> DataFrame:
    return t.shell.where("ai_label is null or ai_label = 'unknown'").select("record_id")


@query("SELECT event_id, CASE WHEN k < 90 THEN k END AS k, CASE WHEN k >= 97 THEN 'empty' WHEN k >= 94 THEN 'no-object' WHEN k >= 90 THEN 'malformed-json' END AS reason, CASE WHEN k >= 90 THEN count(*) OVER (PARTITION BY CASE WHEN k >= 97 THEN 2 WHEN k >= 94 THEN 1 WHEN k >= 90 THEN 0 END) END AS of_reason FROM telemetry", TELEMETRY)
def reject_malformed(t: Tables) -> DataFrame:
    """Records that can be read, and the others with the reason and how many were left out for it."""
    k = F.col("k")
    raw = F.when(k < 90, F.to_json(F.struct("k"))).when(k < 94, '{"k": ').when(k < 97, "[1]").when(k < 98, "  ")
    good, rejects = M.json_records(t.telemetry.select("event_id", raw.alias("raw")), "event_id", "raw", "k int")
    counted = rejects.join(F.broadcast(M.reject_counts(rejects)), "reason").select("event_id", F.lit(None).cast("int").alias("k"), "reason", F.col("n").alias("of_reason"))
    return good.withColumns({"reason": F.lit(None).cast("string"), "of_reason": F.lit(None).cast("long")}).unionByName(counted)


@query("SELECT event_id FROM telemetry WHERE (k % 4, kind) IN ((0, 'click'), (1, 'view'), (2, 'error'))", TELEMETRY)
def exec_attempts(t: Tables) -> DataFrame:
    wanted = t.spark.createDataFrame([(0, "click"), (1, "view"), (2, "error")], "arch int, kind string")
    return t.telemetry.withColumn("arch", F.col("k") % 4).join(F.broadcast(wanted), ["arch", "kind"], "left_semi").select("event_id")


# --- joins -----------------------------------------------------------------------------------------------------------
_INCOMING = ", incoming AS (SELECT pgm, args, max_by(CASE WHEN pos % 3 = 0 THEN 'malicious' ELSE 'benign' END, doc_id * 100000 + pos) AS new_label FROM launches WHERE doc_id % 5 = 0 GROUP BY pgm, args)"


def _incoming(t: Tables) -> DataFrame:
    label = F.when(F.col("pos") % 3 == 0, "malicious").otherwise("benign")
    return t.launches.where("doc_id % 5 = 0").select("pgm", "args", label.alias("label"), (F.col("doc_id") * 100000 + F.col("pos")).alias("seq"))


@query(
    "SELECT record_id, coalesce(new_label, ai_label) AS ai_label, coalesce(override_label, nullif(coalesce(new_label, ai_label), 'unknown'), nullif(dataset_label, 'malicious-group'), 'unknown') AS label FROM launches l LEFT JOIN incoming i ON l.pgm = i.pgm AND l.args = i.args",
    LAUNCHES + _INCOMING,
)
def apply_labels(t: Tables) -> DataFrame:
    return J.apply_labels(t.launches, _incoming(t), ["pgm", "args"]).select("record_id", "ai_label", "label")


@query("SELECT ai_label AS old_label, new_label, count(*) AS n FROM launches l JOIN incoming i ON l.pgm = i.pgm AND l.args = i.args WHERE ai_label IS NOT NULL AND ai_label <> 'unknown' AND ai_label <> new_label GROUP BY ALL", LAUNCHES + _INCOMING)
def label_conflicts(t: Tables) -> DataFrame:
    return J.label_conflicts(t.launches, _incoming(t), ["pgm", "args"])


@query("SELECT t.event_id, e.label AS evidence_label FROM telemetry t LEFT JOIN (SELECT host, k, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'unknown' END AS label FROM telemetry WHERE kind IN ('signup', 'error') GROUP BY host, k) e ON t.host = e.host AND t.k = e.k", TELEMETRY)
def evidence_join(t: Tables) -> DataFrame:
    evidence = t.telemetry.where("kind in ('signup', 'error')").select("host", "k", F.col("kind").alias("label"))
    return J.evidence_join(t.telemetry, evidence, ["host", "k"]).select("event_id", "evidence_label")


@query("SELECT event_id, host IN (SELECT host FROM telemetry WHERE kind = 'error' AND k > 97) AS hit FROM telemetry", TELEMETRY)
def attack_ids_semi(t: Tables) -> DataFrame:
    return J.flag_ids(t.telemetry, t.telemetry.where("kind = 'error' and k > 97"), "host").select("event_id", "hit")


@query("SELECT record_id FROM shell WHERE shell_input NOT IN (SELECT text FROM documents WHERE doc_id % 10 = 0)", SHELL)
def overlap_removed(t: Tables) -> DataFrame:
    reference = t.documents.where("doc_id % 10 = 0").select(F.col("text").alias("shell_input"))
    return t.shell.join(reference, "shell_input", "left_anti").select("record_id")


@query("SELECT a.event_id FROM telemetry a WHERE kind = 'signup' AND NOT EXISTS (SELECT 1 FROM telemetry b WHERE b.kind = 'purchase' AND b.host = a.host AND b.k = a.k)", TELEMETRY)
def creation_without_execution(t: Tables) -> DataFrame:
    x = t.telemetry
    return x.where("kind = 'signup'").join(x.where("kind = 'purchase'").select("host", "k"), ["host", "k"], "left_anti").select("event_id")


_WINDOWS = f", spans AS (SELECT event_id AS span_id, host, t AS start_t, t + {HOUR} * (1 + k % 48) AS end_t FROM telemetry WHERE kind = 'error')"


def _spans(t: Tables) -> DataFrame:
    return t.telemetry.where("kind = 'error'").select(F.col("event_id").alias("span_id"), "host", F.col("t").alias("start_t"), (F.col("t") + HOUR * (1 + F.col("k") % 48)).alias("end_t"))


@query("SELECT event_id, span_id FROM telemetry e JOIN spans s ON e.host = s.host AND e.t BETWEEN s.start_t AND s.end_t", TELEMETRY + _WINDOWS)
def window_range_join(t: Tables) -> DataFrame:
    return J.range_join(t.telemetry, _spans(t), "host", F.col("t"), F.col("start_t"), F.col("end_t"), bucket=24 * HOUR).select("event_id", "span_id")


@query("SELECT event_id, min(span_id) AS span_id FROM telemetry e JOIN spans s ON e.host = s.host AND e.t BETWEEN s.start_t AND s.end_t WHERE kind IN ('click', 'view') GROUP BY event_id", TELEMETRY + _WINDOWS)
def window_member_join(t: Tables) -> DataFrame:
    programs = F.array(F.lit("click"), F.lit("view"))
    hits = J.range_join(t.telemetry, _spans(t).withColumn("programs", programs), "host", F.col("t"), F.col("start_t"), F.col("end_t"), bucket=24 * HOUR)
    return J.first_match(hits.where(F.array_contains("programs", F.col("kind"))), ["event_id"], F.col("span_id")).select("event_id", "span_id")


@query("SELECT event_id, arg_min(span_id, (CASE WHEN span_id % 4 = 0 THEN 0 ELSE 1 END, end_t - start_t, span_id)) AS span_id FROM telemetry e JOIN spans s ON e.host = s.host AND e.t BETWEEN s.start_t AND s.end_t GROUP BY event_id", TELEMETRY + _WINDOWS)
def shortest_window_join(t: Tables) -> DataFrame:
    hits = J.range_join(t.telemetry, _spans(t), "host", F.col("t"), F.col("start_t"), F.col("end_t"), bucket=24 * HOUR)
    return J.best_window(hits, "event_id", "start_t", "end_t", "span_id", F.col("span_id") % 4 == 0)


@query("SELECT event_id, (SELECT arg_min(s.k, (abs(s.t - e.t), s.t, s.k)) FROM telemetry s WHERE s.kind = 'signup' AND s.host = e.host) AS image FROM telemetry e WHERE kind = 'click'", TELEMETRY)
def nearest_time_join(t: Tables) -> DataFrame:
    x = t.telemetry
    states = x.where("kind = 'signup'").select("host", "t", F.col("k").alias("image"))
    return J.nearest_time(x.where("kind = 'click'").select("event_id", "host", "t"), states, "host", "t", "image").select("event_id", "image")


@query("SELECT event_id, (SELECT count(*) FROM telemetry b WHERE b.kind = 'error' AND b.host = e.host AND b.t <= e.t) AS boots FROM telemetry e", TELEMETRY)
def boot_epoch_asof(t: Tables) -> DataFrame:
    x = t.telemetry
    return J.asof_count(x.select("event_id", "host", "t"), x.where("kind = 'error'"), "host", "t", "boots").select("event_id", "boots")


@query("SELECT event_id, (SELECT arg_max(s.k, (s.t, s.k)) FROM telemetry s WHERE s.kind = 'purchase' AND s.host = e.host AND s.t < e.t) AS state FROM telemetry e WHERE kind = 'view'", TELEMETRY)
def latest_state_asof(t: Tables) -> DataFrame:
    x = t.telemetry
    states = x.where("kind = 'purchase'").groupBy("host", "t").agg(F.max("k").alias("state"))
    return J.asof_last(x.where("kind = 'view'").select("event_id", "host", "t"), states, "host", "t", ["state"]).select("event_id", "state")


@query(
    """WITH RECURSIVE edge AS (SELECT event_id AS node, event_id // 2 AS parent FROM events WHERE event_id > 1),
stop AS (SELECT event_id AS node FROM events WHERE event_type = 'error'),
walk(node, place) AS (SELECT node, node FROM edge UNION ALL SELECT w.node, e.parent FROM walk w JOIN edge e ON e.node = w.place WHERE e.parent NOT IN (SELECT node FROM stop))
SELECT e.node, max(w.place) FILTER (p.parent IN (SELECT node FROM stop)) AS root FROM edge e JOIN walk w ON w.node = e.node LEFT JOIN edge p ON p.node = w.place GROUP BY e.node"""
)
def tree_root(t: Tables) -> DataFrame:
    edges = t.events.where("event_id > 1").select(F.col("event_id").alias("node"), F.floor(F.col("event_id") / 2).alias("parent"))
    return J.tree_root(edges, t.events.where("event_type = 'error'").select(F.col("event_id").alias("node")))


@query(
    """WITH RECURSIVE edge AS (SELECT event_id AS node, event_id // 2 AS parent FROM events WHERE event_id > 1),
bad(node) AS (SELECT event_id FROM events WHERE event_type = 'error' AND event_id % 50 = 1 UNION SELECT e.node FROM edge e JOIN bad b ON e.parent = b.node)
SELECT node FROM bad"""
)
def descendant_labels(t: Tables) -> DataFrame:
    x = t.telemetry
    edges = x.where("event_id > 1").select(F.col("event_id").alias("node"), F.floor(F.col("event_id") / 2).alias("parent"), "t")
    return J.descendants(edges, x.where("kind = 'error' and event_id % 50 = 1").select(F.col("event_id").alias("node"), "t"))


@query("SELECT e.event_id, s.k AS parent_k FROM telemetry e LEFT JOIN (SELECT host, arg_max(k, event_id) AS k FROM telemetry WHERE kind = 'signup' GROUP BY host) s ON e.host = s.host", TELEMETRY)
def subject_enrich(t: Tables) -> DataFrame:
    last = t.telemetry.where("kind = 'signup'").groupBy("host").agg(F.max_by("k", "event_id").alias("parent_k"))
    return t.telemetry.join(last, "host", "left").select("event_id", "parent_k")


_RULES = [(r"[A-Z].*!!", "malicious"), (r"(?:the|The|die|la)\b.*", "benign"), (r".*\|.*", "unknown")]


@query(r"SELECT record_id, CASE WHEN regexp_full_match(pgm, '[A-Z].*!!') THEN 'malicious' WHEN regexp_full_match(pgm, '(?:the|The|die|la)\b.*') THEN 'benign' WHEN regexp_full_match(pgm, '.*\|.*') THEN 'unknown' END AS rule_label FROM launches", LAUNCHES)
def regex_rules(t: Tables) -> DataFrame:
    return J.first_rule(t.launches, _RULES, "pgm").select("record_id", "rule_label")


@query("SELECT host, arg_max(v, p) AS meta FROM (SELECT host, 1 AS p, min(k) AS v FROM telemetry WHERE kind = 'view' GROUP BY host UNION ALL SELECT host, 2, max(k) FROM telemetry WHERE kind = 'error' GROUP BY host) GROUP BY host", TELEMETRY)
def catalog_precedence(t: Tables) -> DataFrame:
    x = t.telemetry
    old = x.where("kind = 'view'").groupBy("host").agg(F.min("k").alias("v")).withColumn("p", F.lit(1))
    new = x.where("kind = 'error'").groupBy("host").agg(F.max("k").alias("v")).withColumn("p", F.lit(2))
    return old.unionByName(new).groupBy("host").agg(F.max_by("v", "p").alias("meta"))


@query("SELECT coalesce(a.host, b.host) AS host, CASE WHEN a.host IS NULL THEN 'extra' WHEN b.host IS NULL THEN 'missing' ELSE 'repeated' END AS problem FROM (SELECT host, count(*) AS n FROM telemetry WHERE kind = 'error' GROUP BY host) a FULL JOIN (SELECT host, count(*) AS n FROM telemetry WHERE kind = 'signup' GROUP BY host) b ON a.host = b.host WHERE a.n IS NULL OR b.n IS NULL OR a.n > 1 OR b.n > 1", TELEMETRY)
def mapping_coverage(t: Tables) -> DataFrame:
    x = t.telemetry
    return J.coverage(x.where("kind = 'error'").select("host"), x.where("kind = 'signup'").select("host"), "host")


@query("SELECT d.doc_id, s.label FROM documents d LEFT JOIN (SELECT text, min(quality) AS label FROM documents JOIN labels USING (doc_id) GROUP BY text HAVING count(DISTINCT quality) = 1) s ON d.text = s.text")
def unanimous_scores(t: Tables) -> DataFrame:
    scores = t.documents.join(t.labels, "doc_id").groupBy("text").agg(F.count_distinct("quality").alias("n"), F.min("quality").alias("label")).where("n = 1")
    return t.documents.join(scores, "text", "left").select("doc_id", "label")


# --- aggregations ----------------------------------------------------------------------------------------------------
@query("SELECT shell_input, min(dataset) AS dataset FROM shell WHERE ai_label IS NULL OR ai_label = 'unknown' GROUP BY shell_input HAVING shell_input NOT IN (SELECT shell_input FROM shell WHERE ai_label IN ('malicious', 'benign'))", SHELL)
def distinct_commands(t: Tables) -> DataFrame:
    done = t.shell.where("ai_label in ('malicious', 'benign')").select("shell_input")
    return t.shell.where("ai_label is null or ai_label = 'unknown'").join(done, "shell_input", "left_anti").groupBy("shell_input").agg(F.min("dataset").alias("dataset"))


@query("SELECT dataset, dataset_label, pgm_base, args, min(record_id) AS record_id FROM launches GROUP BY ALL", LAUNCHES)
def unique_commands(t: Tables) -> DataFrame:
    return J.first_of_each(t.launches, ["dataset", "dataset_label", "pgm_base", "args"], "record_id")


@query("SELECT host, arg_max(event_id, (CASE WHEN kind = 'signup' THEN 1 ELSE 0 END, k, -event_id)) AS event_id, max(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS attack FROM telemetry GROUP BY host", TELEMETRY)
def process_representative(t: Tables) -> DataFrame:
    rank = F.struct((F.col("kind") == "signup").cast("int"), "k", -F.col("event_id"))
    return t.telemetry.groupBy("host").agg(F.max_by("event_id", rank).alias("event_id"), F.max((F.col("kind") == "error").cast("int")).alias("attack"))


@query("SELECT host, arg_min(event_id, (CASE kind WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END, event_id)) AS event_id FROM telemetry GROUP BY host", TELEMETRY)
def creation_preference(t: Tables) -> DataFrame:
    priority = F.when(F.col("kind") == "signup", 0).when(F.col("kind") == "purchase", 1).otherwise(2)
    return t.telemetry.groupBy("host").agg(F.min_by("event_id", F.struct(priority, "event_id")).alias("event_id"))


@query("SELECT l_orderkey, min(l_linestatus) AS status, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS flag FROM lineitem GROUP BY l_orderkey")
def merge_summaries(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_linestatus").alias("status"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("flag"))


@query("SELECT host, k, array_to_string(tags, ',') AS tags, CASE WHEN list_contains(tags, 'error') THEN 'malicious' WHEN len(tags) = 1 THEN 'benign' ELSE 'unknown' END AS label FROM (SELECT host, k, list_sort(list(DISTINCT kind)) AS tags FROM telemetry GROUP BY host, k)", TELEMETRY)
def tag_set_label(t: Tables) -> DataFrame:
    tags = t.telemetry.groupBy("host", "k").agg(F.sort_array(F.collect_set("kind")).alias("set"))
    return tags.select("host", "k", F.array_join("set", ",").alias("tags"), F.when(F.array_contains("set", "error"), "malicious").when(F.size("set") == 1, "benign").otherwise("unknown").alias("label"))


_PAIRS = ", pairs AS (SELECT dataset, dataset_label AS reference, coalesce(ai_label, 'unknown') AS prediction FROM shell WHERE dataset_label <> 'malicious-group')"


def _pairs(t: Tables) -> DataFrame:
    return t.shell.where("dataset_label <> 'malicious-group'").select("dataset", F.col("dataset_label").alias("reference"), F.coalesce("ai_label", F.lit("unknown")).alias("prediction"))


@query("SELECT dataset, grouping(dataset) AS whole, count(*) AS n, count(*) FILTER (reference <> prediction) AS differ FROM pairs GROUP BY GROUPING SETS ((dataset), ())", SHELL + _PAIRS)
def disagreements(t: Tables) -> DataFrame:
    rows = _pairs(t).groupingSets([["dataset"], []], "dataset")
    return rows.agg(F.grouping("dataset").cast("long").alias("whole"), F.count("*").alias("n"), F.count_if(F.col("reference") != F.col("prediction")).alias("differ"))


@query(
    """SELECT g.dataset, g.reference, g.prediction, coalesce(c.n, 0) AS n, coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.dataset) AS share
FROM (SELECT DISTINCT dataset, r.reference, p.prediction FROM (SELECT DISTINCT dataset FROM pairs UNION ALL SELECT NULL) CROSS JOIN (VALUES ('malicious'), ('benign'), ('unknown')) r(reference) CROSS JOIN (VALUES ('malicious'), ('benign'), ('unknown')) p(prediction)) g
LEFT JOIN (SELECT dataset, reference, prediction, count(*) AS n FROM pairs GROUP BY GROUPING SETS ((dataset, reference, prediction), (reference, prediction))) c
ON g.dataset IS NOT DISTINCT FROM c.dataset AND g.reference = c.reference AND g.prediction = c.prediction""",
    SHELL + _PAIRS,
)
def confusion_matrix(t: Tables) -> DataFrame:
    return S.confusion(_pairs(t), ["malicious", "benign", "unknown"])


@query(
    """SELECT dataset, os, n, malicious, benign, n - malicious - benign AS unknown, texts, unknown_texts, sessions, singletons, (n - malicious - benign)::DOUBLE / n AS unknown_rate, unknown_texts::DOUBLE / texts AS unknown_text_rate,
  coalesce((SELECT string_agg(c || ' ' || shell_input, chr(1) ORDER BY c DESC, shell_input) FROM (SELECT * FROM x WHERE x.dataset = g.dataset AND x.os = g.os AND x.label = 'unknown' ORDER BY c DESC, shell_input LIMIT 30)), '') AS frequent
FROM (SELECT dataset, os, CAST(sum(c) AS BIGINT) AS n, CAST(sum(m) AS BIGINT) AS malicious, CAST(sum(b) AS BIGINT) AS benign, count(*) AS texts, count(*) FILTER (label = 'unknown') AS unknown_texts FROM x GROUP BY ALL) g
JOIN (SELECT dataset, os, count(*) AS sessions, count(*) FILTER (c = 1) AS singletons FROM (SELECT dataset, os, session_id, count(*) AS c FROM shell GROUP BY ALL) GROUP BY ALL) s USING (dataset, os)""",
    SHELL + ", x AS (SELECT dataset, os, shell_input, count(*) AS c, min(label) AS label, count(*) FILTER (label = 'malicious') AS m, count(*) FILTER (label = 'benign') AS b FROM shell GROUP BY ALL)",
)
def import_summary(t: Tables) -> DataFrame:
    found = M.import_summary(t.shell, ["dataset", "os"], "shell_input", "label", "session_id")
    frequent = F.array_join(F.transform("frequent_unknown", lambda x: F.concat_ws(" ", x["n"], x["text"])), "\x01")
    return found.withColumn("frequent", frequent).drop("frequent_unknown")


@query("SELECT pgm_base, count(DISTINCT label) AS n_labels FROM launches GROUP BY pgm_base HAVING count(DISTINCT label) > 1", LAUNCHES)
def contradictions(t: Tables) -> DataFrame:
    return t.launches.groupBy("pgm_base").agg(F.count_distinct("label").alias("n_labels")).where("n_labels > 1")


@query("SELECT session_id, CASE WHEN bool_or(label = 'malicious') THEN 'malicious' WHEN bool_and(label = 'benign') THEN 'benign' ELSE 'unknown' END AS label FROM shell GROUP BY session_id", SHELL)
def combine_labels(t: Tables) -> DataFrame:
    return t.shell.groupBy("session_id").agg(C.combined_label(F.col("label")).alias("label"))


@query("SELECT dataset, session_id, max(ai_label) AS ai_label, max(override_label) AS override_label, coalesce(max(override_label), max(ai_label), 'unknown') AS label FROM shell GROUP BY dataset, session_id", SHELL)
def session_labels(t: Tables) -> DataFrame:
    s = t.shell.groupBy("dataset", "session_id").agg(F.max("ai_label").alias("ai_label"), F.max("override_label").alias("override_label"))
    return s.withColumn("label", C.session_label(F.col("ai_label"), F.col("override_label")))


@query("SELECT DISTINCT host, k % 5 AS pid, t, 'creation' AS what FROM telemetry WHERE kind = 'signup' UNION ALL SELECT DISTINCT host, NULL, t, 'reboot' FROM telemetry WHERE kind = 'error'", TELEMETRY)
def lifetime_evidence(t: Tables) -> DataFrame:
    return observed_times(t.telemetry.withColumn("pid", F.col("k") % 5), "host", "pid", "t", F.col("kind") == "signup", F.col("kind") == "error")


@query("SELECT dataset, count(*) AS inputs, sum(launches) AS launches FROM (SELECT s.dataset, s.doc_id, count(l.doc_id) AS launches FROM shell s LEFT JOIN launches l ON s.doc_id = l.doc_id GROUP BY s.dataset, s.doc_id) GROUP BY dataset", LAUNCHES)
def run_stats(t: Tables) -> DataFrame:
    inputs = t.shell.groupBy("dataset").agg(F.count("*").alias("inputs"))
    return inputs.join(t.launches.groupBy("dataset").agg(F.count("*").alias("launches")), "dataset", "left").withColumn("launches", F.coalesce("launches", F.lit(0)))


# --- windows, sorts, sets --------------------------------------------------------------------------------------------
@query("SELECT dataset, dataset_label, record_id FROM shell QUALIFY row_number() OVER (PARTITION BY dataset, dataset_label ORDER BY md5('17' || record_id), record_id) <= 5", SHELL)
def stratified_sample(t: Tables) -> DataFrame:
    return S.stratified_sample(t.shell, ["dataset", "dataset_label"], F.col("record_id"), 5, "17").select("dataset", "dataset_label", "record_id")


@query("SELECT dataset, record_id FROM shell QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY md5('u' || record_id), record_id) <= 20", SHELL)
def uniform_sample(t: Tables) -> DataFrame:
    return S.stratified_sample(t.shell, ["dataset"], F.col("record_id"), 20, "u").select("dataset", "record_id")


@query(f"SELECT event_id, sum(new) OVER (PARTITION BY host ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM (SELECT event_id, host, t, CASE WHEN t - lag(t) OVER (PARTITION BY host ORDER BY t, event_id) <= {HOUR} THEN 0 ELSE 1 END AS new FROM telemetry)", TELEMETRY)
def idle_sessions(t: Tables) -> DataFrame:
    return S.idle_sessions(t.telemetry, "host", "t", HOUR).select("event_id", "session_no")


@query("SELECT min(event_id) AS event_id, host, kind, k FROM telemetry GROUP BY host, kind, k", TELEMETRY)
def first_occurrence(t: Tables) -> DataFrame:
    return S.first_per(t.telemetry, ["host", "kind", "k"], F.col("event_id")).select("event_id", "host", "kind", "k")


@query("SELECT event_id, coalesce(last_value(CASE WHEN kind = 'error' THEN 'boot-' || event_id END IGNORE NULLS) OVER (PARTITION BY host ORDER BY t, event_id ROWS UNBOUNDED PRECEDING), 'initial') AS boot FROM telemetry", TELEMETRY)
def boot_segments(t: Tables) -> DataFrame:
    mark = F.when(F.col("kind") == "error", F.concat(F.lit("boot-"), "event_id"))
    return S.carried_forward(t.telemetry, "host", ["t", "event_id"], mark, "boot", "initial").select("event_id", "boot")


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS then FROM conversations) WHERE role = 'user' AND \"then\" = 'assistant'")
def adjacent_pair(t: Tables) -> DataFrame:
    after = F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return t.conversations.withColumn("after", after).where("role = 'user' and after = 'assistant'").select("conv_id", "turn")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal FROM conversations")
def source_ordinals(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long").alias("ordinal"))


@query(
    """SELECT event_id, CASE WHEN w AND typed AND i THEN 'ambiguous-fragment' WHEN w AND typed AND f THEN 'failed-with-literal-input' WHEN w AND f AND NOT inside THEN 'isolated-failed-fragment' WHEN NOT w AND f THEN 'handler-echo' WHEN NOT i AND NOT f THEN 'no-input' END AS reason
FROM (SELECT *, bool_or(i AND NOT w) OVER c AS typed, bool_or(i AND w) OVER c AS inside FROM (SELECT event_id, host, t // 86400000000 AS day, kind = 'click' AS i, kind = 'error' AS f, k % 3 > 0 AS w FROM telemetry) WINDOW c AS (PARTITION BY host, day))""",
    TELEMETRY,
)
def preferred_form(t: Tables) -> DataFrame:
    events = t.telemetry.withColumn("day", F.floor(F.col("t") / 86_400_000_000))
    return M.preferred_forms(events, ["host", "day"], F.col("kind") == "click", F.col("kind") == "error", F.col("k") % 3 > 0).select("event_id", "reason")


@query("SELECT event_id, row_number() OVER (PARTITION BY host ORDER BY CASE WHEN k % 10 = 0 THEN NULL ELSE t END NULLS FIRST, event_id) AS place FROM telemetry", TELEMETRY)
def ordered_events(t: Tables) -> DataFrame:
    time = F.when(F.col("k") % 10 != 0, F.col("t"))
    return t.telemetry.select("event_id", F.row_number().over(Window.partitionBy("host").orderBy(time.asc_nulls_first(), "event_id")).cast("long").alias("place"))


@query("SELECT event_id, host FROM telemetry QUALIFY row_number() OVER (PARTITION BY host ORDER BY event_id) <= 3", TELEMETRY)
def max_records(t: Tables) -> DataFrame:
    return t.telemetry.withColumn("n", F.row_number().over(Window.partitionBy("host").orderBy("event_id"))).where("n <= 3").select("event_id", "host")


@query("SELECT dataset, shell_input, n FROM (SELECT dataset, shell_input, count(*) AS n FROM shell WHERE label = 'unknown' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY n DESC, shell_input) <= 30", SHELL)
def topk_unknown(t: Tables) -> DataFrame:
    counts = t.shell.where("label = 'unknown'").groupBy("dataset", "shell_input").agg(F.count("*").alias("n"))
    top = F.row_number().over(Window.partitionBy("dataset").orderBy(F.col("n").desc(), "shell_input"))
    return counts.withColumn("place", top).where("place <= 30").drop("place")


@query("SELECT reference AS label FROM pairs UNION SELECT unnest(['malicious', 'benign', 'unknown'])", SHELL + _PAIRS)
def label_domain(t: Tables) -> DataFrame:
    fixed = t.spark.createDataFrame([("malicious",), ("benign",), ("unknown",)], "label string")
    return _pairs(t).select(F.col("reference").alias("label")).union(fixed).distinct()


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def missing_results(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left_anti").distinct()


@query("SELECT o_orderkey, o_orderstatus, side FROM (SELECT o_orderkey, o_orderstatus, 'first' AS side FROM (SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END FROM orders) UNION ALL SELECT o_orderkey, o_orderstatus, 'second' FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders))")
def table_diff(t: Tables) -> DataFrame:
    one = t.orders.select("o_orderkey", "o_orderstatus")
    two = one.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 100 == 0, "X").otherwise(F.col("o_orderstatus")))
    return S.table_diff(one, two)


_MOST = 50, 20_000  # rows and bytes of a chunk


@query(
    f"""WITH RECURSIVE {SHELL},
n AS (SELECT record_id, dataset, octet_length(encode(shell_input)) AS size, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS rn FROM shell WHERE octet_length(encode(shell_input)) <= {_MOST[1]}),
w(dataset, rn, chunk, rows, used) AS (
  SELECT dataset, rn, CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(size AS BIGINT) FROM n WHERE rn = 1
  UNION ALL
  SELECT dataset, rn, chunk + CAST(shut AS BIGINT), CASE WHEN shut THEN 1 ELSE rows + 1 END, CASE WHEN shut THEN size ELSE used + size END
  FROM (SELECT n.dataset, n.rn, n.size, w.chunk, w.rows, w.used, w.rows = {_MOST[0]} OR w.used + n.size > {_MOST[1]} AS shut FROM w JOIN n ON n.dataset = w.dataset AND n.rn = w.rn + 1))
SELECT s.record_id, w.chunk, w.rows - 1 AS position FROM shell s LEFT JOIN n ON n.record_id = s.record_id LEFT JOIN w ON w.dataset = n.dataset AND w.rn = n.rn"""
)
def request_chunks(t: Tables) -> DataFrame:
    return S.running_chunks(t.shell, "dataset", ["doc_id"], F.octet_length("shell_input"), *_MOST).select("record_id", "chunk", F.col("position").cast("long").alias("position"))


@query(
    f"""WITH RECURSIVE {SHELL},
n AS (SELECT record_id, dataset, shell_input, octet_length(encode(shell_input)) + 200 AS size, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS rn FROM shell WHERE octet_length(encode(shell_input)) + 200 <= {_MOST[1]}),
w(dataset, rn, chunk, rows, used) AS (
  SELECT dataset, rn, CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(size AS BIGINT) FROM n WHERE rn = 1
  UNION ALL
  SELECT dataset, rn, chunk + CAST(shut AS BIGINT), CASE WHEN shut THEN 1 ELSE rows + 1 END, CASE WHEN shut THEN size ELSE used + size END
  FROM (SELECT n.dataset, n.rn, n.size, w.chunk, w.rows, w.used, w.rows = {_MOST[0]} OR w.used + n.size > {_MOST[1]} AS shut FROM w JOIN n ON n.dataset = w.dataset AND n.rn = w.rn + 1))
SELECT n.dataset || ':' || w.chunk || ':' || (w.rows - 1) AS custom_id, n.shell_input AS input, CAST(count(*) OVER (PARTITION BY n.dataset, w.chunk) AS BIGINT) AS in_file
FROM n JOIN w ON w.dataset = n.dataset AND w.rn = n.rn"""
)
def request_files(t: Tables) -> DataFrame:
    """Requests written as JSON lines, a file a chunk, and read back: their ids, texts, and how many lines their file has."""
    root = shared_path(t.spark, "requests")
    dealt = S.running_chunks(t.shell.where("shell_input is not null"), "dataset", ["doc_id"], F.octet_length("shell_input") + 200, *_MOST)
    S.write_requests(S.request_lines(dealt, F.struct(F.col("shell_input").alias("input")), "/v1/responses"), root)
    lines = S.read_requests(t.spark, root).select(F.from_json("value", "custom_id string, body struct<input string>").alias("r"), F.input_file_name().alias("file"))
    return lines.select("r.custom_id", "r.body.input", F.count("*").over(Window.partitionBy("file")).alias("in_file"))


# --- scalar functions ------------------------------------------------------------------------------------------------
@query("SELECT record_id, array_to_string(regexp_extract_all(shell_input, '\"[^\"]*\"|[|&;<>]+|[^ \\t\\n\\x0B\\f\\r|&;<>\"]+'), chr(10)) AS tokens FROM shell".replace("\\x0B", "\\x0b"), SHELL)
def tokens(t: Tables) -> DataFrame:
    return t.shell.select("record_id", F.array_join(C.tokens(F.col("shell_input")), "\n").alias("tokens"))


@query("SELECT record_id, sha256(shell_input) AS sha, md5(record_id) AS id FROM shell", SHELL)
def hash_ids(t: Tables) -> DataFrame:
    return t.shell.select("record_id", F.sha2("shell_input", 256).alias("sha"), F.md5("record_id").alias("id"))


@query("SELECT doc_id, coalesce(text, '') AS plain, CASE WHEN length(coalesce(text, '')) > 0 AND NOT regexp_matches(text, '[^0-9A-Fa-f]') AND length(text) % 2 = 0 THEN NULL ELSE coalesce(text, '') END AS kept FROM documents")
def decode_hex(t: Tables) -> DataFrame:
    """Whole texts from their hex form, and texts that are no hex as they are."""
    text = F.coalesce("text", F.lit(""))
    is_hex = text.rlike(r"^([0-9A-Fa-f]{2})+\z")
    return t.documents.select("doc_id", C.decode_hex(F.hex(F.encode(text, "UTF-8"))).alias("plain"), F.when(~is_hex, C.decode_hex(text)).alias("kept"))


@query("SELECT event_id, CASE WHEN event_id % 9 IN (1, 2, 5) THEN date_trunc('second', ts) WHEN event_id % 9 = 4 THEN date_trunc('millisecond', ts) WHEN event_id % 9 = 8 THEN NULL ELSE ts END AS parsed FROM events")
def parse_times(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    us = F.lpad((F.unix_micros(ts) % 1_000_000).cast("string"), 6, "0")
    iso, seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.unix_seconds(ts).cast("string")
    east = F.date_format(ts + F.expr("interval 90 minutes"), "yyyy-MM-dd HH:mm:ss")
    forms = [
        F.concat(iso, F.lit("."), us, F.lit("7Z")), iso, F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss Z"), F.concat(seconds, F.lit("."), us), F.unix_millis(ts).cast("string"),
        F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.concat(east, F.lit("."), us, F.lit("+0130")), F.concat(east, F.lit(","), us, F.lit(" +01:30")), F.date_format(ts, "yyyyMMdd"),
    ]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 9 + 1).cast("int"))
    return t.events.select("event_id", C.parse_time(text).cast("timestamp_ntz").alias("parsed"))


@query("SELECT event_id, abs(k / 100.0 + 0.25 - 1) <= 0.001 AS ok FROM telemetry", TELEMETRY)
def valid_probabilities(t: Tables) -> DataFrame:
    p = F.col("k") / 100.0
    return t.telemetry.select("event_id", C.valid_probabilities(p, F.lit(0.25), F.lit(0.0)).alias("ok"))


@query("SELECT event_id, least(k, 50) * 2.0 + greatest(k - 50, 0) * 4.0 + host * 3.0 AS cost FROM telemetry", TELEMETRY)
def token_costs(t: Tables) -> DataFrame:
    return t.telemetry.select("event_id", C.token_cost(F.col("k"), F.col("host"), 50, 2.0, 4.0, 3.0).alias("cost"))


@query("SELECT record_id, list_contains(args, 'the') AND list_contains(args, 'and') AS has_both, array_to_string(args, ' ') AS line, args[1] = pgm AS copied FROM launches", LAUNCHES)
def array_predicates(t: Tables) -> DataFrame:
    return t.launches.select("record_id", F.forall(F.array(F.lit("the"), F.lit("and")), lambda x: F.array_contains("args", x)).alias("has_both"), F.array_join("args", " ").alias("line"), (F.get("args", F.lit(0)) == F.col("pgm")).alias("copied"))


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k, 'none' AS absent FROM events")
def json_lookup(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(-1)).alias("k"), F.coalesce(F.get_json_object("props", "$.none"), F.lit("none")).alias("absent"))


@query('SELECT event_id, \'{"k":"\' || k || \'","kind":"\' || kind || \'"}\' AS canonical FROM telemetry', TELEMETRY)
def canonical_json(t: Tables) -> DataFrame:
    k, kind = F.col("k").cast("string"), F.col("kind")
    swapped = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), k, F.lit("kind"), kind)).otherwise(F.create_map(F.lit("kind"), kind, F.lit("k"), k))
    return t.telemetry.select("event_id", C.canonical_json(swapped).alias("canonical"))
