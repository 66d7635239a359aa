"""Queries of sessions with logins, samples with ids, contracts, stored tables, indicators and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..lineage import shared_path
from ..operators import joins as J
from ..operators import literals as L
from ..operators import processes as P
from ..operators import selection as S
from ..schemas import audited, breach
from ..sources import sinks as K
from ..sources.tables import Tables
from .catalog import HOUR, query
from .prelude import LAUNCHES, SHELL, TELEMETRY

_CONNECTION = f"""WITH RECURSIVE {TELEMETRY},
n AS (SELECT event_id, host, t, CASE WHEN host % 2 = 0 THEN 'ssh' ELSE 'telnet' END AS protocol, row_number() OVER (PARTITION BY host ORDER BY t, event_id) AS rn,
  CASE kind WHEN 'signup' THEN 'connect' WHEN 'purchase' THEN 'close' WHEN 'error' THEN 'login_ok' WHEN 'click' THEN 'input' ELSE 'output' END AS kind FROM telemetry),
w(host, rn, event_id, session, explicit, typed, last, session_id) AS (
  SELECT DISTINCT host, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), false, false, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM n
  UNION ALL
  SELECT host, rn, event_id,
    CASE what WHEN 'close' THEN NULL WHEN 'connect' THEN 'connect:' || event_id WHEN 'new' THEN CASE WHEN kind = 'login_ok' THEN 'login:' ELSE 'idle:' END || event_id ELSE s END,
    CASE what WHEN 'close' THEN false WHEN 'connect' THEN true WHEN 'new' THEN false ELSE e END,
    CASE what WHEN 'close' THEN false WHEN 'connect' THEN false WHEN 'new' THEN kind = 'input' WHEN 'orphan' THEN ty ELSE ty OR kind = 'input' END,
    CASE what WHEN 'close' THEN NULL WHEN 'orphan' THEN l ELSE t END,
    CASE what WHEN 'orphan' THEN NULL WHEN 'connect' THEN 'connect:' || event_id WHEN 'new' THEN CASE WHEN kind = 'login_ok' THEN 'login:' ELSE 'idle:' END || event_id ELSE s END
  FROM (SELECT n.*, w.session AS s, w.explicit AS e, w.typed AS ty, w.last AS l,
      CASE WHEN n.kind IN ('close', 'connect') THEN n.kind WHEN NOT w.explicit AND n.protocol = 'ssh' AND n.kind = 'login_ok' THEN 'orphan'
        WHEN w.session IS NULL OR (w.typed AND n.kind = 'login_ok' AND n.protocol = 'telnet') OR (NOT w.explicit AND w.last IS NOT NULL AND n.t - w.last > {HOUR}) THEN 'new' ELSE 'same' END AS what
    FROM w JOIN n ON n.host = w.host AND n.rn = w.rn + 1))
SELECT event_id, session_id FROM w WHERE rn > 0"""


@query(_CONNECTION)
def connection_sessions(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for x in ("signup", "connect", "purchase", "close", "error", "login_ok", "click", "input")])
    events = t.telemetry.withColumns({"kind": F.coalesce(names[F.col("kind")], F.lit("output")), "protocol": F.when(F.col("host") % 2 == 0, "ssh").otherwise("telnet")})
    return P.connection_sessions(events, ["host"], ["t", "event_id"], "t", "kind", "protocol", "event_id", HOUR).select("event_id", "session_id")


@query("SELECT row_number() OVER (ORDER BY dataset, dataset_label, n) AS sample_id, dataset, dataset_label, record_id FROM (SELECT dataset, dataset_label, record_id, row_number() OVER (PARTITION BY dataset, dataset_label ORDER BY md5('17' || record_id), record_id) AS n FROM shell) WHERE n <= 5", SHELL)
def sample_ids(t: Tables) -> DataFrame:
    sample = S.stratified_sample(t.shell, ["dataset", "dataset_label"], F.col("record_id"), 5, "17")
    return S.dense_ids(sample, ["dataset", "dataset_label"]).select("sample_id", "dataset", "dataset_label", "record_id")


@query(
    """SELECT event_id, down OR coalesce(lag(down) OVER (PARTITION BY host ORDER BY event_id), false) AS downloaded_and_run FROM (
  SELECT event_id, host, coalesce(CASE kind WHEN 'click' THEN '/tmp/x' || host WHEN 'error' THEN 'f' || (k % 3) END
    = lead(CASE kind WHEN 'view' THEN '/tmp/x' || host WHEN 'purchase' THEN 'f' || (k % 3) END) OVER (PARTITION BY host ORDER BY event_id), false) AS down FROM telemetry)""",
    TELEMETRY,
)
def download_then_run(t: Tables) -> DataFrame:
    kind, tmp, file = F.col("kind"), F.concat(F.lit("/tmp/x"), "host"), F.concat(F.lit("f"), F.col("k") % 3)
    pgm = F.when(kind == "click", "/usr/bin/wget").when(kind == "error", "curl").when(kind == "view", tmp).when(kind == "purchase", "/bin/sh").otherwise("ls")
    args = F.when(kind == "click", F.array(F.lit("-q"), F.lit("-O"), tmp, F.lit("http://h/a"))).when(kind == "error", F.array(F.lit("http://h/b"), F.lit("-o"), F.concat(F.lit("./"), file)))
    args = args.when(kind == "purchase", F.array(file)).otherwise(F.array().cast("array<string>"))
    commands = t.telemetry.select("event_id", "host", pgm.alias("pgm"), args.alias("args"))
    return P.downloads_run(commands, ["host"], "event_id", "pgm", "args").select("event_id", "downloaded_and_run")


_BROKEN = ", broken AS (SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN '' ELSE record_id END AS record_id, CASE WHEN doc_id % 23 = 0 THEN 'bad' ELSE ai_label END AS ai_label, CASE WHEN doc_id % 17 = 0 THEN 'other' ELSE os END AS os, dataset_label, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN 'g' ELSE group_id END AS group_id FROM shell)"
_REASON = "CASE WHEN record_id = '' THEN 'no record_id' WHEN ai_label = 'bad' THEN 'ai_label not allowed' WHEN os = 'other' THEN 'os not allowed' WHEN dataset_label = 'malicious-group' AND group_id IS NULL THEN 'no group_id' WHEN dataset_label <> 'malicious-group' AND group_id IS NOT NULL THEN 'group_id without a group' END"


def _broken(t: Tables) -> DataFrame:
    n = F.col("doc_id")
    new = {"record_id": F.when(n % 19 == 0, "").otherwise(F.col("record_id")), "ai_label": F.when(n % 23 == 0, "bad").otherwise(F.col("ai_label")), "os": F.when(n % 17 == 0, "other").otherwise(F.col("os"))}
    return t.shell.withColumns(new | {"group_id": F.when(n % 5 == 0, F.lit(None)).when(n % 29 == 0, "g").otherwise(F.col("group_id"))})


@query(f"SELECT doc_id, {_REASON} AS reason FROM broken", SHELL + _BROKEN)
def row_contracts(t: Tables) -> DataFrame:
    return _broken(t).select("doc_id", breach().alias("reason"))


@query(f"SELECT doc_id, CASE WHEN reason IS NULL THEN 'kept' ELSE 'skipped' END AS action, reason FROM (SELECT doc_id, {_REASON} AS reason FROM broken)", SHELL + _BROKEN)
def audit_decisions(t: Tables) -> DataFrame:
    return audited(_broken(t), breach(), "doc_id")[1]


_STORED = ", stored AS (SELECT *, CASE dense_rank() OVER (ORDER BY dataset) WHEN 1 THEN '007' WHEN 2 THEN NULL WHEN 3 THEN '1e5' WHEN 4 THEN 'a/b=c %' ELSE dataset END AS name FROM shell)"


def _odd_names(df: DataFrame, t: Tables) -> DataFrame:
    """df with datasets named as numbers, by no name, and with signs that folders cannot have."""
    known = sorted(r.source for r in t.documents.select("source").distinct().collect())
    new = F.col("dataset")
    for old, name in zip(known, ("007", None, "1e5", "a/b=c %")):
        new = F.when(F.col("dataset") == old, F.lit(name)).otherwise(new)
    return df.withColumn("dataset", new)


@query("SELECT record_id, 'shell' AS kind, dataset FROM shell WHERE dataset <> (SELECT min(source) FROM documents) UNION ALL SELECT record_id, 'process', dataset FROM launches WHERE dataset <> (SELECT min(source) FROM documents)", LAUNCHES)
def remove_stored(t: Tables) -> DataFrame:
    root = shared_path(t.spark, "observations")
    K.write_observations(t.shell.drop("doc_id"), t.launches.drop("doc_id", "pos"), root)
    K.remove_stored(t.spark, root, t.documents.agg(F.min("source")).first()[0])
    sides = [K.read_observations(t.spark, root, n).select("record_id", F.lit(k).alias("kind"), "dataset") for n, k in zip(K.TABLES, ("shell", "process"))]
    return sides[0].unionByName(sides[1])


@query("SELECT record_id, name AS dataset, name IS NOT DISTINCT FROM '007' OR name IS NULL AS pending FROM stored WHERE name IS DISTINCT FROM '1e5'", SHELL + _STORED)
def stored_names(t: Tables) -> DataFrame:
    """Two runs of which one is bounded, under odd names: rows as read, and whether their dataset is still pending."""
    root, rows = shared_path(t.spark, "observations"), _odd_names(t.shell.drop("doc_id"), t)
    none = t.launches.drop("doc_id", "pos").limit(0)
    bounded = F.coalesce(F.col("dataset") == "007", F.lit(True))
    K.write_observations(rows.where(~bounded), none, root)
    K.write_observations(rows.where(bounded), none, root, complete=False)
    K.remove_stored(t.spark, root, "1e5")
    back = K.read_observations(t.spark, root, "shell_inputs").select("record_id", "dataset")
    left = K.pending(back.select("dataset").distinct(), t.spark, root).select(F.col("dataset").alias("left"), F.lit(True).alias("pending"))
    joined = back.join(left, back["dataset"].eqNullSafe(left["left"]), "left")
    return joined.select("record_id", "dataset", F.coalesce("pending", F.lit(False)).alias("pending"))


@query("SELECT record_id, CASE WHEN label = 'unknown' AND regexp_matches(lower(shell_input), 'password|!!') THEN 'malicious' ELSE label END AS label FROM shell", SHELL)
def ioc_upgrade(t: Tables) -> DataFrame:
    return L.indicator_upgrade(t.shell, t.spark.createDataFrame([("Password",), ("!!",)], "indicator string"), "shell_input").select("record_id", "label")


@query("SELECT s.record_id, arg_min(b.item_id, b.item_id) AS rule FROM shell s LEFT JOIN benchmark b ON contains(translate(s.shell_input, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), translate(substr(b.text, 1 + b.item_id % 7, 12), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AND substr(b.text, 1 + b.item_id % 7, 12) <> '' GROUP BY s.record_id", SHELL)
def literal_rules(t: Tables) -> DataFrame:
    """A rule for each benchmark item: the first one, by item, of which a text holds a piece."""
    rules = t.benchmark.select(F.expr("substr(text, int(1 + item_id % 7), 12)").alias("literal"), "item_id")
    return L.first_literal(t.shell, rules.withColumn("place", F.col("item_id")), "shell_input", "place", "item_id").select("record_id", "rule")


@query(
    "SELECT l.record_id, coalesce(min(s.step) FILTER (s.host IS NOT NULL), min(s.step)) AS step FROM launches l LEFT JOIN (SELECT CASE WHEN doc_id % 40 = 0 THEN dataset END AS host, lower(pgm_base) AS pgm, list_transform(args, lambda x: lower(x)) AS args, record_id AS step FROM launches WHERE doc_id % 20 = 0) s ON s.pgm = lower(l.pgm_base) AND s.args = list_transform(l.args, lambda x: lower(x)) AND (s.host IS NULL OR s.host = l.dataset) GROUP BY l.record_id",
    LAUNCHES,
)
def procedure_steps(t: Tables) -> DataFrame:
    steps = t.launches.where("doc_id % 20 = 0").select(F.when(F.col("doc_id") % 40 == 0, F.col("dataset")).alias("host"), "pgm_base", "args", F.col("record_id").alias("step"))
    return J.procedure_steps(t.launches.withColumn("host", F.col("dataset")), steps).select("record_id", "step")


@query(
    f"SELECT event_id, CASE WHEN k = 99 THEN 'reviewed' WHEN host % 10 = 0 THEN 'host' WHEN kind = 'signup' THEN 'kind' WHEN EXISTS (SELECT 1 FROM telemetry s WHERE s.kind = 'error' AND s.host = e.host AND e.t BETWEEN s.t AND s.t + {HOUR} * (1 + s.k % 48)) THEN 'window' ELSE 'none' END AS rung FROM telemetry e",
    TELEMETRY,
)
def evidence_ladder(t: Tables) -> DataFrame:
    x = t.telemetry
    rungs = [("reviewed", x.where("k = 99"), ["event_id"]), ("host", x.where("host % 10 = 0"), ["host"]), ("kind", t.spark.createDataFrame([("signup",)], "kind string"), ["kind"])]
    spans = x.where("kind = 'error'").select("host", F.col("t").alias("start_t"), (F.col("t") + HOUR * (1 + F.col("k") % 48)).alias("end_t"))
    return J.evidence_ladder(x, rungs, ("window", spans, "host", "t")).select("event_id", "rung")


@query("SELECT event_id, CAST(k AS VARCHAR) AS k, kind AS name, 'inner' AS src, 'ix:' || event_id AS id, 'run ' || k AS command, CAST(host AS VARCHAR) AS parent, 'h' || host AS machine FROM telemetry", TELEMETRY)
def flatten_envelope(t: Tables) -> DataFrame:
    process = F.struct(F.concat(F.lit("run "), "k").alias("command_line"), F.struct(F.col("host").alias("pid")).alias("parent"))
    inside = F.struct(F.col("kind").alias("name"), F.lit("outer").alias("src"), F.struct("k", F.lit("inner").alias("src")).alias("EventData"), process.alias("process"), F.struct(F.concat(F.lit("h"), "host").alias("hostname")).alias("host"))
    event = F.to_json(F.struct(F.lit("ix").alias("_index"), F.col("event_id").cast("string").alias("_id"), inside.alias("_source")))
    f = C.flatten_envelope(t.dealt_telemetry.select("event_id", event.alias("raw")), "raw", "f")
    return f.select("event_id", *[F.col("f")[k].alias(n) for n, k in (("k", "k"), ("name", "name"), ("src", "src"), ("id", "_id"), ("command", "process.command_line"), ("parent", "ppid"), ("machine", "host"))])


@query(r"SELECT event_id, 'c:\dir\' || kind || '\x' || k AS path, 'hklm\soft\' || kind AS key, kind IN ('view', 'click') AS same, kind <> 'error' AS begins, 'T1059.001,T' || lpad(CAST(k AS VARCHAR), 4, '0') AS techniques FROM telemetry", TELEMETRY)
def names_and_paths(t: Tables) -> DataFrame:
    kind, k = F.col("kind"), F.col("k").cast("string")
    path = F.concat(F.lit("C:/Dir/./Sub/../"), kind, F.lit("//X"), k)
    same = C.same_program(F.concat(F.lit("C:\\bin/"), kind), F.when(kind == "view", "VIEW").when(kind == "click", "d\\Click").otherwise("none"), F.lit("windows"))
    begins = C.starts_with_program(F.concat(F.upper(kind), F.when(kind == "error", "s -x").otherwise(" -x")), kind)
    ids = F.array_join(F.array_sort(C.technique_ids(F.concat(F.lit("T1059.001, xT1000 T1059.001 T12345 T"), F.lpad(k, 4, "0")))), ",")
    techniques = F.when(ids.startswith("T1059"), ids).otherwise(F.concat_ws(",", F.lit("T1059.001"), F.regexp_replace(ids, ",?T1059.001,?", "")))
    return t.telemetry.select("event_id", C.normal_path(path).alias("path"), C.registry_key(F.concat(F.lit("HKEY_LOCAL_MACHINE:\\Soft\\"), kind)).alias("key"), same.alias("same"), begins.alias("begins"), techniques.alias("techniques"))
