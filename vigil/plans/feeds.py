"""Queries of readers, sinks, streams and process evidence; tables are first written in the shape that a reader expects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..lineage import shared_path
from ..operators import evidence as E
from ..sources import readers as R
from ..sources import sinks as K
from ..sources.tables import Tables
from ..streaming import jobs as J
from .catalog import HOUR, query
from .prelude import LAUNCHES, SHELL, TELEMETRY


def _text(t: Tables, lines: DataFrame, name: str) -> str:
    path = shared_path(t.spark, name)
    lines.write.text(path)
    return path


# --- readers ---------------------------------------------------------------------------------------------------------
@query("SELECT event_id, host, t FROM telemetry WHERE kind = 'error'", TELEMETRY)
def scan_jsonl_prefilter(t: Tables) -> DataFrame:
    path = _text(t, t.telemetry.select(F.to_json(F.struct("event_id", "host", "t", "kind"))), "jsonl")
    rows = R.json_lines(t.spark, path, "event_id bigint, host bigint, t bigint, kind string", '"kind":"error"')
    return rows.where("kind = 'error'").select("event_id", "host", "t")


@query("SELECT CAST(conv_id AS VARCHAR) AS conv, turn, role, text FROM conversations")
def scan_map_of_lists(t: Tables) -> DataFrame:
    # a long conversation is written as several maps of at most 100 turns
    part = F.floor(F.col("turn") / 100)
    items = t.conversations.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("items"))
    path = _text(t, items.select(F.to_json(F.create_map(F.col("conv_id").cast("string"), "items"))), "maps")
    return R.map_of_lists(t.spark, path, "turn bigint, role string, text string").select(F.col("name").alias("conv"), "turn", "role", "text")


@query("SELECT doc_id, CAST(pos AS INTEGER) AS pos, item, NULL AS reason FROM (SELECT doc_id, unnest(range(len(p))) AS pos, unnest(p) AS item FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE doc_id % 10 <> 0)) UNION ALL SELECT doc_id, NULL, NULL, 'no list' FROM documents WHERE doc_id % 10 = 0")
def scan_nested_list(t: Tables) -> DataFrame:
    good = F.to_json(F.struct("doc_id", F.split("text", "\n").alias("commands")))
    bad = F.to_json(F.struct("doc_id", F.lit("not a list").alias("commands")))
    path = _text(t, t.documents.select(F.when(F.col("doc_id") % 10 != 0, good).otherwise(bad)), "lists")
    return R.nested_list(t.spark, path, "doc_id", "bigint", "commands")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority || chr(10) || '\"' || o_orderstatus || '\"' AS note FROM orders")
def scan_csv(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "csv")
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('"'))
    rows = t.orders.select("o_orderkey", "o_orderstatus", note.alias("note"))
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
    return R.headed_csv(t.spark, path, rows.schema)


@query("SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN kind || ', \"' || k || '\"' END AS kind, CASE WHEN event_id % 97 <> 0 THEN k END AS k, CASE WHEN event_id % 97 = 0 THEN 'other number of fields' END AS reason FROM telemetry", TELEMETRY)
def csv_sections(t: Tables) -> DataFrame:
    one = F.floor(F.col("event_id") / 10) % 2 == 0
    head = F.when(one, 'id,"kind",k').otherwise("k,id,kind")
    kind = F.concat(F.lit('"'), "kind", F.lit(', ""'), "k", F.lit('"""'))
    row = F.when(F.col("event_id") % 97 == 0, "1").when(one, F.concat_ws(",", "event_id", kind, "k")).otherwise(F.concat_ws(",", "k", "event_id", kind))
    both = F.when(F.col("event_id") % 10 == 0, F.array(head, row)).otherwise(F.array(row))
    lines = t.telemetry.select(F.floor((F.col("event_id") - 1) / 1000).alias("file"), "event_id", F.posexplode(both).alias("i", "text"))
    first = F.when(F.col("event_id") % 1000 == 1, F.array(F.lit("k,id,kind"))).otherwise(F.array().cast("array<string>"))
    heads = t.telemetry.select(F.floor((F.col("event_id") - 1) / 1000).alias("file"), (F.col("event_id") * 2 - 1).alias("line"), F.explode(first).alias("text"))
    # a file begins with the header of the section that its first lines belong to
    heads = heads.withColumn("text", F.when(F.floor((F.col("line") + 1) / 20) % 2 == 0, 'id,"kind",k').otherwise(F.col("text")))
    lines = lines.select("file", (F.col("event_id") * 2 + F.col("i")).alias("line"), "text").unionByName(heads)
    f = R.csv_sections(lines, "file", "line", "text", F.col("text").isin('id,"kind",k', "k,id,kind"))
    return f.select(F.floor(F.col("line") / 2).alias("event_id"), F.col("fields")["kind"].alias("kind"), F.col("fields")["k"].cast("int").alias("k"), "reason")


@query("SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS title FROM documents")
def scan_parquet_project(t: Tables) -> DataFrame:
    return R.projected(t.documents, "doc_id bigint, lang string, title string")


@query("SELECT event_id, kind, k FROM telemetry", TELEMETRY)
def rendered_records(t: Tables) -> DataFrame:
    block = F.array(F.concat(F.lit("=== "), "event_id"), F.concat(F.lit("Kind: "), "kind"), F.concat(F.lit("  K: "), "k"))
    lines = t.telemetry.select(F.floor(F.col("event_id") / 1000).alias("file"), "event_id", F.posexplode(block).alias("i", "text"))
    r = R.framed_records(lines.withColumn("line", F.col("event_id") * 3 + F.col("i")), "file", "line", "text", "^=== ")
    return r.select(F.substring("head", 5, 20).cast("long").alias("event_id"), F.col("fields")["Kind"].alias("kind"), F.col("fields")["K"].cast("int").alias("k"))


@query("SELECT event_id, kind, CAST(host AS VARCHAR) AS host FROM telemetry", TELEMETRY)
def kv_parse(t: Tables) -> DataFrame:
    line = F.concat(F.lit("type=EXEC host=0 kind=\""), "kind", F.lit('" host='), "host")
    m = C.key_values(F.col("line"))
    return t.telemetry.select("event_id", line.alias("line")).select("event_id", m["kind"].alias("kind"), m["host"].alias("host"))


@query("SELECT event_id, CASE k % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'kv' ELSE 'csv' END AS shape, CASE k % 3 WHEN 2 THEN 'kind=' || kind ELSE kind END AS kind FROM telemetry", TELEMETRY)
def format_dispatch(t: Tables) -> DataFrame:
    k = F.col("k") % 3
    # a file for each k; the lines of the headed ones look like pairs
    line = F.when(k == 0, F.to_json(F.struct("event_id", "kind"))).when(k == 1, F.concat(F.lit("event_id="), "event_id", F.lit(" kind="), "kind")).otherwise(F.concat(F.lit("kind="), "kind", F.lit(","), "event_id"))
    heads = t.telemetry.where(k == 2).select("k").distinct().select("k", F.lit(-1).cast("long").alias("line"), F.lit("Kind,Id").alias("value"))
    lines = t.telemetry.select("k", F.col("event_id").alias("line"), line.alias("value")).unionByName(heads)
    fields, kv, csv = F.from_json("value", "event_id bigint, kind string"), C.key_values(F.col("value")), F.split("value", ",")
    shapes = [
        ("json", r"^\{", {"event_id": fields["event_id"], "kind": fields["kind"]}),
        ("kv", "^[a-z_]+=", {"event_id": kv["event_id"].try_cast("bigint"), "kind": kv["kind"]}),
        ("csv", ",", {"event_id": F.get(csv, F.lit(1)).try_cast("bigint"), "kind": F.get(csv, F.lit(0))}),
    ]
    return R.by_shape(lines, "value", shapes, "k", "line").where("event_id is not null")


@query("SELECT event_id, CASE kind WHEN 'error' THEN 'k' || k WHEN 'click' THEN 'host' || host END AS detail FROM telemetry WHERE kind IN ('error', 'click')", TELEMETRY)
def sourcetype_dispatch(t: Tables) -> DataFrame:
    event = F.col("event_id")
    shapes = [("error", "^error$", {"event_id": event, "detail": F.concat(F.lit("k"), "k")}), ("click", "^click$", {"event_id": event, "detail": F.concat(F.lit("host"), "host")})]
    return R.by_shape(t.telemetry, "kind", shapes).drop("shape")


@query("SELECT event_id, CAST(pos AS INTEGER) AS pos, v, 'a} {\"b' || kind AS s FROM (SELECT event_id, kind, unnest([0, 1]) AS pos, unnest([host, CAST(k AS BIGINT)]) AS v FROM telemetry)", TELEMETRY)
def concatenated_json(t: Tables) -> DataFrame:
    text = F.concat(F.lit('a} {"b'), "kind").alias("s")
    one, two = (F.to_json(F.struct(F.col(c).cast("long").alias("v"), text)) for c in ("host", "k"))
    return R.joined_objects(t.telemetry.select("event_id", F.concat(one, F.lit(" "), two).alias("raw")), "raw", "v bigint, s string")


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, CASE WHEN conv_id % 9 <> 0 THEN text END AS text, true AS good FROM conversations")
def copy_text_rows(t: Tables) -> DataFrame:
    text = F.col("text")
    for char, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(code))
    kept = F.when(F.col("conv_id") % 9 != 0, text)
    path = _text(t, t.conversations.select(F.concat_ws("\t", "conv_id", "turn", F.coalesce(kept, F.lit("\\N")))), "copy")
    return R.copy_text(t.spark, path, ["conv_id", "turn", "text"])


@query("SELECT doc_id, 'quality' AS sheet, quality = 1 AS marked FROM labels UNION ALL SELECT doc_id, 'toxic', toxic = 1 FROM labels")
def evidence_tables(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", F.inline(F.array(*[F.struct(F.lit(s).alias("sheet"), (F.col(s) == 1).alias("marked")) for s in ("quality", "toxic")])))


@query("SELECT CASE kind WHEN 'signup' THEN 'Subject' ELSE 'Event' END AS tag, event_id AS id, CASE kind WHEN 'signup' THEN host END AS host, CASE kind WHEN 'error' THEN k END AS k FROM telemetry WHERE kind IN ('signup', 'error')", TELEMETRY)
def scan_tagged_union(t: Tables) -> DataFrame:
    ident = F.col("event_id").alias("id")
    subject = F.when(F.col("kind") == "signup", F.struct(ident, "host")).alias("Subject")
    event = F.when(F.col("kind") == "error", F.struct(ident, "k")).alias("Event")
    other = F.when(~F.col("kind").isin("signup", "error"), F.struct(ident)).alias("Other")
    path = _text(t, t.telemetry.select(F.to_json(F.struct(subject, event, other))), "union")
    return R.tagged_union(t.spark, path, {"Subject": "id bigint, host bigint", "Event": "id bigint, k int"})


@query(r"""SELECT page_id, CAST(pos AS INTEGER) AS pos, name, value FROM (SELECT page_id, unnest(regexp_extract_all(html, '([A-Za-z-]+)="([^"]*)"', 1)) AS name, unnest(regexp_extract_all(html, '([A-Za-z-]+)="([^"]*)"', 2)) AS value, unnest(range(len(regexp_extract_all(html, '([A-Za-z-]+)="([^"]*)"')))) AS pos FROM pages)""")
def xml_named_fields(t: Tables) -> DataFrame:
    return R.named_attributes(t.pages.select("page_id", "html"), "html")


REGISTRY = R.Registry()


@REGISTRY.register("documents")
def _documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").cast("string").alias("record_id"), F.col("lang").alias("detail"))


@REGISTRY.register("events")
def _events(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet").select(F.col("event_id").cast("string").alias("record_id"), F.col("event_type").alias("detail"))


@query("SELECT CAST(doc_id AS VARCHAR) AS record_id, lang AS detail, 'documents' AS dataset FROM documents UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, 'events' FROM events")
def reader_registry(t: Tables) -> DataFrame:
    return REGISTRY.read(t.spark, t.folder)


# --- sinks -----------------------------------------------------------------------------------------------------------
@query("SELECT dataset, 'shell' AS kind, record_id, label, shell_input AS command FROM shell UNION ALL SELECT dataset, 'process', record_id, label, array_to_string(list_prepend(pgm, args), ' ') FROM launches", LAUNCHES)
def write_observations(t: Tables) -> DataFrame:
    root = shared_path(t.spark, "observations")
    K.write_observations(t.shell.drop("doc_id").limit(3), t.launches.drop("doc_id", "pos"), root)
    K.write_observations(t.shell.drop("doc_id"), t.launches.drop("doc_id", "pos"), root)  # a second run takes the first one's place
    commands = ("shell", F.col("shell_input")), ("process", F.array_join(F.concat(F.array("pgm"), "args"), " "))
    back = [K.read_observations(t.spark, root, n).select("dataset", F.lit(kind).alias("kind"), "record_id", "label", command.alias("command")) for n, (kind, command) in zip(K.TABLES, commands)]
    return back[0].unionByName(back[1])


@query("SELECT DISTINCT dataset, false AS first FROM shell WHERE dataset NOT IN (SELECT dataset FROM shell WHERE md5(dataset) < '8') UNION ALL SELECT DISTINCT dataset, true FROM shell", SHELL)
def ingest_ledger(t: Tables) -> DataFrame:
    root, wanted = shared_path(t.spark, "ledger"), t.shell.select("dataset").distinct()
    before = K.pending(wanted, t.spark, root).withColumn("first", F.lit(True))  # nothing is there yet
    some = "md5(dataset) < '8'"
    K.write_observations(t.shell.drop("doc_id").where(some), t.launches.drop("doc_id", "pos").where(some), root)
    return K.pending(wanted, t.spark, root).withColumn("first", F.lit(False)).union(before)


@query("SELECT record_id FROM shell WHERE dataset <> (SELECT min(source) FROM documents)", SHELL)
def remove_datasets(t: Tables) -> DataFrame:
    gone = t.documents.agg(F.min("source")).first()[0]
    return K.remove_datasets({"shell": t.shell, "labels": t.labels}, gone)["shell"].select("record_id")


@query("SELECT e.event_id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' WHEN v IN ('click', 'view') THEN 'ok' ELSE 'invalid' END AS status FROM telemetry e LEFT JOIN (SELECT event_id // 3 * 2 AS event_id, count(*) AS n, min(kind) AS v FROM telemetry WHERE k > 20 GROUP BY ALL) r ON r.event_id = e.event_id", TELEMETRY)
def collect_results(t: Tables) -> DataFrame:
    answers = t.telemetry.where("k > 20").select((F.floor(F.col("event_id") / 3) * 2).alias("event_id"), F.col("kind").alias("answer"))
    return K.collect_results(t.telemetry.select("event_id"), answers, "event_id", "answer", ("click", "view")).select("event_id", "status")


# --- streams ---------------------------------------------------------------------------------------------------------
def _stream(t: Tables) -> tuple[DataFrame, str, str]:
    root = shared_path(t.spark, "stream")
    rows = t.telemetry.withColumn("at", F.timestamp_micros("t"))
    rows.write.parquet(f"{root}/in")
    return J.file_stream(t.spark, f"{root}/in", rows.schema), f"{root}/out", f"{root}/checkpoint"


#: How far behind the latest event a stream still takes events: more than the time that the tables cover.  State that is older goes.
HORIZON = "60 days"


@query("SELECT DISTINCT host, k FROM telemetry", TELEMETRY)
def stream_dedup(t: Tables) -> DataFrame:
    s, out, log = _stream(t)
    return J.run_append(J.first_seen(s, ["host", "k"], "at", HORIZON).select("host", "k"), out, log)


@query("SELECT host, t // 86400000000 * 86400000000 AS day, count(*) AS n FROM telemetry GROUP BY ALL", TELEMETRY)
def stream_daily_counts(t: Tables) -> DataFrame:
    s, out, log = _stream(t)
    return J.run_updates(J.daily_counts(s, "host", "at", HORIZON), ["host", "day"], out, log).withColumn("day", F.unix_micros("day"))


@query(f"SELECT host, min(t) AS first_t, count(*) AS n FROM (SELECT host, t, sum(fresh) OVER (PARTITION BY host ORDER BY t) AS s FROM (SELECT host, t, CASE WHEN t - lag(t) OVER (PARTITION BY host ORDER BY t) <= {HOUR} THEN 0 ELSE 1 END AS fresh FROM telemetry)) GROUP BY host, s", TELEMETRY)
def stream_sessions(t: Tables) -> DataFrame:
    s, out, log = _stream(t)
    return J.run_complete(J.idle_sessions(s, "host", "at", "60 minutes"), out, log).select("host", F.unix_micros("first_at").alias("first_t"), "n")


@query("SELECT event_id, CASE kind WHEN 'error' THEN 'malicious' WHEN 'view' THEN 'benign' END AS label FROM telemetry", TELEMETRY)
def stream_rule_labels(t: Tables) -> DataFrame:
    s, out, log = _stream(t)
    rules = t.spark.createDataFrame([("error", "malicious"), ("view", "benign")], "kind string, label string")
    return J.run_append(J.with_rules(s, rules, ["kind"]).select("event_id", "label"), out, log)


@query(f"SELECT c.event_id, e.event_id AS evidence_id FROM telemetry c LEFT JOIN telemetry e ON c.host = e.host AND e.t BETWEEN c.t AND c.t + {HOUR} AND e.kind = 'error' WHERE c.kind = 'click'", TELEMETRY)
def stream_late_evidence(t: Tables) -> DataFrame:
    """Commands with their evidence, and those without any.  A last row of each side, long after all others, moves the watermarks past them."""
    s, out, log = _stream(t)
    folder = out.removesuffix("out") + "in"
    again = J.file_stream(t.spark, folder, s.schema)
    clicks = s.where("kind = 'click'").select("event_id", "host", "at")
    errors = again.where("kind = 'error'").select(F.col("event_id").alias("evidence_id"), "host", F.col("at").alias("seen_at"))
    found = J.late_evidence(clicks, errors, "host", "at", "seen_at", "1 hour", "3650 days").select("event_id", "host", "evidence_id")
    J.run_append(found, out, log)
    last = t.telemetry.limit(1).select(*[F.lit(-1).cast("bigint").alias("host") if c == "host" else F.col(c) for c in t.telemetry.columns]).withColumn("at", F.lit("2100-01-01").cast("timestamp"))
    last.withColumn("kind", F.explode(F.array(F.lit("click"), F.lit("error")))).select(*s.columns).write.mode("append").parquet(folder)
    return J.run_append(found, out, log).where("host >= 0").select("event_id", "evidence_id")


@query("SELECT event_id, kind, 'kinds' AS side FROM telemetry UNION ALL SELECT event_id, kind, 'errors' FROM telemetry WHERE kind = 'error'", TELEMETRY)
def stream_two_table_commit(t: Tables) -> DataFrame:
    s, out, log = _stream(t)

    def write(rows: DataFrame, batch: int) -> None:
        for name, part in (("kinds", rows), ("errors", rows.where("kind = 'error'"))):
            part.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch}")

    J.run_batches(s, write, log)
    sides = [t.spark.read.schema(s.schema).parquet(f"{out}/{n}").select("event_id", "kind", F.lit(n).alias("side")) for n in ("kinds", "errors")]
    return sides[0].unionByName(sides[1])


# --- process evidence ------------------------------------------------------------------------------------------------
@query(
    """SELECT e.event_id, CASE WHEN NOT EXISTS (SELECT 1 FROM telemetry b WHERE b.kind = 'error' AND b.host = e.host AND b.t > c.t AND b.t <= e.t) THEN c.owner END AS owner
  FROM telemetry e LEFT JOIN LATERAL (SELECT max(t) AS t, arg_max(event_id, (t, -event_id)) AS owner FROM telemetry m WHERE m.kind = 'signup' AND m.host = e.host AND m.k % 5 = e.k % 5 AND m.t <= e.t) c ON true WHERE e.kind IN ('view', 'signup')""",
    TELEMETRY,
)
def pid_lifetime_join(t: Tables) -> DataFrame:
    x = t.telemetry.withColumn("pid", F.col("k") % 5)
    made = x.where("kind = 'signup'").withColumn("owner", F.col("event_id"))
    seen = x.where("kind in ('view', 'signup')").select("event_id", "host", "pid", "t")  # the creation itself lies in the life that it begins
    found = E.lifetime_owner(seen, made, x.where("kind = 'error'"), "host", "pid", "t", "owner")
    return found.select("event_id", "owner")


_INTERVALS = f""", i AS (SELECT event_id, host, k % 5 AS pid, t // 1000000 * 1000000 AS start, CASE WHEN k % 3 > 0 THEN t // 1000000 * 1000000 + k * {HOUR} END AS until FROM telemetry WHERE kind IN ('signup', 'click')),
made AS (SELECT DISTINCT host, k % 5 AS pid, t FROM telemetry WHERE kind = 'signup'), boots AS (SELECT DISTINCT host, t FROM telemetry WHERE kind = 'error'),
one AS (SELECT i.*, (SELECT min(t) FROM made m WHERE m.host = i.host AND m.pid = i.pid AND m.t >= start) AS born, (SELECT min(t) FROM boots b WHERE b.host = i.host AND b.t > start) AS boot FROM i),
cut AS (SELECT *, least(CASE WHEN born < start + 1000000 THEN (SELECT min(t) FROM made m WHERE m.host = one.host AND m.pid = one.pid AND m.t > born) ELSE born END, boot) AS cutoff FROM one)"""


def _intervals(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(telemetry with pid, intervals from starts rounded to seconds, bounded by what was observed)."""
    x = t.telemetry.withColumn("pid", F.col("k") % 5)
    start = F.floor(F.col("t") / 1_000_000) * 1_000_000
    given = x.where("kind in ('signup', 'click')").select("event_id", "host", "pid", start.alias("start"), F.when(F.col("k") % 3 > 0, start + F.col("k") * HOUR).alias("until"))
    times = E.observed_times(x, "host", "pid", "t", F.col("kind") == "signup", F.col("kind") == "error")
    return x, E.bounded_intervals(given, times.where("what = 'creation'"), times.where("what = 'reboot'"), "host", "pid", "start", "t", 1_000_000)


@query("SELECT event_id, start, cutoff FROM cut", TELEMETRY + _INTERVALS)
def bounded_lifetimes(t: Tables) -> DataFrame:
    return _intervals(t)[1].select("event_id", "start", "cutoff")


@query("SELECT e.event_id, EXISTS (SELECT 1 FROM cut c WHERE c.host = e.host AND c.pid = e.k % 5 AND c.start <= e.t AND (until IS NULL OR e.t <= until) AND (cutoff IS NULL OR e.t < cutoff)) AS inside FROM telemetry e", TELEMETRY + _INTERVALS)
def interval_labels(t: Tables) -> DataFrame:
    x, bounded = _intervals(t)
    return E.in_intervals(x.select("event_id", "host", "pid", "t"), bounded, "host", "pid", "t", "start", "until").select("event_id", "inside")


@query("SELECT e.event_id, string_agg(CAST(s.k AS VARCHAR), ',' ORDER BY s.k) AS touched FROM telemetry e LEFT JOIN (SELECT host, k, min(t) AS a, max(t) AS b FROM telemetry GROUP BY host, k) s ON e.host = s.host AND e.t BETWEEN s.a AND s.b GROUP BY e.event_id", TELEMETRY)
def object_relation_join(t: Tables) -> DataFrame:
    x = t.telemetry
    found = E.object_relations(x.select("event_id", "host", "t"), x, "host", "k", "t", 240 * HOUR)
    return found.select("event_id", F.nullif(F.array_join(F.col("touched").cast("array<string>"), ","), F.lit("")).alias("touched"))


@query("SELECT e.event_id, p.event_id IS NOT NULL AS trusted FROM telemetry e LEFT JOIN telemetry p ON p.event_id = e.event_id // 2 AND p.kind = 'signup' AND p.k % 2 = e.k % 2", TELEMETRY)
def verified_parent_join(t: Tables) -> DataFrame:
    x = t.telemetry.withColumns({"parent": F.floor(F.col("event_id") / 2), "side": F.col("k") % 2})
    verified = x.where("kind = 'signup'").select(F.col("event_id").alias("parent"), "side", F.lit(True).alias("v"))
    return x.join(verified, ["parent", "side"], "left").select("event_id", F.coalesce("v", F.lit(False)).alias("trusted"))


@query("SELECT record_id, classifier, prediction, ai_label AS reference FROM (SELECT record_id, ai_label, unnest(['override', 'dataset']) AS classifier, unnest([override_label, dataset_label]) AS prediction FROM shell) WHERE prediction IS NOT NULL AND ai_label IS NOT NULL", SHELL)
def classifier_pairs(t: Tables) -> DataFrame:
    s = t.shell
    answers = s.select("record_id", F.inline(F.array(*[F.struct(F.lit(n).alias("classifier"), F.col(n + "_label").alias("prediction")) for n in ("override", "dataset")])))
    reference = s.select("record_id", F.col("ai_label").alias("reference"))
    return answers.where("prediction is not null").join(reference.where("reference is not null"), "record_id")


_RULES = [("error", 87, 0, 1704672000000000, "malicious"), ("signup", 0, 1704067200000000, 1735689600000000, "benign"), ("view", 12, 1706745600000000, 1735689600000000, "benign")]


@query(f"SELECT e.event_id, r.label FROM telemetry e JOIN (VALUES {', '.join(map(str, _RULES))}) r(kind, k, a, b, label) ON e.kind = r.kind AND e.k = r.k AND e.t BETWEEN r.a AND r.b", TELEMETRY)
def exact_command_rules(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(_RULES, "kind string, k int, a bigint, b bigint, label string")
    return t.telemetry.join(F.broadcast(rules), ["kind", "k"]).where("t between a and b").select("event_id", "label")


@query("SELECT event_id, 3 AS n_lines, CASE WHEN k % 2 = 0 THEN [kind, CAST(host AS VARCHAR)] ELSE [kind] END AS argv FROM telemetry", TELEMETRY)
def event_assembly(t: Tables) -> DataFrame:
    argc = F.when(F.col("k") % 2 == 0, 2).otherwise(1)
    execve = F.concat(F.lit("argc="), argc, F.lit(" a_zero="), "kind", F.lit(" a_one="), "host")
    lines = F.array(F.struct(F.lit("EXECVE").alias("kind"), execve.alias("line")), *[F.struct(F.lit(n).alias("kind"), F.lit("x=1").alias("line")) for n in ("SYSCALL", "PATH")])
    rows = t.telemetry.select("event_id", F.inline(lines))
    whole = rows.groupBy("event_id").agg(F.count("*").cast("int").alias("n_lines"), F.max(F.when(F.col("kind") == "EXECVE", F.col("line"))).alias("execve"))
    kv = C.key_values(F.col("execve"))
    return whole.select("event_id", "n_lines", F.slice(F.array(kv["a_zero"], kv["a_one"]), 1, kv["argc"].cast("int")).alias("argv"))


@query("SELECT kind, count(*) AS n, count(*) FILTER (k > 0) AS priced, CASE WHEN bool_or(k = 0) THEN NULL ELSE CAST(sum(k) AS BIGINT) END AS total FROM telemetry GROUP BY kind", TELEMETRY)
def classifier_costs(t: Tables) -> DataFrame:
    cost = F.nullif(F.col("k"), F.lit(0))
    n, priced = F.count("*"), F.count(cost)
    return t.telemetry.groupBy("kind").agg(n.alias("n"), priced.alias("priced"), F.when(n == priced, F.sum(cost)).alias("total"))


@query("SELECT dataset, os, shell_input, doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER) AS index FROM (SELECT *, row_number() OVER (PARTITION BY dataset, os ORDER BY doc_id) AS p FROM (SELECT dataset, os, shell_input, min(doc_id) AS doc_id FROM shell GROUP BY ALL)) WHERE p <= 5", SHELL)
def capped_extraction(t: Tables) -> DataFrame:
    return E.capped_first_seen(t.shell, ["shell_input"], ["dataset", "os"], "doc_id", 5)


@query("SELECT record_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN pgm END, CAST(to_json({'pgm_base': pgm_base, 'args': args}) AS VARCHAR)) AS payload FROM launches", LAUNCHES)
def request_payload(t: Tables) -> DataFrame:
    made = F.to_json(F.struct("pgm_base", "args"), {"ignoreNullFields": "false"})
    return t.launches.select("record_id", F.coalesce(F.when(F.col("doc_id") % 2 == 0, F.col("pgm")), made).alias("payload"))


@query("SELECT record_id, CASE WHEN len(args) > 2 THEN args WHEN pgm_base <> '' THEN [pgm_base] ELSE [pgm] END AS argv FROM launches", LAUNCHES)
def best_representation(t: Tables) -> DataFrame:
    best = F.coalesce(F.when(F.size("args") > 2, F.col("args")), F.when(F.col("pgm_base") != "", F.array("pgm_base")), F.array("pgm"))
    return t.launches.select("record_id", best.alias("argv"))


@query("SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id % 12 DESC, doc_id) AS place FROM documents")
def rotation_order(t: Tables) -> DataFrame:
    file = F.when(F.col("doc_id") % 12 == 0, "audit.log").otherwise(F.concat(F.lit("audit.log."), F.col("doc_id") % 12))
    return R.oldest_first(t.documents.select("doc_id", "source", file.alias("file")), "source", "file", "doc_id").select("doc_id", "place")


@query("SELECT record_id, pgm FROM launches WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50)", LAUNCHES)
def limit_inputs(t: Tables) -> DataFrame:
    from ..sources.tables import process_launches

    return process_launches(t.shell.orderBy("doc_id").limit(50)).select("record_id", "pgm")


@query("SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY md5('7' || source), source LIMIT 2)")
def sample_files(t: Tables) -> DataFrame:
    chosen = t.documents.select("source").distinct().orderBy(F.md5(F.concat(F.lit("7"), "source")), "source").limit(2)
    return t.documents.join(chosen, "source", "left_semi").select("doc_id", "source")


_POOL = ", pool AS (SELECT 'user' AS name, n_name AS value, row_number() OVER (ORDER BY n_name) - 1 AS i, count(*) OVER () AS n FROM nation UNION ALL SELECT 'group', r_name, row_number() OVER (ORDER BY r_name) - 1, count(*) OVER () FROM region), v AS (SELECT doc_id, unnest([0, 1, 2]) AS variant, unnest(['', '|1', '|2']) AS part FROM documents)"


@query(
    "SELECT doc_id, variant, 'add ' || u.value || ' to ' || g.value || ' as ' || u.value || ' by x-' || lower(u.value) || ' <other>' AS filled FROM v JOIN pool u ON u.name = 'user' AND u.i = CAST('0x' || substr(md5('s|' || doc_id || part || '|=who'), 1, 6) AS BIGINT) % u.n JOIN pool g ON g.name = 'group' AND g.i = CAST('0x' || substr(md5('s|' || doc_id || part || '|group'), 1, 6) AS BIGINT) % g.n",
    SHELL + _POOL,
)
def fill_templates(t: Tables) -> DataFrame:
    """Three variants of each; the alias goes with the user."""
    value = lambda name, df, c: df.select(F.lit(name).alias("name"), c.alias("value"))
    user = F.col("n_name")
    pool = value("user", t.nation, user).union(value("alias", t.nation, F.concat(F.lit("x-"), F.lower(user)))).union(value("group", t.region, F.col("r_name")))
    rows = t.documents.select("doc_id", F.lit("add <user> to <group> as <user> by <alias> <other>").alias("text"))
    return E.fill_templates(rows, pool, "doc_id", "text", "s", variants=3, bound={"user": "who", "alias": "who"}).select("doc_id", "variant", "filled")


@query("SELECT doc_id, CASE length(text) % 4 WHEN 0 THEN 'malicious' WHEN 1 THEN 'benign' WHEN 2 THEN 'unknown' END AS prediction FROM documents")
def score_samples(t: Tables) -> DataFrame:
    answers = [" Malicious", "benign", "no idea", None]
    scored = E.score_samples(t.documents.select("doc_id", "text"), lambda s: s.str.len().map(lambda n: answers[int(n) % 4]), "text", ("malicious", "benign", "unknown"))
    return scored.select("doc_id", "prediction")


@query("SELECT record_id FROM shell WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)", SHELL)
def pending_samples(t: Tables) -> DataFrame:
    results = t.labels.select("doc_id", F.when(F.col("toxic") == 0, "ok").otherwise("failed").alias("status"))
    return E.pending_samples(t.shell, results, "doc_id").select("record_id")
