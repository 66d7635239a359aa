"""Queries of texts that hold commands and of work with a state; the texts are made from the given tables, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shell as H
from ..lineage import shared_path
from ..operators import audit as A
from ..operators import processes as P
from ..operators import selection as S
from ..sources import documents as D
from ..sources import readers as R
from ..sources.tables import Tables
from ..streaming import jobs as J
from ..streaming import stateful as T
from .catalog import query
from .prelude import LAUNCHES, SHELL, TELEMETRY


def _put(template: str, *values: str) -> Column:
    """A text with the columns in the places marked by %s; a null is told as null."""
    first, *rest = template.split("%s")
    return F.concat(F.lit(first), *[x for v, piece in zip(values, rest, strict=True) for x in (F.coalesce(F.col(v).cast("string"), F.lit("null")), F.lit(piece))])


# --- texts that hold commands ----------------------------------------------------------------------------------------
@query("SELECT event_id, printf('2024-%02d-%02d %02d:30:00', k % 12 + 1, host % 28 + 1, k % 24) AS begin_at, printf('2025-%02d-%02d %02d:30:00', k % 12 + 1, host % 28 + 1, k % 24) AS end_at, list_sort([kind, 'k' || k]) AS programs FROM telemetry", TELEMETRY)
def config_windows(t: Tables) -> DataFrame:
    parts = t.telemetry.withColumns({"day": F.format_string("%02d/%02d", F.col("k") % 12 + 1, F.col("host") % 28 + 1), "hour": F.format_string("%02d", F.col("k") % 24)})
    text = _put("\ufeff[occurTime]\r\n%s/2024 %s:30:00\r\n%s/2025 %s:30:00\r\n\r\n[PName]\r\n%s.EXE\r\n k%s \r\n%s.exe\r\n", "day", "hour", "day", "hour", "kind", "k", "kind")
    w = D.attack_windows(parts.select("event_id", text.alias("text")), "text")
    return w.select("event_id", F.col("begin").cast("string").alias("begin_at"), F.col("finish").cast("string").alias("end_at"), "programs")


@query("SELECT doc_id, 2 AS number, 'cmd' AS language, translate(coalesce(text, ''), '`~', '') AS code FROM documents UNION ALL SELECT doc_id, 3, 'powershell', 'PS> ' || lang FROM documents")
def doc_example_blocks(t: Tables) -> DataFrame:
    rows = t.documents.withColumns({"plain": F.translate(F.coalesce("text", F.lit("")), "`~", ""), "lang": F.coalesce("lang", F.lit(""))})
    text = _put("# Name\n~~~\nleft out\n```\n~~~\n## Examples\n````CMD\n%s\n````\n### More\n```powershell\nPS> %s\n```\n## Notes\n```\nleft out\n```\n", "plain", "lang")
    return D.example_blocks(rows.select("doc_id", text.alias("md")), "doc_id", "md")


_PLAIN = "replace(replace(coalesce(text, ''), '#', ''), '@', '')"


@query(f"SELECT doc_id, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS occurrence, unnest(['Get-Item ' || doc_id || ' |' || chr(10) || '  Sort-Object', '$text = @''' || chr(10) || {_PLAIN} || chr(10) || '''@', 'foreach ($x in ''('') {{' || chr(10) || '  ' || coalesce(lang, '') || chr(10) || '}}', 'Get-Date']) AS input FROM documents")
def doc_submissions(t: Tables) -> DataFrame:
    """Whole texts as here-strings among submissions, prompts, output and comments."""
    plain = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("#"), F.lit("")), F.lit("@"), F.lit(""))
    rows = t.documents.select("doc_id", plain.alias("plain"), F.coalesce("lang", F.lit("")).alias("lang"))
    code = _put("PS C:\\> Get-Item %s |\n  Sort-Object\nsome output\n>> no input\nPS D:\\> $text = @'\n%s\n'@\nshown\nPS C:\\> PS C:\\> foreach ($x in '(') {\n>>   %s\n}\nmore output\n<#\nPS> comment\n#>\nPS>Get-Date", "doc_id", "plain", "lang")
    return D.submissions(rows.select("doc_id", code.alias("code")), ["doc_id"], "code")


@query(
    r"""SELECT event_id, unnest(CASE WHEN k % 2 = 1 THEN [0] ELSE [0, 1] END) AS occurrence, unnest(CASE WHEN k % 2 = 1 THEN ['t1'] ELSE ['t1', 't2'] END) AS "at", 'C:\bin\' || kind || '.exe' AS image, kind || '.exe -k ' || k AS command FROM telemetry""",
    TELEMETRY,
)
def narrative_events(t: Tables) -> DataFrame:
    rows = t.dealt_telemetry.withColumn("id", F.when(F.col("k") % 2 == 1, F.concat(F.lit(" | EventRecordID: "), "event_id")).otherwise(""))
    line = "  [t%d] -> Event 1 (Process Create): Image: C:\\bin\\%%s.exe | CommandLine: %%s.exe -k %%s%%s\n"
    text = _put("Entity x initiated y\n" + line % 1 + line % 2 + line % 1 + "[t3] -> Event 3 (Network): Image: a | CommandLine: b\n[t4] -> Event 1 (Process): Image: c\n", *["kind", "kind", "k", "id"] * 3)
    return D.narrative_events(rows.select("event_id", text.alias("text")), "event_id", "text")


@query("SELECT event_id, unnest([kind || '.exe', kind, 'ls']) AS program, unnest([['-k', 'a b'], ['k' || k], ['-l', kind]]) AS args FROM telemetry", TELEMETRY)
def prompt_commands(t: Tables) -> DataFrame:
    text = _put('C:\\Users\\me> C:\\Tools\\%s.EXE -k "a b"\nsome output here\nme@box:~/x$ /usr/bin/%s k%s\n8 bytes\nls -l %s\nls -l %s\n', "kind", "kind", "k", "kind", "kind")
    return D.prompt_commands(t.telemetry.select("event_id", text.alias("text")), "event_id", "text")


@query("SELECT doc_id, CAST(unnest([0, 1]) AS INTEGER) AS pos, unnest(['<' || coalesce(text, '') || '>', 'second']) AS code, unnest([coalesce(lang, ''), 'unknown']) AS platform, unnest([CASE WHEN doc_id % 3 = 0 THEN 'benign' ELSE 'malicious' END, 'malicious']) AS label FROM documents")
def sequence_snippets(t: Tables) -> DataFrame:
    rows = t.documents.withColumns({"text": F.coalesce("text", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "truth": F.when(F.col("doc_id") % 3 == 0, "BENIGN").otherwise("MALICIOUS")})
    item = "[ Code-snippet ]:\n%s\n[ Resolved Code ]:\nx\n[ GROUND-TRUTH & ALL INFORMATION ]:\n%s\n------------------\n"
    text = _put(item % ("<%s>", "- PLATFORM: %s\n- GROUND-TRUTH: %s") + item % ("second", "nothing"), "text", "lang", "truth")
    return D.sequence_snippets(rows.select("doc_id", text.alias("text")), "doc_id", "text")


@query(r"SELECT doc_id, CAST(pos // 3 * 3 AS INTEGER) AS first_pos, string_agg(line || CASE pos % 3 WHEN 0 THEN '\' WHEN 1 THEN '\\\' ELSE '\\' END, chr(10) ORDER BY pos) AS input FROM (SELECT doc_id, unnest(p) || ' ' AS line, unnest(range(len(p))) AS pos FROM (SELECT doc_id, string_split(shell_input, chr(10)) AS p FROM shell)) GROUP BY ALL", SHELL)
def join_continuations(t: Tables) -> DataFrame:
    lines = t.shell.select("doc_id", F.posexplode(F.split("shell_input", "\n")).alias("pos", "line"))
    end = F.element_at(F.array(F.lit("\\"), F.lit("\\\\\\"), F.lit("\\\\")), F.col("pos") % 3 + 1)
    return S.joined_continuations(lines.withColumn("line", F.concat("line", F.lit(" "), end)), "doc_id", "pos", "line")


# --- work with a state -----------------------------------------------------------------------------------------------
@query("SELECT event_id, CAST(unnest([0, 2, 5]) AS INTEGER) AS place, unnest([t, t + 12000, t + 40000]) AS t FROM telemetry", TELEMETRY)
def near_duplicate_merge(t: Tables) -> DataFrame:
    # place: (sensor, time, guid); 1 repeats 0, so it does not hide 2; 3 repeats 2; 4 has the guid of 0
    seen = [("a", 0, "g"), ("b", 5000, None), ("a", 12000, None), ("b", 20000, None), ("b", 35000, "g"), ("b", 40000, "h")]
    each = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(s).alias("sensor"), (F.col("t") + d).alias("at"), F.lit(g).cast("string").alias("guid")) for i, (s, d, g) in enumerate(seen)])
    rows = t.telemetry.select("event_id", "host", F.inline(each))
    return P.merged_sightings(rows, ["host", "event_id"], ["at", "place"], "at", "sensor", "guid", 10_000).select("event_id", "place", F.col("at").alias("t"))


def _processes(t: Tables) -> DataFrame:
    """Telemetry as process records: five pids a host, errors are exits, every tenth k a login."""
    pid = (F.col("k") % 5).cast("string")
    login = F.when(F.col("k") % 10 == 0, F.col("k").cast("string"))
    none = F.lit(None).cast("string")
    return t.telemetry.select("host", "t", F.col("event_id").cast("string").alias("event"), pid.alias("pid"), none.alias("parent"), login.alias("login"), F.when(F.col("kind") == "error", "exit").alias("action"), none.alias("child"))


_LIFETIMES = """SELECT event_id, coalesce('login:' || last_value(login IGNORE NULLS) OVER w, 'process:' || k % 5 || ':' || first_value(event_id) OVER w) AS session FROM (
  SELECT *, CASE WHEN k % 10 = 0 THEN k END AS login, coalesce(sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY host, k % 5 ORDER BY t, CAST(event_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM telemetry)
WINDOW w AS (PARTITION BY host, k % 5, life ORDER BY t, CAST(event_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(_LIFETIMES, TELEMETRY)
def lifetime_sessions(t: Tables) -> DataFrame:
    rows = P.lifetime_sessions(_processes(t), ["host"], ["t", "event"])
    return rows.select(F.col("event").cast("long").alias("event_id"), "session")


@query(_LIFETIMES, TELEMETRY)
def stream_lifetimes(t: Tables) -> DataFrame:
    """The rows come in two runs, the second of them with a last row that moves the watermark past all others."""
    root = shared_path(t.spark, "stream")
    rows = _processes(t).withColumn("at", F.timestamp_micros("t"))
    last = rows.limit(1).select(*[F.lit(-1).cast("bigint").alias(c) if c == "host" else F.lit("2100-01-01").cast("timestamp").alias(c) if c == "at" else F.col(c) for c in rows.columns])
    for part in (rows.where("host % 2 = 0"), rows.where("host % 2 = 1").unionByName(last)):
        part.write.mode("append").parquet(f"{root}/in")
        with J.rocksdb(t.spark):
            out = T.lifetime_sessions(J.file_stream(t.spark, f"{root}/in", rows.schema), ["host"], "t", "at", "3650 days", step_ms=3_600_000)
            found = J.run_append(out, f"{root}/out", f"{root}/checkpoint")
    return found.select(F.col("event").cast("long").alias("event_id"), "session")


@query("SELECT event_id, host, ['SYSCALL', 'EXECVE ' || kind, 'EOE'] AS lines FROM telemetry", TELEMETRY)
def stream_event_assembly(t: Tables) -> DataFrame:
    """The first line of every event comes a run before the others."""
    root = shared_path(t.spark, "stream")
    lines = F.posexplode(F.array(F.lit("SYSCALL"), F.concat(F.lit("EXECVE "), "kind"), F.lit("EOE"))).alias("pos", "line")
    rows = t.telemetry.select("event_id", "host", F.timestamp_micros("t").alias("at"), lines)
    for part in (rows.where("pos = 0"), rows.where("pos > 0")):
        part.write.mode("append").parquet(f"{root}/in")
        s = J.file_stream(t.spark, f"{root}/in", rows.schema).withColumn("done", F.col("line") == "EOE")
        with J.rocksdb(t.spark):
            out = T.assembled_events(s, ["host"], "event_id", "pos", "line", "done", "at", 60_000, "3650 days")
            found = J.run_append(out, f"{root}/out", f"{root}/checkpoint")
    return found.where("complete").select(F.col("event").cast("long").alias("event_id"), "host", "lines")


@query("SELECT host, k, CASE WHEN bool_or(kind = 'view') THEN 'benign' ELSE 'malicious' END AS label FROM telemetry GROUP BY host, k HAVING bool_or(kind IN ('view', 'error')) AND NOT bool_or(kind = 'signup')", TELEMETRY)
def reviewed_merge(t: Tables) -> DataFrame:
    said = F.when(F.col("kind") == "view", "benign").when(F.col("kind") == "error", "malicious").when(F.col("kind") == "signup", "invalid")
    return P.reviewed_merge(t.telemetry.withColumn("said", said), ["host", "k"], "said")


@query("SELECT event_id, k % 7 = 0 AS recovered, kind AS channel, CASE WHEN k % 7 = 0 THEN 'a & b <' ELSE 'a && \"b\" <' END || k AS command, 'host' || host AS computer FROM telemetry WHERE kind <> 'view'", TELEMETRY)
def xml_events(t: Tables) -> DataFrame:
    # a bare ampersand makes an event that no XML parser takes
    command = F.when(F.col("k") % 7 == 0, F.concat(F.lit("a & b &lt;"), "k")).otherwise(F.concat(F.lit("a &amp;&amp; &quot;b&quot; &lt;"), "k"))
    shape = "<Event xmlns='urn:x'><System><Provider Name='p'/><EventID Qualifiers='1'>4688</EventID><Channel>%s</Channel><Computer>host%s</Computer></System><EventData><Data Name='Id'>%s</Data><Data Name='%s'>%s</Data><Data Name='Empty'/></EventData></Event>"
    rows = t.telemetry.withColumns({"command": command, "name": F.when(F.col("kind") == "view", "Other").otherwise("CommandLine")})
    path = shared_path(t.spark, "xml")
    rows.select(_put(shape, "kind", "host", "event_id", "name", "command")).write.text(path)
    f = F.col("fields")
    return R.xml_events(t.spark, path, "CommandLine").select(f["Id"].cast("long").alias("event_id"), "recovered", f["Channel"].alias("channel"), f["CommandLine"].alias("command"), f["Computer"].alias("computer"))


@query(
    """SELECT event_id, 'h' || host AS host, CASE WHEN k % 5 = 0 THEN [kind, '-x y'] WHEN k % 3 = 0 THEN ['sudo', kind] ELSE [kind, 'k ' || k] END AS argv,
  CASE WHEN k % 2 = 0 THEN '/tmp/' ELSE '/bin/' END || kind AS exe, coalesce(last_value(CASE WHEN kind = 'error' THEN '9.0:' || event_id END IGNORE NULLS) OVER (PARTITION BY event_id // 1000, host ORDER BY event_id), 'initial') AS boot
FROM telemetry QUALIFY k % 7 <> 0""",
    TELEMETRY,
)
def audit_commands(t: Tables) -> DataFrame:
    # every seventh k opens a file; every fifth has lost an argument but has a title; every third of the others is a sudo record
    head = "node=h%s type={} msg=audit(9.0:%s): "
    k, lost, sudo = F.col("k"), F.col("k") % 5 == 0, (F.col("k") % 5 != 0) & (F.col("k") % 3 == 0)
    rows = t.dealt_telemetry.withColumns({"call": F.when(k % 7 == 0, "2").otherwise("59"), "ok": F.when(k % 2 == 0, "no").otherwise("yes"), "word": F.hex(F.encode(F.concat(F.lit("k "), "k"), "UTF-8")), "title": F.hex(F.encode(F.concat("kind", F.lit("\0-x y\0")), "UTF-8")), "cmd": F.hex(F.encode(F.concat(F.lit("sudo "), "kind"), "UTF-8"))})
    line = lambda kind, rest, *c: _put(head.format(kind) + rest, "host", "event_id", *c)
    told = [
        F.when(F.col("kind") == "error", line("SYSTEM_BOOT", "comm=\"init\"")), line("SYSCALL", "arch=c000003e syscall=%s success=%s exe=\"/bin/%s\" pid=7", "call", "ok", "kind"),
        F.when(k % 7 != 0, F.when(lost, line("EXECVE", "argc=2 a0=\"%s\"", "kind")).when(sudo, line("USER_CMD", "cmd=%s", "cmd")).otherwise(line("EXECVE", "argc=2 a0=\"%s\" a1=%s", "kind", "word"))),
        line("PATH", "name=\"/tmp/%s\" nametype=NORMAL", "kind"), F.when(lost, line("PROCTITLE", "proctitle=%s", "title")),
    ]
    lines = rows.select(F.floor(F.col("event_id") / 1000).alias("file"), "event_id", F.posexplode(F.array(*told)).alias("i", "text")).where("text is not null")
    found = A.audit_commands(lines.withColumn("line", F.col("event_id") * 5 + F.col("i")), "file", "line", "text")
    return found.select(F.substring_index("event", ":", -1).cast("long").alias("event_id"), "host", "argv", "exe", "boot")


# --- words, payloads and rules ---------------------------------------------------------------------------------------
@query("""SELECT event_id, [kind, 'a b' || k, 'c "' || host || '" d', 'e f', ''] AS argv FROM telemetry""", TELEMETRY)
def argv_split(t: Tables) -> DataFrame:
    text = _put("%s 'a b'%s \"c \\\"%s\\\" d\"  e\\ f ''", "kind", "k", "host")
    return t.telemetry.select("event_id", H.posix_argv(text).alias("argv"))


@query("SELECT event_id, CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS pos, unnest(['/bin/ls', './go', kind, 'wc']) AS pgm, unnest([['dir'], [], ['a;b', CAST(k AS VARCHAR)], ['-l']]) AS args FROM telemetry", TELEMETRY)
def shell_invocations(t: Tables) -> DataFrame:
    text = _put("/bin/ls dir; ./go > out && X=1 %s 'a;b' %s 2>&1 <in | wc -l\nY=2", "kind", "k")
    rows = t.dealt_telemetry.select("event_id", F.posexplode(H.invocations(text)).alias("pos", "words"))
    return rows.select("event_id", "pos", F.get("words", F.lit(0)).alias("pgm"), F.slice("words", 2, F.size("words")).alias("args"))


@query("SELECT event_id, CASE WHEN k % 4 <> 0 THEN kind || ' é ' || k END AS plain FROM telemetry", TELEMETRY)
def decode_base64(t: Tables) -> DataFrame:
    good = F.base64(F.encode(_put("%s é %s", "kind", "k"), "UTF-16LE"))
    bad = F.element_at(F.array(F.lit("AB"), F.lit("no base64!"), F.lit("PNg=")), (F.col("k") / 4).cast("int") % 3 + 1)
    return t.telemetry.select("event_id", H.utf16_base64(F.when(F.col("k") % 4 != 0, good).otherwise(bad)).alias("plain"))


_PROGRAM_RULES = [("the", ".*", "benign", 9), ("the", "[a-z]+ .*", "malicious", 1), ("der", ".* [a-z]+", "malicious", 1), ("la", "", "benign", 1)]


@query("SELECT record_id, CASE WHEN pgm_base = 'the' THEN CASE WHEN regexp_full_match(a, '[a-z]+ .*') THEN 'malicious' ELSE 'benign' END WHEN pgm_base = 'der' AND regexp_full_match(a, '.* [a-z]+') THEN 'malicious' WHEN pgm_base = 'la' AND a = '' THEN 'benign' END AS rule_label FROM (SELECT *, array_to_string(args, ' ') AS a FROM launches)", LAUNCHES)
def program_rules(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(_PROGRAM_RULES, "program string, pattern string, label string, priority int")
    return H.program_rules(t.launches, rules, F.col("pgm_base"), F.col("args")).select("record_id", "rule_label")


@query("SELECT event_id, CASE WHEN k % 3 = 0 THEN 'malicious' WHEN kind = 'view' THEN 'benign' WHEN kind = 'error' THEN 'malicious' ELSE 'unknown' END AS label FROM telemetry", TELEMETRY)
def tag_defaults(t: Tables) -> DataFrame:
    rows = t.telemetry.withColumn("label", F.when(F.col("k") % 3 == 0, "malicious"))
    return H.tag_defaults(rows, {"view": "benign", "error": "malicious"}, F.col("kind")).select("event_id", "label")
