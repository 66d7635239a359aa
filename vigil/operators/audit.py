"""Commands from audit logs: lines of one event, spread over a file, become one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import argv, decode_hex, last_entries, let
from .ordered import Ordered

# The form of audit lines, and the numbers of execve and execveat by architecture.
EVENT_ID = r"msg=audit\(([^)]+)\)"
FIELD = r"""(?<![\w-])(\w+)=("[^"]*"|[^\s']+)"""
EXEC_CALLS = {"c000003e": (59, 322), "40000003": (11, 358), "c00000b7": (221, 281), "40000028": (11, 387)}


def audit_pairs(text: Column) -> Column:
    """Names and raw values of audit lines as an array of (key, value), in order."""
    pair = lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.substr(p, F.instr(p, "=") + 1).alias("value"))
    return F.transform(F.regexp_extract_all(text, F.lit(FIELD), F.lit(0)), pair)


def audit_value(value: Column) -> Column:
    """A raw value without its quotes, or decoded from hex digits."""
    return F.when(value.startswith('"'), F.regexp_replace(value, r'\A"|"\z', "")).otherwise(decode_hex(value))


def is_execution(fields: Column) -> Column:
    """Whether a line tells of an attempt to start a program, be it one that failed."""
    call, arch = F.lower(fields["syscall"]), F.lower(fields["arch"])
    numbers = F.lit(False)
    for name, calls in EXEC_CALLS.items():
        numbers = numbers | ((arch == name) & call.isin(*map(str, calls)))
    started = (fields["type"] == "SYSCALL") & (call.isin("execve", "execveat") | numbers)
    return F.coalesce(fields["type"].isin("EXECVE", "USER_CMD") | started, F.lit(False))


def audit_commands(lines: DataFrame, file: str, line: str, text: str) -> DataFrame:
    """(file, host, boot, event, first_line, argv, exe, fields) of the executions in audit lines.

    An event is named by its id, its host (`node`) and the boot it belongs to: the last boot record or boot id of the host
    at or before it, else `initial`.  Its lines are joined in order.  argv comes from the EXECVE arguments if none is
    missing, else from the process title, else from the command of a USER_CMD record; events without one give no row, nor
    do lines without an event id.  For a failed attempt exe is the path that was tried.  fields: all raw values, the last
    of each name.  Of lines that occur twice nothing changes.
    """
    named = lines.select(file, line, F.col(text).alias("text"), F.nullif(F.regexp_extract(text, EVENT_ID, 1), F.lit("")).alias("event")).where("event is not null")
    rows = Ordered(named.withColumn("host", F.regexp_extract("text", r"(?:^|\s)node=(\S+)", 1)), [file, "host"], [line])
    # only lines with these words can begin a boot; all others are read once, with their event
    telling = F.when(F.contains("text", F.lit("boot_id=")) | F.contains("text", F.lit("SYSTEM_BOOT")), F.col("text"))
    mark = let(last_entries(audit_pairs(telling)), lambda f: F.coalesce(f["boot_id"], F.when(f["type"] == "SYSTEM_BOOT", F.col("event"))))
    booted = rows.last(rows.rows, mark, "boot").withColumn("boot", F.coalesce("boot", F.lit("initial")))
    # dealt by number, as few large tasks would read the lines otherwise
    names = [file, "host", "boot", "event"]
    dealt = booted.select(*names, line, "text").repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names)
    events = dealt.groupBy(*names).agg(F.min(line).alias("first_line"), F.collect_list(F.struct(F.col(line).alias("at"), "text")).alias("told"))

    filled = lambda words: let(words, lambda w: F.when(F.size(w) > 0, w))

    def joined(kept: Column) -> Column:
        """The pairs of an event's lines.  Where a quote is open at a line's end, the lines are read as one text, as it may go on."""
        pairs = F.flatten(F.transform(kept, lambda x: x["pairs"]))
        is_open = F.exists(kept, lambda x: F.exists(x["pairs"], lambda p: p["value"].rlike(r'\A"[^"]*\z')))
        return F.when(is_open, audit_pairs(F.array_join(F.transform(kept, lambda x: x["text"]), "\n"))).otherwise(pairs)

    def last(told: Column, condition: Callable[[Column], Column], field: str) -> Column:
        return F.get(F.reverse(F.filter(told, lambda x: F.coalesce(condition(x["f"]), F.lit(False)))), F.lit(0))["f"][field]

    def listed(raw: Column) -> Column:
        """The arguments a0, a1 and so on, if none of them is missing."""

        def of(given: Column) -> Column:
            largest = F.array_max(F.transform(F.map_keys(given), lambda k: F.substring(k, 2, 9).try_cast("int"))) + 1
            asked = let(F.coalesce(raw["argc"].try_cast("int"), largest), lambda n: F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: given[F.concat(F.lit("a"), i.cast("string"))])))
            return let(asked, lambda words: F.when((F.size(given) > 0) & F.forall(words, lambda a: a.isNotNull()), F.transform(words, audit_value)))

        return let(F.map_filter(raw, lambda k, _: k.rlike(r"^a\d+\z")), of)

    def attempt(told: Column, fields: Column, raw: Column) -> Column:
        title = F.regexp_replace(let(last(told, lambda f: f["type"] == "PROCTITLE", "proctitle"), audit_value), r"\x00\z", "")
        worded = let(title, lambda w: F.when(w.contains("\0"), F.split(w, r"\x00")).otherwise(argv(w)))
        typed = argv(let(last(told, lambda f: f["type"] == "USER_CMD", "cmd"), audit_value))
        tried = last(told, lambda f: f["nametype"].isin("NORMAL", "CREATE"), "name")
        failed = F.coalesce(fields["success"].isin("no", "0"), F.lit(False))
        exe = let(F.when(failed, F.coalesce(tried, F.lit(""))).otherwise(fields["exe"]), audit_value)
        return F.struct(F.coalesce(*map(filled, (listed(raw), worded, typed))).alias("argv"), exe.alias("exe"), fields.alias("fields"))

    def attempts(told: Column) -> Column:
        execve = F.filter(told, lambda x: x["f"]["type"] == "EXECVE")
        built = let(last_entries(joined(told)), lambda fields: let(let(execve, lambda x: last_entries(joined(x))), lambda raw: attempt(told, fields, raw)))
        return F.when(F.exists(told, lambda x: is_execution(x["f"])), built)

    read = F.transform(F.sort_array("told"), lambda x: let(audit_pairs(x["text"]), lambda p: F.struct(x["at"].alias("at"), x["text"].alias("text"), p.alias("pairs"), last_entries(p).alias("f"))))
    # rows without argv go inside the generator, as a filter on it would be pushed below and read every line again
    found = F.filter(F.array(let(read, attempts)), lambda e: e["argv"].isNotNull())
    return events.select(*names, "first_line", F.inline(found))
