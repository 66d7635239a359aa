"""Work that goes along the rows of a key in order and keeps a small state: sensor merges and process sessions.

Spark deals the rows out by key and sorts them; a task goes through its rows in Arrow batches and holds the state of one
key at a time, so a key of any size needs no more memory than its state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut, staged
from .joins import asof_last
from .ordered import Ordered

Step = Callable[[dict], object]


def along(df: DataFrame, keys: list[str], order: list[str], needs: list[str], begin: Callable[[], Step], name: str, kind: str) -> DataFrame:
    """df with `name` (of Spark type `kind`: boolean, string or long): for each key, begin() gives a function that takes its rows in order.

    A row is handed over as a dict of the columns in `needs`.  Null keys are a key.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    arrow = {"boolean": pa.bool_(), "string": pa.string(), "long": pa.int64()}[kind]
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for b in batches:
            values = []
            for row, fresh in zip(b.select(needs).to_pylist(), b.column("_first").to_pylist(), strict=True):
                step = begin() if fresh or step is None else step
                values.append(step(row))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(values, arrow)], names=[*names, name])

    schema = df.drop(name).schema
    return df.withColumn("_first", first).mapInArrow(run, schema.add(name, kind))


def merged_sightings(events: DataFrame, keys: list[str], order: list[str], at: str, sensor: str, guid: str, within: int) -> DataFrame:
    """events without those that another sensor has already reported: of the same key, and of the same guid or at most `within` away.

    A row that goes suppresses none.  Kept rows less than `within` apart come from one sensor, so the last kept one decides
    for times; rows without a time are judged by their guid alone.  order begins with `at`.  The state of a key is the guids
    of its kept rows.
    """

    def begin() -> Step:
        last, known = [None, None], set()

        def step(r: dict) -> bool:
            t, who, ident = r[at], r[sensor], r[guid]
            near = t is not None and last[0] is not None and t - last[0] <= within and who != last[1]
            if near or (ident and ident in known):
                return False
            if t is not None:
                last[:] = t, who
            if ident:
                known.add(ident)
            return True

        return step

    return along(events, keys, order, [at, sensor, guid], begin, "_kept", "boolean").where("_kept").drop("_kept")


#: The columns of process rows, all of them text: the row's name, its process, the process above, the login it reports, exit or fork or another action, and the child of a fork.
PROCESS_COLUMNS = ["event", "pid", "parent", "login", "action", "child"]


def lifetime_sessions(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows (with PROCESS_COLUMNS) with `session`, for the processes that live under each key (say host and boot).

    A row's session is its login (`login:..`).  Without one it is what its process had before; else the login session of its
    parent; else one of its own (`process:pid:event`).  A fork hands a login session on to the child, and gives any other
    child one of its own; an exit ends the process, so that a used pid starts anew.  A row without pid and login is `event:..`.
    `event` must be unique, order total, and `order` must not have nulls.

    A process's lives follow from the row before that touched it: its own or the fork that made it.  A life begins with a row
    without such a row or behind an exit, with a login, or with a fork; all of a process's other rows belong to the last
    beginning.  A beginning with a login, or without a parent, has its session at once, and hands it on with its life.  Any
    other points to the life of the parent at that time, and the pointers are doubled until they meet a login or end; only
    the rows of such lives are joined with what was found.
    """
    given = [c for c in rows.columns if c not in (*keys, "event", "action", "session")]
    text = {c: F.nullif(F.col(c), F.lit("")) for c in ("pid", "parent", "login", "child")}
    r = rows.select(*keys, *PROCESS_COLUMNS, F.struct(*order).alias("_at"), F.struct(*[f"`{c}`" for c in given]).alias("_given")).withColumns(text).where("pid is not null")
    forked = F.when(F.col("action").eqNullSafe("fork") & F.col("child").isNotNull(), F.struct(F.col("child").alias("_pid"), F.lit(1).alias("_sub")))
    touched = r.select("*", F.inline(F.array_compact(F.array(F.struct(F.col("pid").alias("_pid"), F.lit(0).alias("_sub")), forked))))
    touches = Ordered(touched.withColumn("_given", F.when(F.col("_sub") == 0, F.col("_given"))), [*keys, "_pid"], ["_at", "_sub"])
    fork, login = F.col("_sub") == 1, F.col("login").isNotNull() & (F.col("_sub") == 0)
    gone = F.coalesce(F.col("action") == "exit", F.lit(False)) & (F.col("_sub") == 0)
    t = touches.last(touches.rows, F.struct(gone.alias("gone")), "_prior", strict=True)
    alone = F.concat(F.lit("process:"), F.coalesce(F.when(fork, F.col("child")), F.col("pid")), F.lit(":"), F.col("event"))
    known = F.when(login, F.concat(F.lit("login:"), "login")).when(~fork & F.col("parent").isNull(), alone)
    life = F.struct("event", "_sub")
    t = touches.last(t, F.when(fork | login | F.coalesce(F.col("_prior.gone"), F.lit(True)), F.struct(life.alias("life"), known.alias("session"))), "_begin")
    t = staged(touches.done(t).withColumns({"_mine": F.col("_begin.life"), "_session": F.col("_begin.session")}).drop("_begin", "_prior"), "lives", free=False)
    begun = t.where(F.col("_mine") == life).withColumn("_life", life)
    named = t.where("_sub = 0 and _session is not null")
    if begun.where("_session is null").limit(1).count():
        forked = begun.where("_sub = 1").join(t.where("_sub = 0 and action = 'fork'").select("event", F.col("_mine").alias("_up")), "event", "left")
        orphans = begun.where("_sub = 0 and _session is null")
        # what the parent was when the process was first seen: the last row before that touched the parent, unless it was its exit
        when = F.struct("_at", "_sub").alias("_when")
        last = t.select(*keys, F.col("_pid").alias("_look"), when, F.when(~gone, F.col("_mine")).alias("_up"))
        asked = orphans.select(*keys, F.col("parent").alias("_look"), when, "_life")
        found = asof_last(asked, last, [*keys, "_look"], "_when", ["_up"])
        orphans = orphans.join(found.select("_life", "_up"), "_life", "left")
        # lives without a login that point to none end a row of pointers, and need no node of their own
        roots = begun.where(login).withColumn("_up", F.lit(None).cast(begun.schema["_life"].dataType))
        nodes = roots.unionByName(forked.select(roots.columns)).unionByName(orphans.select(roots.columns))
        now = cut(nodes.select("_life", F.when(login, F.col("_session")).alias("_login"), "_up", alone.alias("_alone")))
        while now.where("_login is null and _up is not null").limit(1).count():  # pointers go back in time, so they end
            far = now.select(F.col("_life").alias("_up"), F.col("_login").alias("_far"), F.col("_up").alias("_next"))
            now = cut(now.join(far, "_up", "left").select("_life", F.coalesce("_login", "_far").alias("_login"), F.when(F.coalesce("_login", "_far").isNull(), F.col("_next")).alias("_up"), "_alone"))
        sessions = now.select(F.col("_life").alias("_mine"), F.coalesce("_login", "_alone").alias("_session"))
        named = named.unionByName(t.where("_sub = 0 and _session is null").drop("_session").join(sessions, "_mine"))
    out = [F.col(f"_given.`{c}`").alias(c) if c in given else F.col(c) for c in rows.columns if c != "session"]
    loose = F.when(F.nullif(F.col("login"), F.lit("")).isNotNull(), F.concat(F.lit("login:"), "login")).otherwise(F.concat(F.lit("event:"), "event"))
    return named.select(*out, F.col("_session").alias("session")).unionByName(rows.drop("session").where(F.nullif(F.col("pid"), F.lit("")).isNull()).withColumn("session", loose))


def reviewed_merge(decisions: DataFrame, keys: list[str], decision: str) -> DataFrame:
    """(keys, label): benign beats malicious; a key that any decision calls invalid, and one without a decision, has no row."""
    said = {d: F.coalesce(F.bool_or(F.col(decision) == d), F.lit(False)) for d in ("benign", "malicious", "invalid")}
    label = F.when(said["invalid"], None).when(said["benign"], "benign").when(said["malicious"], "malicious")
    return decisions.groupBy(*keys).agg(label.alias("label")).where("label is not null")


def connection_sessions(events: DataFrame, keys: list[str], order: list[str], at: str, kind: str, protocol: str, record: str, idle: int) -> DataFrame:
    """events with session_id (how it began and the record it began with), or null for events that belong to none.

    A `connect` begins an explicit session, which ends at its `close` and which no idle gap splits.  Without one, a session
    begins with the first event, after more than `idle` units of `at` without an event, and on telnet with a `login_ok`
    after commands (`input` or `failed`), inside an explicit session too.  A close without a session belongs to none, nor
    does an ssh login (kinds that start with login) outside an explicit session.  Rows with a null time are sessions of
    their own.  `order` begins with `at`.

    Every rule asks for the last row of some kind before a row, so a key's rows may lie over many tasks (see Ordered).
    """
    timed = events.where(F.col(at).isNotNull())
    rows = Ordered(timed, keys, order)
    what, ssh = F.coalesce(F.col(kind), F.lit("")), F.coalesce(F.col(protocol) == "ssh", F.lit(False))
    df = rows.rows.withColumns({"_connect": what == "connect", "_close": what == "close", "_typed": what.isin("input", "failed"), "_again": (what == "login_ok") & F.coalesce(F.col(protocol) == "telnet", F.lit(False))})
    connect, close, typed, again = (F.col(c) for c in ("_connect", "_close", "_typed", "_again"))
    name = F.col(record).cast("string")
    # a close counts for the rows behind it; its own row still belongs to what it ends
    df = rows.last(df, F.when(close, "closed").when(connect, "connect").when(typed, "typed").when(again, "login"), "_before", strict=True)
    df = df.withColumn("_relogin", again & F.coalesce(F.col("_before") == "typed", F.lit(False)))
    # a session is explicit from its connect until its close or a new login
    df = rows.last(df, F.when(connect, F.lit(True)).when(close | F.col("_relogin"), F.lit(False)), "_open", strict=True)
    explicit = F.coalesce(F.col("_open"), F.lit(False)) & ~F.col("_relogin")
    df = df.withColumn("_outside", ~explicit & ~connect & ~close & ssh & what.startswith("login"))
    df = rows.last(df, F.when(close, F.struct(F.lit(None).cast("bigint").alias("t"))).when(~F.col("_outside"), F.struct(F.col(at).cast("bigint").alias("t"))), "_prior", strict=True)
    since = F.col(at).cast("bigint") - F.col("_prior.t")
    plain = ~explicit & ~connect & ~close & ~F.col("_outside")
    df = df.withColumn("_gap", plain & (F.col("_prior.t").isNull() | (since > idle)))
    df = rows.last(df, F.when(typed, "typed").when(F.col("_gap") | connect | close, "start").when(again, "login"), "_before", strict=True)
    begins = F.col("_gap") | (plain & again & F.coalesce(F.col("_before") == "typed", F.lit(False)))
    how = F.when(connect, "connect:").when(begins & (what == "login_ok"), "login:").when(begins, "idle:")
    df = rows.last(df, F.when(close, F.struct(F.lit(None).cast("string").alias("id"))).when(how.isNotNull(), F.struct(F.concat(how, name).alias("id"))), "_current", strict=True)
    own = F.when(F.col("_outside"), None).otherwise(F.coalesce(F.concat(how, name), F.col("_current.id")))
    named = df.withColumn("session_id", own).select(*events.columns, "session_id")
    return named.unionByName(events.where(F.col(at).isNull()).withColumn("session_id", F.concat(F.lit("record:"), name)))


def downloads_run(commands: DataFrame, keys: list[str], pos: str, pgm: str, args: str) -> DataFrame:
    """commands with downloaded_and_run: a download to a path, and the very next command that runs this path.

    Downloads are wget and curl with a named output, and wget without one, which writes the last part of its URL.  The
    path is run as the program itself, or as the one argument of a shell.
    """
    order = Window.partitionBy(*keys).orderBy(pos)
    name = F.lower(F.substring_index(pgm, "/", -1))
    flag = F.when(name == "wget", F.filter(F.transform(args, lambda x, i: F.when(x.isin("-O", "--output-document"), i)), lambda i: i.isNotNull()))
    flag = F.when(name == "curl", F.filter(F.transform(args, lambda x, i: F.when(x.isin("-o", "--output"), i)), lambda i: i.isNotNull())).otherwise(flag)
    named = F.get(args, F.get(flag, F.lit(0)) + 1)
    url = F.element_at(F.filter(args, lambda x: x.rlike("^[a-z]+://")), -1)
    plain = F.when((name == "wget") & F.exists(args, lambda x: x.rlike("^[a-z]+://[^/]+/.*[^/]$")), F.regexp_extract(url, r"([^/?#]+)(?:[?#].*)?$", 1))
    path = F.nullif(F.coalesce(named, plain), F.lit(""))
    relative = lambda p: F.regexp_replace(p, r"^\./", "")
    with_path = commands.withColumns({"_path": path, "_pgm": F.lead(pgm).over(order), "_args": F.lead(args).over(order)})
    shell = F.lower(F.substring_index("_pgm", "/", -1)).isin("sh", "bash", "dash") & (F.size("_args") == 1) & (relative(F.get("_args", F.lit(0))) == relative(F.col("_path")))
    runs = F.coalesce((relative(F.col("_pgm")) == relative(F.col("_path"))) | shell, F.lit(False))
    marked = with_path.withColumn("_runs", runs)
    out = F.col("_runs") | F.coalesce(F.lag("_runs").over(order), F.lit(False))
    return marked.withColumn("downloaded_and_run", out).drop("_path", "_pgm", "_args", "_runs")
