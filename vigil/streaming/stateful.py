"""Streams with state of their own: assembly of events from lines, and sessions of living processes.

The state lies in the state store, by buckets of events or of processes, whose rows are worked on together: a call of the
state store for each event would take longer than the work.  Both need an event-time column, whose watermark fires the
timers that bound the state; rows later than the watermark allows are dropped by Spark.  The state store must be RocksDB's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.processes import PROCESS_COLUMNS

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _packed(f: pd.DataFrame) -> bytes:
    """Rows as one value of a state."""
    batch = pa.RecordBatch.from_pandas(f, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_pandas()


def _dealt(stream: DataFrame, keys: list[str], more: list[str], name: Column, buckets: int) -> DataFrame:
    """stream with `x_name`, the keys and `more` as one text, and `x_bucket`, the state that rows of equal `name` share with others."""
    named = F.to_json(F.array(*[F.col(c).cast("string") for c in [*keys, *more]]))
    return stream.withColumns({"x_name": named, "x_bucket": F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")})


def _named(found: DataFrame, stream: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """found with the keys of x_name, in the types that they have in the stream, and its columns `rest`."""
    parts = F.from_json("x_name", "array<string>")
    return found.withColumn("x_parts", parts).select(*[F.get("x_parts", F.lit(i)).cast(stream.schema[k].dataType).alias(k) for i, k in enumerate(keys)], *rest)


class _Assembly(StatefulProcessor):
    """The open lines of the events of a bucket, with the time at which each event is given up, and a timer for the first of these."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "rows binary, timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([f[["x_name", "x_pos", "x_line", "x_end", "x_at"]] for f in rows], ignore_index=True)
        held, timer = self._held()
        f = pd.concat([held.assign(x_new=False), new.assign(x_new=True)], ignore_index=True)
        of = pd.factorize(f["x_name"])[0]
        n = of.max() + 1
        ended, touched, newest = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int64)
        ended[of[f["x_end"].to_numpy(bool)]] = True
        touched[of[f["x_new"].to_numpy(bool)]] = True
        np.maximum.at(newest, of, f["x_at"].to_numpy(np.int64))
        due = np.maximum(newest, timerValues.getCurrentWatermarkInMs()) + self.wait_ms + 1
        before = np.zeros(n, np.int64)
        before[of[: len(held)]] = held["x_due"].to_numpy(np.int64)
        f["x_due"] = np.where(touched, due, before)[of]
        whole = ended[of]
        self._hold(f[~whole], timer)
        yield from self._out(f[whole], True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._held()
        late = held["x_due"].to_numpy(np.int64) <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self._hold(held[~late], None)
        yield from self._out(held[late], False)

    def _held(self) -> tuple[pd.DataFrame, int | None]:
        if not self.open.exists():
            return pd.DataFrame({"x_name": [], "x_pos": [], "x_line": [], "x_end": [], "x_at": [], "x_due": []}), None
        value, timer = self.open.get()
        return _unpacked(value), timer

    def _hold(self, f: pd.DataFrame, timer: int | None) -> None:
        """Keeps the rows; `timer` is the one that is set."""
        due = int(f["x_due"].min()) if len(f) else None
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.open.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        self.open.update((_packed(f[["x_name", "x_pos", "x_line", "x_end", "x_at", "x_due"]]), due))

    def _out(self, f: pd.DataFrame, complete: bool) -> Iterator[pd.DataFrame]:
        """An event a row, its lines in order; events in parts, so that a frame stays small."""
        if not len(f):
            return
        f = f.sort_values(["x_name", "x_pos"], kind="stable")
        names, lines = f["x_name"].to_numpy(object), f["x_line"].tolist()
        first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        last = np.append(first[1:], len(f))
        for i in range(0, len(first), 10_000):
            a, b = first[i : i + 10_000], last[i : i + 10_000]
            yield pd.DataFrame({"x_name": names[a], "lines": [lines[x:y] for x, y in zip(a.tolist(), b.tolist())], "complete": complete})

    def close(self) -> None:
        pass


def assembled_events(stream: DataFrame, keys: list[str], event: str, pos: str, line: str, is_end: str, at: str, wait_ms: int, delay: str, buckets: int = 1024) -> DataFrame:
    """(keys, event as text, lines, complete): an event comes out with its end line, or incomplete once the watermark is `wait_ms` past its last line.

    Lines of an event are put in order of `pos`, also those of several batches.  The open events of all keys are dealt over
    `buckets` states, each with one timer, so a batch costs a call for each bucket and not for each event.  A task holds the
    open lines of a bucket; more buckets make them fewer.  Keys must have types that a text gives back.
    """
    s = stream.where(F.col(event).isNotNull() & F.col(at).isNotNull()).withColumns({"x_pos": F.col(pos).cast("long"), "x_line": F.coalesce(line, F.lit("")), "x_end": F.coalesce(is_end, F.lit(False)), "x_at": F.unix_millis(at)})
    s = _dealt(s, keys, [event], F.struct(*keys, event), buckets).select("x_bucket", at, "x_name", "x_pos", "x_line", "x_end", "x_at").withWatermark(at, delay)
    found = s.groupBy("x_bucket").transformWithStateInPandas(_Assembly(wait_ms), "x_name string, lines array<string>, complete boolean", "Append", "EventTime")
    return _named(found, stream, keys, [F.get("x_parts", F.lit(len(keys))).alias("event"), "lines", "complete"])


class _Lives(StatefulProcessor):
    """The living processes of the keys of a bucket, and rows that wait until no earlier one can come; a timer for the first step of time among them."""

    def __init__(self, step_ms: int):
        self.step_ms = step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.about = handle.getValueState("about", "timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer = self.about.get()[0] if self.about.exists() else None
        new = pd.concat([f[["x_name", "x_at", "x_order", *PROCESS_COLUMNS]] for f in rows], ignore_index=True)
        new["x_at"] = new["x_at"].astype("int64") // self.step_ms * self.step_ms + self.step_ms
        self.waiting.appendValue((_packed(new),))
        first = int(new["x_at"].min())
        self._set(timer, first if timer is None else min(first, timer))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        f = pd.concat([_unpacked(value) for (value,) in self.waiting.get()], ignore_index=True)
        later = f[f["x_at"] > now]
        f = f[f["x_at"] <= now].sort_values(["x_name", "x_at", "x_order", "event"])
        live = self._living()
        for i in range(0, len(f), 10_000):
            part = f.iloc[i : i + 10_000].astype(object)
            part = part.where(part.notna(), None)
            sessions = [session(live, *r) for r in part[["x_name", *PROCESS_COLUMNS]].itertuples(index=False, name=None)]
            yield pd.DataFrame({"x_name": part["x_name"], "event": part["event"], "session": sessions})
        self.waiting.clear()
        if len(later):
            self.waiting.appendValue((_packed(later),))
        if live:
            names, pids, sessions, logins = zip(*[(*k, *v) for k, v in live.items()])
            self.live.update((_packed(pd.DataFrame({"name": names, "pid": pids, "session": sessions, "login": logins})),))
        else:
            self.live.clear()
        self._set(None, int(later["x_at"].min()) if len(later) else None)

    def _living(self) -> dict[tuple[str, str], tuple[str, bool]]:
        """By key and process: its session, and whether that is a login's."""
        if not self.live.exists():
            return {}
        f = _unpacked(self.live.get()[0])
        return dict(zip(zip(f["name"], f["pid"]), zip(f["session"], f["login"].tolist())))

    def _set(self, timer: int | None, first: int | None) -> None:
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is None:
            self.about.clear()
            return
        if timer != first:
            self.handle.registerTimer(first)
        self.about.update((first,))

    def close(self) -> None:
        pass


def session(live: dict[tuple[str, str], tuple[str, bool]], name: str, event, pid, parent, login, action, child) -> str:
    """The session of a row, by the rules of processes.lifetime_sessions; the living processes are brought up to date."""
    known, above = live.get((name, pid)) if pid else None, live.get((name, parent)) if parent else None
    of_row = (f"login:{login}", True) if login else None if pid else (f"event:{event}", False)
    of_process = of_row or known or (above if above and above[1] else (f"process:{pid}:{event}", False))
    if pid and action == "exit":
        live.pop((name, pid), None)
    elif pid:
        live[name, pid] = of_process
    if pid and action == "fork" and child:
        live[name, child] = of_process if of_process[1] else (f"process:{child}:{event}", False)
    return of_process[0]


def lifetime_sessions(stream: DataFrame, keys: list[str], order: str, at: str, delay: str, step_ms: int = 1000, buckets: int = 256) -> DataFrame:
    """(keys, event, session) of the rows (with PROCESS_COLUMNS), by the rules of processes.lifetime_sessions.

    Rows are taken in the order of time, `order` and event, in whatever batches they come: those of a step of time wait
    until the watermark has passed it, so they come out `delay` after their time.  The keys are dealt over `buckets` states,
    so a batch costs a call for each bucket and not for each step of a key.  A task holds the waiting rows of a bucket and its
    living processes; more buckets make them fewer.  Keys must have types that a text gives back.
    """
    s = stream.where(F.col(at).isNotNull()).withColumns({"x_order": F.format_string("%020d", F.col(order).cast("long")), "x_at": F.unix_millis(at)})
    s = _dealt(s, keys, [], F.struct(*keys), buckets).select("x_bucket", at, *PROCESS_COLUMNS, "x_name", "x_order", "x_at").withWatermark(at, delay)
    found = s.groupBy("x_bucket").transformWithStateInPandas(_Lives(step_ms), "x_name string, event string, session string", "Append", "EventTime")
    return _named(found, stream, keys, ["event", "session"])
