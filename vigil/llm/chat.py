"""Chat formatting.

Conversations come in many layouts: rows by turn, lists of messages, prompt and response, instruction and output.  The
sorted nested field paths of a layout are hashed to a fingerprint, and the fingerprint selects a declarative mapping
that turns the layout into canonical turns (role, text).  A template then marks the turns and escapes its control
strings inside texts, so that the formatted output can be read back exactly.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- layouts ---------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Mapping:
    """How one layout gives turns.  each: path of a list whose items have role and text; fixed: (role, paths) in order.

    A layout is known by its required paths; fields in `optional` are used where they are there.
    """

    name: str
    each: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    rows: bool = False

    def paths(self) -> set[str]:
        if self.rows:
            return {self.role, self.text}
        if self.each:
            return {f"{self.each}[].{self.role}"}  # a list of turns without any text is one all the same
        return {p for _, ps in self.fixed for p in ps} - set(self.optional)


#: In this order: of several layouts whose required paths a record has, the first one counts.
MAPPINGS = (
    Mapping("turn rows", role="role", text="text", rows=True),
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("conversations", each="conversations", role="from", text="value"),
    Mapping("turns", each="turns", role="role", text="text"),
    Mapping("instruction", fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Mapping("prompt and response", fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Mapping("prompt and completion", fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Mapping("question and answer", fixed=(("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",))), optional=("system", "context")),
)
ROWS, RECORDS = tuple(m for m in MAPPINGS if m.rows), tuple(m for m in MAPPINGS if not m.rows)
#: Other names of roles, in records of mixed layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths; lists are written `name[]`."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@functools.cache
def known_paths(mappings: tuple[Mapping, ...] = MAPPINGS) -> frozenset[str]:
    """All paths that mappings require."""
    return frozenset().union(*(m.paths() for m in mappings))


@functools.lru_cache(maxsize=10_000)
def _selected(paths: frozenset[str], mappings: tuple[Mapping, ...]) -> tuple[str, Mapping | None]:
    return fingerprint(paths), next((m for m in mappings if m.paths() <= paths), None)


def _named(key: str) -> str:
    """A field's name in a path; one that holds a path's own signs is quoted, so it equals no path."""
    return json.dumps(key) if any(c in key for c in '.[]"') else key


def value_paths(x) -> Iterator[str]:
    """The field paths of a decoded JSON value; null fields have none."""
    waiting = [(x, "")]
    while waiting:
        v, at = waiting.pop()
        if isinstance(v, dict):
            waiting += [(y, f"{at}.{_named(k)}" if at else _named(k)) for k, y in v.items()]
        elif isinstance(v, list):
            waiting += [(y, at + "[]") for y in v]
        elif v is not None:
            yield at


def schema_paths(t: T.DataType, at: str = "") -> Iterator[str]:
    """The field paths of a Spark type, written as value_paths writes them."""
    if isinstance(t, T.StructType):
        for f in t.fields:
            yield from schema_paths(f.dataType, f"{at}.{_named(f.name)}" if at else _named(f.name))
    elif isinstance(t, T.ArrayType):
        yield from schema_paths(t.elementType, at + "[]")
    else:
        yield at


def select_mapping(paths, mappings: tuple[Mapping, ...]) -> tuple[str, Mapping | None]:
    """(fingerprint, mapping or None) of these paths: the first mapping whose required paths are all there, looked up by the fingerprint of
    the paths that any mapping requires.  Other fields change neither."""
    return _selected(known_paths(mappings).intersection(paths), mappings)


def _text(v) -> str:
    """A value as text: null is empty, of a list of parts the texts count, a line each, what else is no text stays JSON, and half a surrogate pair is U+FFFD."""
    if isinstance(v, list):
        parts = [p.get("text") if isinstance(p, dict) else p for p in v]
        v = "\n".join(p for p in parts if isinstance(p, str)) if v and any(isinstance(p, str) for p in parts) else json.dumps(v)
    v = "" if v is None else v if isinstance(v, str) else json.dumps(v)
    try:
        v.encode()
    except UnicodeEncodeError:
        v = v.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")
    return v


def turns_of(record: str | None, mappings: tuple[Mapping, ...] = RECORDS) -> tuple[str | None, list[tuple[str, str]]]:
    """(fingerprint, turns) of one JSON record; (fingerprint, []) for a layout without a mapping.

    (None, []) if it is no JSON object, or one nested too deeply to be read.  Roles go by their names in ROLES; an item
    of a list of turns that is no object has an empty role.
    """
    try:
        x = json.loads(record) if record is not None else None
        if not isinstance(x, dict):
            return None, []
        mark, m = select_mapping(value_paths(x), mappings)
        if m is None:
            return mark, []
        if m.each:
            items = [i if isinstance(i, dict) else {m.text: i} for i in x[m.each]]
            return mark, [(ROLES.get(r := _text(i.get(m.role)), r), _text(i.get(m.text))) for i in items]
        there = [(role, paths) for role, paths in m.fixed if any(p not in m.optional or x.get(p) is not None for p in paths)]
        return mark, [(role, "\n".join(t for p in paths if (t := _text(x.get(p))))) for role, paths in there]
    except (ValueError, RecursionError):
        return None, []


def turns_from_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv, turn, role, text, fingerprint) of JSON records of mixed layouts.

    A record without a known layout, null, empty or broken, gives one row with null turn, role and text, so that nothing
    goes unseen.  Repeated records and ids give their turns again; a null id stays null; extra columns are left out; an
    empty table gives an empty result.
    """
    schema = T.StructType([T.StructField("conv", df.schema[id_col].dataType)] + [T.StructField(n, t) for n, t in (("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("fingerprint", T.StringType()))])

    def run(batches):
        for b in batches:
            owner, rows = [], []
            for i, record in enumerate(b.column(1).to_pylist()):
                mark, turns = turns_of(record)
                made = [(n, role, text, mark) for n, (role, text) in enumerate(turns)] or [(None, None, None, mark)]
                owner += [i] * len(made)
                rows += made
            columns = list(zip(*rows)) or [()] * 4
            types = pa.int64(), pa.string(), pa.string(), pa.string()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names=["conv", "turn", "role", "text", "fingerprint"])

    return df.select(id_col, json_col).mapInArrow(run, schema)


def turns_from_rows(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv, turn, role, text) of a table whose own schema's fingerprint selects a row-wise mapping.  Roles stay as they are given."""
    fields = T.StructType([f for f in df.schema.fields if f.name not in (id_col, turn_col)])
    _, m = select_mapping(schema_paths(fields), ROWS)
    if m is None:
        raise ValueError(f"no row-wise mapping for the layout {sorted(schema_paths(fields))}")
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    return df.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), text(m.role).alias("role"), text(m.text).alias("text"))


# --- template --------------------------------------------------------------------------------------------------------
#: What must never appear unescaped in a text.  Each starts with < or [ and has neither further in.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _control(pattern_marks: str) -> str:
    return "([<\\[])" + pattern_marks + "(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"


#: A control string in which any number of backslashes may stand after its first character.
_ESCAPE, _UNESCAPE = _control(r"(\\*)"), _control(r"\\(\\*)")


def escape(c: Column) -> Column:
    """One backslash more after the first character of each control string, so `<s>` becomes `<\\s>` and `<\\s>` becomes `<\\\\s>`."""
    return F.regexp_replace(c, _ESCAPE, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _UNESCAPE, "$1$2$3")


def _line(c: Column) -> Column:
    """A role on one line: per cent signs and line feeds are encoded."""
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unline(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turns(turns: DataFrame) -> DataFrame:
    """turns (conv, turn, role, text) with `formatted` and the code points [loss_start, loss_end) of it that count for the loss.

    The formatted conversation is the concatenation of its turns' pieces in order.  The loss mask covers assistant
    texts only, without marks.
    """
    role, body = escape(_line(F.col("role"))), escape(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    marked = F.col("role") == "assistant"
    return turns.select(
        "*", F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(marked, F.length(head)).alias("loss_start"), F.when(marked, F.length(head) + F.length(body)).alias("loss_end"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """role, text and loss text, read back from `formatted` and its loss span alone."""
    body = F.substring(F.col("formatted"), F.lit(len(OPEN) + 1), F.length("formatted") - len(OPEN) - len(CLOSE))
    cut = F.instr(body, "\n")
    role = _unline(unescape(F.substring(body, F.lit(1), cut - 1)))
    return formatted.select(
        "conv", "turn", role.alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"),
        unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))).alias("loss_text"),
        F.length("formatted").alias("n_chars"),
    )


def digest_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    turns: as read_turns gives them.  Turns are taken in order of turn (null first), then role, then text.  The rows of a
    conversation are hashed as they stream past, so a conversation of any length needs the memory of one batch.
    """
    key, kind = "conv", turns.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        now, state, done, types = None, None, [], None

        def flush():
            cols = list(zip(*done))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[f.name for f in schema.fields])

        close = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
        for b in batches:
            types = [b.schema.types[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for conv, role, text, loss, n in zip(*(b.column(c).to_pylist() for c in (key, "role", "text", "loss_text", "n_chars"))):
                if state is None or conv != now:
                    if state is not None:
                        done.append(close(state))
                    now, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += n
            if len(done) >= 10_000:
                yield flush()
                done = []
        if state is not None:
            done.append(close(state))
            yield flush()

    dealt = turns.repartition(F.col(key)).sortWithinPartitions(key, F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.select(key, "role", "text", "loss_text", "n_chars").mapInArrow(run, schema)


def format_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Formatted turns of a table of rows by turn: conv, turn, role, text, formatted, loss_start, loss_end.

    Null roles and texts are empty.  Conversations with a null id form one conversation of their own.  Repeated rows are
    repeated turns.  Extra columns are left out.  An empty table gives an empty result.
    """
    return format_turns(turns_from_rows(df, id_col, turn_col))
