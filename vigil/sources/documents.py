"""Readers of texts that hold commands: attack windows, document examples, narratives, transcripts, annotated sequences.

Each takes a table with one whole text a row and works by native expressions: patterns cut the text, and what depends on
earlier lines is a running sum over a window of the text's key, which must be unique.  Null and empty texts give no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import argv, basename, last_wins, let
from ..operators.selection import first_per

# The formats that the sources are written in.
WINDOW_TIME = "MM/dd/yyyy HH:mm:ss"
FENCE_OR_HEADING = r"(?dms)^[ \t]{0,3}(`{3,}|~{3,})([^\n]*)\n(.*?)(^[ \t]{0,3}\1[^\n]*$|\z)|^(#{1,6})[ \t]+([^\n]*)"
EXAMPLES = r"(?i)^examples?\b"
EVENT_LINE = r"(?dm)^\s*\[([^\]]+)\] -> Event 1 \([^\n]*?\): ([^\n]*)$"
EVENT_FIELD = r"(?s)(?:^| \| )([A-Z][A-Za-z0-9]*): (.*?)(?=\z| \| [A-Z][A-Za-z0-9]*: )"
SNIPPET = r"(?s)\[ Code-snippet \]:\s*\n(.*?)\n\[ Resolved Code \]:.*?\[ GROUND-TRUTH & ALL INFORMATION \]:\s*\n(.*?)(?=\n-{10,}|\z)"


@dataclass(frozen=True)
class Shell:
    """How a shell shows that it waits for input, the sign that makes the next one ordinary, and what ends a line that goes on."""

    name: str
    prompt: str
    escape: str
    more: str


#: The shells whose prompts documents and transcripts show, each as its documentation gives the default prompt.
SHELLS = (
    Shell("powershell", r"(?:\[[^\[\]\n]+\]:? ?)*(?:[^\s\\>]+\\)?PS(?:\s[^>\n]*)?>+", "`", "|,"),  # [host]: PS C:\dir>, and >> when nested
    Shell("exchange", r"\[PS\] [^>\n]*>", "`", "|,"),
    Shell("cmd", r"[A-Za-z]:\\[^<>|\n]*>", "^", "^"),  # C:\dir>
    Shell("posix", r"[\w.-]+@[\w.-]+:[^#$\n]*[#$](?=\s)", "\\", "|"),  # user@host:dir$, # for root
    Shell("console", r"[A-Z]{2,3} /[^>\n]*>", "`", "|,"),
)
#: A line's prompts; examples repeat them by mistake.
PROMPT = "^(?:(?:" + "|".join(s.prompt for s in SHELLS) + r")[ \t]*)+"
#: Signs at a line's end after which a command goes on: those for more, and escapes of the line end.
MORE = "".join(sorted({c for s in SHELLS for c in s.more + s.escape}))


def scanned(line: Column) -> Column:
    """What a line of code leaves open, from one walk along its characters: (round, curly, more, code).

    round and curly: how many more brackets it opens than it closes; more: whether it ends in a sign after which a command
    goes on; code: whether it holds any.  Quoted strings, escaped characters and comments, which begin with # at a word's
    start, count for nothing.
    """
    start = F.struct(F.lit("").alias("mode"), F.lit("").alias("last"), F.lit(True).alias("edge"), F.lit(0).alias("round"), F.lit(0).alias("curly"))

    def step(s: Column, c: Column) -> Column:
        mode, code = s["mode"], s["mode"] == ""
        within = F.when(mode == "#", "#").when((mode == '"') & (c == "`"), '"`').when(mode == '"`', '"').when((mode == "skip") | (mode == c), "").otherwise(mode)
        opened = F.when(c.isin("`", "^"), "skip").when(c.isin("'", '"'), c).when((c == "#") & s["edge"], "#").otherwise("")
        blank = c.rlike(r"^\s$")
        delta = lambda a, b: F.when(code & (c == a), 1).when(code & (c == b), -1).otherwise(0)
        last = F.when(code & (blank | (opened == "#")) | (mode == "#"), s["last"]).when(code, c).otherwise("x")
        return F.struct(
            F.when(code, opened).otherwise(within).alias("mode"), last.alias("last"), (code & (blank | c.isin("(", "{", ";", "|"))).alias("edge"),
            (s["round"] + delta("(", ")")).alias("round"), (s["curly"] + delta("{", "}")).alias("curly"),
        )

    def result(s: Column) -> Column:
        more = (s["last"] != "") & F.contains(F.lit(MORE), s["last"])
        return F.struct(s["round"].alias("round"), s["curly"].alias("curly"), more.alias("more"), (s["last"] != "").alias("code"))

    return F.aggregate(F.filter(F.split(line, ""), lambda c: c != ""), start, step, result)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the files under a path, one row each."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def _lines(text: Column) -> Column:
    """The lines that hold more than white space, stripped."""
    return F.filter(F.transform(F.split(text, r"\r?\n"), _strip), lambda x: x != "")


def attack_windows(files: DataFrame, text: str) -> DataFrame:
    """files without `text`, with begin, finish (wall times, no zone) and programs, of `[occurTime] .. [PName] ..` texts.

    Texts without just one `[PName]` or with fewer than two times give no row.  A time that cannot be read is null.
    Programs are in lower case without .exe, each once, in order.
    """
    parts = F.split(F.regexp_replace(text, "^\ufeff", ""), r"\[PName\]")
    times = _lines(F.replace(F.get(parts, F.lit(0)), F.lit("[occurTime]"), F.lit("")))
    names = F.transform(_lines(F.get(parts, F.lit(1))), lambda n: F.regexp_replace(F.lower(n), r"\.exe\z", ""))
    at = [F.try_to_timestamp(F.get(times, F.lit(i)), F.lit(WINDOW_TIME)).cast("timestamp_ntz") for i in (0, 1)]
    formed = files.where((F.size(parts) == 2) & (F.size(times) >= 2))
    return formed.withColumns({"begin": at[0], "finish": at[1], "programs": F.array_sort(F.array_distinct(names))}).drop(text)


def example_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number, language, code) of the fenced blocks of a Markdown text that stand under a heading `Example..`.

    Blocks are numbered along the whole text.  A fence ends at a line that starts with its own fence; one that never ends
    gives no block.  Such a heading holds until a heading of its level or above that is another.
    """
    items = docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(FENCE_OR_HEADING), F.lit(0))).alias("pos", "item"))
    group = {n: F.regexp_extract("item", FENCE_OR_HEADING, i) for i, n in enumerate(("fence", "language", "code", "end", "hashes", "title"), 1)}
    cut = items.select(key, "pos", *[c.alias(n) for n, c in group.items()]).withColumn("level", F.length("hashes"))
    along = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opens = (F.col("level") > 0) & F.col("title").rlike(EXAMPLES)
    part = F.sum(opens.cast("int")).over(along)
    cut = cut.withColumns({"part": part, "number": F.sum((F.col("level") == 0).cast("int")).over(along).cast("int"), "held": F.last(F.when(opens, F.col("level")), ignorenulls=True).over(along)})
    within = Window.partitionBy(key, "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    highest = F.min(F.when((F.col("level") > 0) & ~opens, F.col("level"))).over(within)
    shown = cut.withColumn("highest", highest).where("level = 0 and part > 0 and end <> '' and (highest is null or highest > held)")
    return shown.select(key, "number", F.lower(F.trim("language")).alias("language"), F.regexp_replace("code", r"\n\z", "").alias("code"))


def submissions(blocks: DataFrame, keys: list[str], code: str) -> DataFrame:
    """(keys, occurrence, input): what was typed in a block; occurrence counts from 1.

    With prompts (see SHELLS), a submission is the text after one and the lines that go on with it: marked `>>`, after a
    line that ends in a sign for more, while brackets are open, or inside a block comment or here-string, where prompts
    do not count; other lines are output.  A block without prompts is one submission.
    """
    lines = blocks.select(*keys, F.posexplode(F.split(code, r"\r?\n")).alias("pos", "line"))
    whole, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    along, rest = before.rowsBetween(Window.unboundedPreceding, 0), before.rowsBetween(0, Window.unboundedFollowing)
    begun = F.size(F.regexp_extract_all("line", F.lit(r"<#|@['\"]\s*$"), F.lit(0)))
    ended = F.size(F.regexp_extract_all("line", F.lit(r"#>|^['\"]@"), F.lit(0)))
    quoted = (F.coalesce(F.sum(begun - ended).over(before), F.lit(0)) > 0) & (F.sum(ended).over(rest) > 0)
    lines = lines.withColumns({"quoted": quoted, "prompt": F.col("line").rlike(PROMPT) & ~quoted})
    body = F.when(F.col("prompt"), F.regexp_replace("line", PROMPT, "")).when(F.col("quoted"), F.col("line")).otherwise(F.regexp_replace("line", r"^\s*>>\s?", ""))
    lines = lines.withColumns({"part": F.sum(F.col("prompt").cast("int")).over(along), "prompts": F.sum(F.col("prompt").cast("int")).over(whole), "body": body})
    lines = lines.withColumn("open", F.when(~F.col("quoted"), scanned(F.col("body"))))
    mine = Window.partitionBy(*keys, "part").orderBy("pos")
    earlier = mine.rowsBetween(Window.unboundedPreceding, -1)
    unfinished = F.coalesce(F.last(F.when(F.col("open.code"), F.col("open.more")), ignorenulls=True).over(earlier), F.lit(False))
    depth = F.greatest(*[F.coalesce(F.sum(f"open.{kind}").over(earlier), F.lit(0)) for kind in ("round", "curly")])
    goes_on = F.col("quoted") | F.col("line").rlike(r"^\s*(>>|\{)") | unfinished | (depth > 0)
    lines = lines.withColumn("stops", F.when(F.col("prompts") == 0, False).when(F.col("prompt"), F.trim("body") == "").otherwise(~goes_on))
    lines = lines.withColumn("output", F.max("stops").over(mine.rowsBetween(Window.unboundedPreceding, 0)))
    kept = lines.where(~F.col("output") & ((F.col("part") > 0) | (F.col("prompts") == 0)))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"])
    whole_input = kept.groupBy(*keys, "part", "prompts").agg(F.array_join(pieces, "\n").alias("input"))
    typed = whole_input.withColumn("input", F.when(F.col("prompts") == 0, _strip(F.col("input"))).otherwise(F.regexp_replace("input", r"\s+\z", ""))).where("input <> ''")
    return typed.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("part")).alias("occurrence"), "input")


def narrative_events(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, occurrence, at, image, command) of the launches that a narrative tells of, each identity once.

    occurrence counts the launch lines of a text from 0, those left out included.  Lines without image or command give no
    row.  The identity is the record's id or, without one, its time, process and command.
    """
    times, told = (F.regexp_extract_all(text, F.lit(EVENT_LINE), F.lit(i)) for i in (1, 2))

    def launch(f: Column, at: Column) -> Column:
        parts = F.to_json(F.struct(at.alias("at"), *[F.coalesce(f[n], F.lit("")).alias(n) for n in ("ProcessGuid", "ProcessId", "Image", "CommandLine")]))
        return F.struct(at.alias("at"), f["Image"].alias("image"), f["CommandLine"].alias("command"), F.coalesce(F.nullif(f["EventRecordID"], F.lit("")), parts).alias("identity"))

    def fields(line: Column) -> Column:
        names, values = (F.regexp_extract_all(line, F.lit(EVENT_FIELD), F.lit(i)) for i in (1, 2))
        return last_wins(names, F.transform(values, _strip))

    # read inside the generator: filters on a column of fields are pushed below it and read them again
    found = F.transform(F.arrays_zip(times.alias("at"), told.alias("told")), lambda e: let(fields(e["told"]), lambda f: launch(f, e["at"])))
    rows = docs.select(key, F.posexplode(found).alias("occurrence", "e")).select(key, "occurrence", "e.*")
    full = rows.where("image <> '' and command <> ''")
    return first_per(full, [key, "identity"], F.col("occurrence")).select(key, "occurrence", "at", "image", "command")


def prompt_commands(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, program, args), each once: commands typed in a transcript, after a prompt or, without one, with a flag or path.

    program is the last component of its path in lower case.
    """
    lines = docs.select(key, F.explode(F.split(text, r"\r?\n")).alias("line"))
    asked = F.col("line").rlike(PROMPT)
    words = lines.select(key, asked.alias("asked"), argv(F.regexp_replace("line", PROMPT, "")).alias("words")).where("size(words) > 0")
    named = F.get("words", F.lit(0)).rlike(r"^[A-Za-z_./\\][A-Za-z0-9_./\\-]*$")
    told = F.coalesce(F.get("words", F.lit(1)), F.lit(""))
    words = words.where(F.col("asked") | (named & (told.startswith("/") | told.rlike("^-[A-Za-z]") | told.rlike(r"^\w+="))))
    program = F.lower(basename(F.get("words", F.lit(0)), F.lit("windows")))
    return words.select(key, program.alias("program"), F.slice("words", 2, F.size("words")).alias("args")).distinct()


def sequence_snippets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, code, platform, label) of the snippets of annotated sequences; malicious unless the truth says BENIGN."""
    code, about = (F.regexp_extract_all(text, F.lit(SNIPPET), F.lit(i)) for i in (1, 2))
    rows = docs.select(key, F.posexplode(F.arrays_zip(code.alias("code"), about.alias("about"))).alias("pos", "s")).select(key, "pos", "s.*")
    platform = F.regexp_extract("about", r"(?m)^- PLATFORM:[ \t]*(.*)$", 1)
    benign = F.regexp_extract("about", r"(?m)^- GROUND-TRUTH:[ \t]*(.*)$", 1).contains("BENIGN")
    return rows.select(key, "pos", _strip(F.col("code")).alias("code"), F.coalesce(F.nullif(platform, F.lit("")), F.lit("unknown")).alias("platform"), F.when(benign, "benign").otherwise("malicious").alias("label"))
