"""Words and commands of shell inputs, by native expressions.  Best effort: expansions and here-documents are not followed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let

# Runs inside the repeated groups are taken whole and never given back, so long words need no deep stack.
_QUOTED = r""""(?:[^"\\]++|\\.)*+"|'[^']*+'|\\."""
#: A command: everything up to a separator outside of quotes; a quote without its partner is no quote.
_COMMAND = rf"(?s)(?:[<>]&[\d-]*+|&>>?|{_QUOTED}|[^\"'\\;|&\n<>]++|[<>\"'])+"
_REDIRECT = r"\d*(?:&>>?|>>|>|<<<|<<|<)(?:&[\d-]*)?"
_WORD = rf"(?:{_QUOTED}|[^\s\"'\\;|&<>]++)+"
_PIECE = rf"(?s){_QUOTED}|[^\"'\\]++"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def unquoted(word: Column) -> Column:
    """A word without its quotes and escapes; single quotes keep all, double quotes unescape only `"`, `\\`, `$` and the backtick."""

    def plain(p: Column) -> Column:
        inner = F.substring(p, F.lit(2), F.length(p) - 2)
        return F.when(p.startswith("'"), inner).when(p.startswith('"'), F.regexp_replace(inner, r"""\\([\\"$`])""", "$1")).when(p.startswith("\\"), F.substring(p, 2, 1)).otherwise(p)

    return F.array_join(F.transform(_all(word, _PIECE), plain), "")


def shell_tokens(text: Column) -> Column:
    """Words, redirections and separators of an input as written, quotes and escapes included."""
    return _all(text, rf"(?s){_REDIRECT}|&&|\|\||[;|&\n]|{_WORD}")


def posix_argv(text: Column) -> Column:
    """Words of one command, unquoted."""
    return F.transform(_all(text, rf"(?s){_REDIRECT}|{_WORD}"), unquoted)


def invocations(text: Column) -> Column:
    """The commands of an input as arrays of unquoted words, program first; redirections and leading assignments go."""

    def kept(words: Column) -> Column:
        turned = lambda w: w.rlike(rf"\A{_REDIRECT}\z")
        return F.filter(words, lambda w, i: ~turned(w) & ~F.coalesce((i > 0) & F.get(words, i - 1).rlike(r"\A\d*&?[<>]+\z"), F.lit(False)))

    def command(words: Column) -> Column:
        first = F.array_position(F.transform(words, lambda w: ~w.rlike(r"\A[A-Za-z_]\w*=")), F.lit(True)).cast("int")
        return let(first, lambda start: F.when(start > 0, F.transform(F.slice(words, start, F.size(words)), unquoted)))

    # each step's words are bound once: named where they are used, they were parted anew for every word
    parted = lambda part: let(let(_all(part, rf"(?s){_REDIRECT}|{_WORD}"), kept), command)
    return F.filter(F.transform(_all(text, _COMMAND), parted), lambda c: c.isNotNull())


def utf16_base64(value: Column) -> Column:
    """Text of a base64 payload in UTF-16LE; null where it is none."""
    raw = F.try_to_binary(value, F.lit("base64"))
    units = F.regexp_replace(F.hex(raw), "(.{4})", "$1 ")
    lone = F.regexp_replace(units, "..D[89AB] ..D[C-F] ", "").rlike("..D[89A-F] ")
    return F.when((F.octet_length(raw) % 2 == 0) & ~lone, F.decode(raw, "UTF-16LE"))


def program_rules(launches: DataFrame, rules: DataFrame, program: Column, args: Column, name: str = "rule_label", most_rows: int = 100_000) -> DataFrame:
    """launches with the label of the first rule (program, pattern, label, priority) of their program whose pattern fits all args, joined by spaces.

    The rules of a program become one array, so a launch meets its rules in one equi-join and no row is repeated; up to
    `most_rows` programs with rules are broadcast.  Launches without a fitting rule have null.
    """
    each = F.array_sort(F.collect_list(F.struct("priority", "label", "pattern")))
    by = rules.where("program is not null and pattern is not null").groupBy(F.col("program").alias("_program")).agg(each.alias("_rules"))
    by = F.broadcast(by) if by.limit(most_rows + 1).count() <= most_rows else by
    met = launches.withColumns({"_key": program, "_args": F.array_join(args, " ")}).join(by, F.col("_key") == F.col("_program"), "left")
    fits = F.filter("_rules", lambda r: F.rlike(F.col("_args"), F.concat(F.lit(r"(?s)\A(?:"), r["pattern"], F.lit(r")\z"))))
    return met.withColumn(name, F.get(fits, F.lit(0))["label"]).drop("_key", "_args", "_program", "_rules")


def tag_defaults(rows: DataFrame, defaults: dict[str, str], tag: Column, name: str = "label") -> DataFrame:
    """rows with the default label of their tag where they have no label yet; tags without a default give unknown."""
    table = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    own = F.col(name) if name in rows.columns else F.lit(None).cast("string")
    return rows.withColumn(name, F.coalesce(own, F.try_element_at(table, tag), F.lit("unknown")))
