"""What an import of exported records decides: records that cannot be read, forms of one input, and the summary of what came in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import small


def json_records(lines: DataFrame, record: str, text: str, fields: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of lines with one JSON object each: lines with `fields` (a schema) in place of text, and (record, reason, raw).

    A line that is null or blank is `empty`, one that is no JSON `malformed-json`, and one that holds something else than an
    object `no-object`.  Nothing goes unseen: every line is in one of the two.
    """
    # as the one item of a list, since what stands behind a value would be passed over
    parsed = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit("]")))
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant"))
    more = F.try_variant_get(parsed, "$[1]", "variant").isNotNull()
    reason = F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty").when(parsed.isNull() | more, "malformed-json").when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "no-object")
    judged = lines.withColumn("_reason", reason)
    rejects = judged.where("_reason is not null").select(record, F.col("_reason").alias("reason"), F.col(text).alias("raw"))
    good = judged.where("_reason is null").withColumn("_fields", F.from_json(text, fields))
    return good.select(*[c for c in lines.columns if c != text], "_fields.*"), rejects


def reject_counts(rejects: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, reason, n): how many records were left out, and why."""
    return rejects.groupBy(*(keys or []), "reason").agg(F.count("*").alias("n"))


def endpoints(source: Column, source_port: Column, target: Column, target_port: Column) -> Column:
    """(source, source_port, target, target_port), or null unless both hosts are given and both ports are whole numbers from 1 to 65535 in digits."""
    ports = [F.when(p.cast("string").rlike(r"^[0-9]+$"), p.cast("string").try_cast("bigint")) for p in (source_port, target_port)]
    ok = (source != "") & (target != "") & ports[0].between(1, 65535) & ports[1].between(1, 65535)
    return F.when(ok, F.struct(source.alias("source"), ports[0].cast("int").alias("source_port"), target.alias("target"), ports[1].cast("int").alias("target_port")))


#: Named entities of texts in HTML; others stay.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def _numbered(text: Column, pattern: str, base: int) -> Column:
    """text with the characters that its entities name by number."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def put(s: Column, entity: Column) -> Column:
        digits = F.lpad(F.conv(F.regexp_extract(entity, pattern, 1), base, 16), 8, "0")
        return F.replace(s, entity, F.decode(F.unhex(digits), "UTF-32"))

    return F.aggregate(found, text, put)


def exported_text(text: Column, json_escapes: bool = False, entities: bool = False, prefixes: tuple[str, ...] = ()) -> Column:
    """The text inside an export: the first of `prefixes` off, with the spaces behind it, then JSON escapes and then HTML entities restored, once each.

    A text whose escapes are no JSON keeps them.  Entities are those of ENTITIES and numbers, decimal and hexadecimal.
    """
    for prefix in prefixes:
        text = F.when(text.startswith(prefix), F.ltrim(F.substring(text, len(prefix) + 1, 1 << 30))).otherwise(text)
    if json_escapes:
        whole = F.concat(F.lit('["'), text, F.lit('"]'))
        text = F.when(F.try_parse_json(whole).isNotNull(), F.coalesce(F.get(F.from_json(whole, "array<string>"), F.lit(0)), text)).otherwise(text)
    if entities:
        for pattern, base in ((r"&#([0-9]{1,6});", 10), (r"&#[xX]([0-9a-fA-F]{1,5});", 16)):
            text = _numbered(text, pattern, base)
        for entity, sign in ENTITIES.items():
            text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def preferred_forms(events: DataFrame, keys: list[str], is_input: Column, is_failed: Column, is_wrapped: Column) -> DataFrame:
    """events with `reason`: why a form of an input is left out, or null for those that count.

    A connection may show an input as typed, wrapped in a message of its handler, and again as a failed command.  Where it
    has inputs as typed, wrapped ones are `ambiguous-fragment` and failed wrapped ones `failed-with-literal-input`; without
    any wrapped input, a failed wrapped one is `isolated-failed-fragment`.  Failed messages that are not wrapped echo an
    input: `handler-echo`.  Everything else that is no input is `no-input`.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    marked = events.withColumns({"_input": yes(is_input), "_failed": yes(is_failed), "_wrapped": yes(is_wrapped)})
    has = marked.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.bool_or(F.col("_input") & ~F.col("_wrapped")).alias("_typed"), F.bool_or(F.col("_input") & F.col("_wrapped")).alias("_inside"))
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    reason = (
        F.when(F.col("_wrapped") & F.col("_typed") & F.col("_input"), "ambiguous-fragment").when(F.col("_wrapped") & F.col("_typed") & F.col("_failed"), "failed-with-literal-input")
        .when(F.col("_wrapped") & F.col("_failed") & ~F.col("_inside"), "isolated-failed-fragment").when(~F.col("_wrapped") & F.col("_failed"), "handler-echo").when(~F.col("_input") & ~F.col("_failed"), "no-input")
    )
    return marked.join(small(has), on, "left").select(*events.columns, reason.alias("reason"))


def import_summary(commands: DataFrame, keys: list[str], text: str, label: str, session: str, top: int = 30) -> DataFrame:
    """For each group of keys: n and how many of each label, unknown_rate; texts, unknown_texts and their rate; sessions, and
    singletons, which have one command; frequent_unknown, the `top` unknown texts by count, then text.

    A text that has several labels counts by the smallest.  Rows are counted by text and by session first, so a group of
    any size costs the number of its different texts and sessions.  Null texts and sessions count as values.
    """
    by_text = commands.groupBy(*keys, text).agg(F.count("*").alias("_n"), F.min(label).alias("_label"), *[F.count_if(F.col(label) == name).alias(name) for name in ("malicious", "benign", "unknown")])
    unknown = F.col("_label") == "unknown"
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(text)))
    listed = by_text.where(unknown).withColumn("_place", place).where(F.col("_place") <= top)
    frequent = listed.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", F.col(text).alias("text"), F.col("_n").alias("n")))), lambda x: F.struct(x["text"].alias("text"), x["n"].alias("n"))).alias("frequent_unknown"))
    counts = by_text.groupBy(*keys).agg(F.sum("_n").alias("n"), *[F.sum(c).alias(c) for c in ("malicious", "benign", "unknown")], F.count("*").alias("texts"), F.count_if(unknown).alias("unknown_texts"))
    by_session = commands.groupBy(*keys, session).agg(F.count("*").alias("_n"))
    sessions = by_session.groupBy(*keys).agg(F.count("*").alias("sessions"), F.count_if(F.col("_n") == 1).alias("singletons"))
    out = counts
    for other in (sessions, frequent):
        named = other.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in other.columns if c not in keys])
        out = out.join(named, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], "left").drop(*[f"_of_{k}" for k in keys])
    rates = {"unknown_rate": F.col("unknown") / F.col("n"), "unknown_text_rate": F.col("unknown_texts") / F.col("texts")}
    return out.withColumns(rates).withColumn("frequent_unknown", F.coalesce("frequent_unknown", F.array().cast(dict(frequent.dtypes)["frequent_unknown"])))
