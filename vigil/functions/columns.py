"""Expressions of columns, all of them native; flatten_envelope takes a table, as it needs columns on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What telemetry writes for a missing value.
MISSING = ("", "-", "null", "(null)")


def basename(pgm: Column, os: Column) -> Column:
    """The last component of a program path: both slashes part a Windows path, `/` any other."""
    return F.when(os == "windows", F.regexp_extract(pgm, r"([^/\\]*)$", 1)).otherwise(F.substring_index(pgm, "/", -1))


def final_label(dataset: Column, ai: Column, override: Column) -> Column:
    """Override, else a known AI label, else the dataset's own unless it only speaks for a group, else unknown."""
    return F.coalesce(override, F.nullif(ai, F.lit("unknown")), F.nullif(dataset, F.lit("malicious-group")), F.lit("unknown"))


def session_label(ai: Column, override: Column) -> Column:
    """Sessions differ from commands: an AI label of unknown counts."""
    return F.coalesce(override, ai, F.lit("unknown"))


def session_fallback(session: Column, dataset: Column, record: Column) -> Column:
    return F.coalesce(F.nullif(session, F.lit("")), F.concat(dataset, F.lit(":record:"), record))


def first_usable(*names: Column) -> Column:
    """The first field that is not one of MISSING."""
    return F.coalesce(*[F.when(~F.trim(c).isin(*MISSING), c) for c in names])


def tokens(text: Column) -> Column:
    """Quoted strings, operators and bare words of a command line."""
    return F.regexp_extract_all(text, F.lit(r'"[^"]*"|[|&;<>]+|[^\s|&;<>"]+'), F.lit(0))


def argv(text: Column) -> Column:
    """Arguments parted by white space; double quotes hold one together and are dropped."""
    return F.transform(F.regexp_extract_all(text, F.lit(r'(?:"[^"]*"|[^\s"]++)+'), F.lit(0)), lambda w: F.replace(w, F.lit('"'), F.lit("")))


def usable_id(value: Column) -> Column:
    """NULL for identifiers that hold only braces, zeros and dashes."""
    return F.when(F.translate(value, "{}0-", "") != "", value)


def endpoint(host: Column, port: Column) -> Column:
    """host:port, or NULL for a port that is no number from 1 to 65535."""
    n = port.try_cast("int")
    return F.when(n.between(1, 65535) & (host != ""), F.concat_ws(":", host, n))


def unwrap(text: Column) -> Column:
    """Export wrappers off: HTML entities, doubled backslashes, Markdown fences."""
    for old, new in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"), ("\\\\", "\\")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, r"^```[a-z]*\n|\n```$", "")


def decode_hex(value: Column) -> Column:
    """Text of a hex string of even length, U+FFFD for bytes that are no UTF-8; other values unchanged."""
    return F.when(value.rlike(r"^([0-9A-Fa-f]{2})+\z"), F.make_valid_utf8(F.unhex(value).cast("string"))).otherwise(value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it and wherever filters are pushed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def last_wins(keys: Column, values: Column) -> Column:
    """A map of two arrays of the same length; of a repeated key the last counts."""
    return let(values, lambda v: last_entries(F.transform(keys, lambda k, i: F.struct(k.alias("key"), F.get(v, i).alias("value")))))


def last_entries(entries: Column) -> Column:
    """A map of an array of (key, value); of a repeated key the last counts.  Entries are sorted by key and place, and the last of each run stays."""
    placed = F.transform(entries, lambda e, i: F.struct(e["key"].alias("k"), i.alias("i"), e["value"].alias("v")))
    ends = let(F.sort_array(placed), lambda run: F.filter(run, lambda p, i: ~F.get(run, i + 1)["k"].eqNullSafe(p["k"])))
    return let(ends, lambda e: F.map_from_arrays(e["k"], e["v"]))


def key_values(line: Column) -> Column:
    """key=value pairs of a line as a map; of a repeated key the last counts."""
    pattern = F.lit(r'([A-Za-z_][A-Za-z0-9_]*)=("[^"]*"|\S+)')
    keys, values = F.regexp_extract_all(line, pattern, F.lit(1)), F.regexp_extract_all(line, pattern, F.lit(2))
    return last_wins(keys, F.transform(values, lambda v: F.replace(v, F.lit('"'), F.lit(""))))


#: Forms of times: year or day first, with a fraction of 1 to 9 digits and an offset or without; mail; and seconds or milliseconds since 1970.
YEAR_FIRST = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:[.,](\d{1,9}))?\s*(Z|z|[+-]\d{2}:?\d{2})?\s*$"
DAY_FIRST = r"^\s*(\d{2}/\d{2}/\d{4}) (\d{2}:\d{2}:\d{2})(?:[.,](\d{1,9}))?\s*$"
EPOCH = r"^\s*(?:(\d{9,10})(?:\.(\d{1,9}))?|(\d{12,13})(?:\.(\d{1,9}))?)\s*$"


def parse_time(text: Column, zone: Column | str = "UTC") -> Column:
    """The time that a text gives, to the microsecond (further digits are cut off), or null.

    ISO text and day-first text, with a fraction and an offset (with or without colon) or without; RFC 2822 text; epoch
    seconds of 9 or 10 digits and milliseconds of 12 or 13, with a fraction or without.  Texts without an offset are
    in `zone`.  Other numbers, such as 20240102, are no times.
    """
    zone = F.lit(zone) if isinstance(zone, str) else zone
    part = lambda pattern, i: F.regexp_extract(text, pattern, i)
    micros = lambda digits: F.rpad(F.substring(digits, 1, 6), 6, "0").cast("long")  # noqa: E731  of the digits behind a point
    read = lambda pattern, form: F.try_to_timestamp(F.concat_ws(" ", part(pattern, 1), part(pattern, 2)), F.lit(form))
    later = lambda ts, us: F.timestamp_micros(F.unix_micros(ts) + us)
    offset = F.replace(part(YEAR_FIRST, 4), F.lit(":"), F.lit(""))
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 4, 2).try_cast("int")
    east = F.when(offset.isin("Z", "z"), 0).when(offset.startswith("-"), -minutes).when(offset.startswith("+"), minutes)
    iso = read(YEAR_FIRST, "yyyy-MM-dd HH:mm:ss")
    iso = F.when(offset == "", F.to_utc_timestamp(iso, zone)).otherwise(later(iso, -east.cast("long") * 60_000_000))
    day = F.to_utc_timestamp(read(DAY_FIRST, "dd/MM/yyyy HH:mm:ss"), zone)
    mail = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z]{3},\s*", ""), r"\s+(GMT|UT|UTC|Z)$", " +0000")
    seconds, thousandths = part(EPOCH, 1).try_cast("long"), part(EPOCH, 3).try_cast("long")
    behind = F.substring(F.rpad(F.concat(F.substring(part(EPOCH, 4), 1, 3), F.lit("000")), 3, "0"), 1, 3)
    epoch = F.coalesce(F.timestamp_micros(seconds * 1_000_000 + micros(part(EPOCH, 2))), F.timestamp_micros(thousandths * 1000 + behind.cast("long")))
    return F.coalesce(later(iso, micros(part(YEAR_FIRST, 3))), later(day, micros(part(DAY_FIRST, 3))), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")), epoch)


def normal_path(path: Column) -> Column:
    """A Windows path in lower case with backslashes, without empty, `.` and resolved `..` parts; a leading double one stays."""
    flat = F.lower(F.replace(path, F.lit("/"), F.lit("\\")))
    lead = F.regexp_extract(flat, r"^(\\\\|\\|[a-z]:\\?)?", 0)
    up = lambda acc: F.coalesce(F.element_at(acc, F.when(F.size(acc) > 0, -1)), F.lit("..")) == ".."
    parts = F.aggregate(
        F.filter(F.split(F.substring(flat, F.length(lead) + 1, F.length(flat)), r"\\"), lambda x: ~x.isin("", ".")), F.array().cast("array<string>"),
        lambda acc, x: F.when((x == "..") & ~up(acc), F.slice(acc, F.lit(1), F.size(acc) - 1)).when((x == "..") & lead.endswith("\\"), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return F.when(path.isNotNull(), F.coalesce(F.nullif(F.concat(lead, F.array_join(parts, "\\")), F.lit("")), F.lit(".")))


#: The documented hives of the registry and their short names.
HIVES = {"hkey_local_machine": "hklm", "hkey_current_user": "hkcu", "hkey_classes_root": "hkcr", "hkey_users": "hku", "hkey_current_config": "hkcc"}


def registry_key(key: Column) -> Column:
    """A registry key in lower case that begins with the short name of its hive; the hive may have a colon, as in PowerShell's paths."""
    low = F.lower(key)
    first = F.substring_index(low, "\\", 1)
    hive = F.when(first.endswith(":"), F.substring(first, F.lit(1), F.length(first) - 1)).otherwise(first)
    short = hive
    for long, name in HIVES.items():
        short = F.when(hive == long, name).otherwise(short)
    return F.concat(short, F.substring(low, F.length(first) + 1, F.length(low)))


def same_program(one: Column, two: Column, os: Column) -> Column:
    """Whether two program paths end in the same name, whatever the case of its letters."""
    return F.lower(basename(one, os)) == F.lower(basename(two, os))


def starts_with_program(text: Column, image: Column) -> Column:
    """Whether a command line begins with this image, in any case, as a whole word."""
    n = F.length(image)
    return (image != "") & (F.lower(F.substring(text, F.lit(1), n)) == F.lower(image)) & F.substring(text, n + 1, F.lit(1)).rlike(r"^\s?\z")


def technique_ids(text: Column) -> Column:
    """The technique ids (T and four digits, with a dot and three more for a part) among the words of a text, each once, in order.

    A word is a run of letters, digits, `_` and dots; dots at its ends belong to the sentence.
    """
    words = F.transform(F.split(text, r"[^A-Za-z0-9_.]+"), lambda w: F.trim(w, F.lit(".")))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w.rlike(r"^T\d{4}(\.\d{3})?$"))))


#: Fields of an event that hold more of its fields, outer ones first.
ENVELOPES = ("EventData", "event_data", "columns", "event", "data")


#: A field of XML event data, and the entities in its text.
XML_FIELD = r"""(?s)<Data\s+Name\s*=\s*["']([^"']*)["'][^>]*?(?:/>|>(.*?)</Data>)"""
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def _unescaped(text: Column) -> Column:
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def xml_fields(text: Column) -> Column:
    """The named data fields of an XML event as a map of texts, also of one that is cut off: fields that are not whole are left out."""
    names, values = (F.regexp_extract_all(text, F.lit(XML_FIELD), F.lit(i)) for i in (1, 2))
    return last_wins(F.transform(names, _unescaped), F.transform(values, _unescaped))


def flatten_envelope(df: DataFrame, text: str, name: str = "fields") -> DataFrame:
    """df with the fields of a JSON event as a map of texts; null for text that is no JSON object.  Of a field that occurs twice the later one counts.

    First come the fields of the event, or of its `_source`, and those inside ENVELOPES.  Then `process.command_line`,
    `process.executable` and `ppid` of an object `process`, the name of an object `host`, and `_id` after its index.  Then the
    fields of an object `Event`, by the same rules.  Last come fields that are kept as text: an `EventData` of JSON or
    XML, and the XML event of a `SyslogMessage`, their escaped signs restored.  Each map is a column of its own on
    the way, so it is parsed once.
    """
    none = F.create_map().cast("map<string, string>")
    object_ = lambda c: F.coalesce(F.from_json(F.when(F.ltrim(c).startswith("{"), c), "map<string, string>"), none)

    def merged(rows: DataFrame, maps: list[str], out: str) -> DataFrame:
        return rows.withColumn(out, last_entries(F.concat(*map(F.map_entries, maps)))).drop(*maps)

    def opened(rows: DataFrame, top: str, out: str) -> DataFrame:
        """The map column `top` with the fields of its envelopes, process and host, as `out`."""
        rows = rows.withColumns({f"_in_{e}": F.when(~F.col("_as_text"), object_(F.col(top)[e])).otherwise(none) if e == "EventData" else object_(F.col(top)[e]) for e in ENVELOPES})
        rows = merged(rows, [top, *(f"_in_{e}" for e in ENVELOPES)], "_flat")
        rows = rows.withColumns({"_process": object_(F.col("_flat")["process"]), "_host": object_(F.col("_flat")["host"])}).withColumn("_parent", object_(F.col("_process")["parent"]))
        process, host = F.col("_process"), F.col("_host")
        extra = F.map_from_arrays(
            F.array(*map(F.lit, ("process.command_line", "process.executable", "ppid", "host"))),
            F.array(process["command_line"], process["executable"], F.col("_parent")["pid"], F.coalesce(host["name"], host["hostname"])),
        )
        rows = rows.withColumn("_extra", F.map_filter(extra, lambda _, v: v.isNotNull()))
        return merged(rows, ["_flat", "_extra"], out).drop("_process", "_host", "_parent")

    # in a map of texts an object looks like a text that holds one
    as_text = F.coalesce(F.col(text).rlike(r'"EventData"\s*:\s*"'), F.lit(False))
    rows = df.withColumns({"_whole": F.from_json(F.col(text), "map<string, string>"), "_as_text": as_text}).withColumn("_source", object_(F.col("_whole")["_source"]))
    whole, source = F.col("_whole"), F.col("_source")
    ident = F.when(whole["_id"].isNotNull(), F.create_map(F.lit("_id"), F.concat_ws(":", whole["_index"], whole["_id"]))).otherwise(none)
    rows = rows.withColumns({"_top": F.when(F.size(source) > 0, source).otherwise(F.coalesce(whole, none)), "_ident": ident})
    rows = merged(opened(rows, "_top", "_outer"), ["_outer", "_ident"], "_outer2")
    rows = opened(rows.withColumn("_event", object_(F.col("_outer2")["Event"])), "_event", "_inner")
    rows = merged(rows, ["_outer2", "_inner"], "_all")
    data, message = _unescaped(F.col("_all")["EventData"]), _unescaped(F.col("_all")["SyslogMessage"])
    from_data = F.when(~F.col("_as_text"), none).when(F.ltrim(data).startswith("{"), object_(data)).when(F.contains(data, F.lit("<EventData")), xml_fields(data)).otherwise(none)
    from_message = F.when(F.contains(message, F.lit("<Event")), xml_fields(message)).otherwise(none)
    rows = merged(rows.withColumns({"_data": F.coalesce(from_data, none), "_message": F.coalesce(from_message, none)}), ["_all", "_data", "_message"], "_every")
    return rows.withColumn(name, F.when(F.col("_whole").isNotNull(), F.col("_every"))).drop("_whole", "_as_text", "_source", "_every")


def valid_probabilities(*p: Column) -> Column:
    """Finite values from 0 to 1 that sum to 1, give or take a thousandth."""
    total = sum(p[1:], p[0])
    ok = F.abs(total - 1) <= 0.001
    for x in p:
        ok = ok & ~F.isnan(x) & x.between(0, 1)
    return F.coalesce(ok, F.lit(False))


def canonical_json(fields: Column) -> Column:
    """A map as JSON with its keys in order, so that equal maps have equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields))))


def combined_label(label: Column) -> Column:
    """Aggregate: any malicious makes malicious, all benign makes benign, anything else unknown."""
    return F.when(F.bool_or(label == "malicious"), "malicious").when(F.bool_and(label == "benign"), "benign").otherwise("unknown")


def token_cost(n_in: Column, n_out: Column, tier: int, low: float, high: float, out: float) -> Column:
    """Cost of a request: input tokens up to `tier` cost `low`, those beyond `high`; output tokens cost `out`."""
    return F.least(n_in, F.lit(tier)) * low + F.greatest(n_in - tier, F.lit(0)) * high + n_out * out
