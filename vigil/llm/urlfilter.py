"""URL filters.

Each URL is expanded into host-suffix and path-prefix expressions; expressions equi-join with the rules on the
first bytes of their SHA-256, full digests confirm a match, and the longest rule decides.

Only the expansions that some rule could equal are made: a rule has a shape (number of host labels, length of its
path), and the distinct shapes of the rule set say which suffixes and prefixes to build.  Every rule is found, and a URL
gives one expression for each shape at most.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ascii_lower, fresh, without

RULE_SCHEMA = "host string, path string, verdict string"
#: Rules up to this number are sent to every executor (about 200 bytes each); beyond it the join is shuffled.
BROADCAST_RULES = 100_000
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null or without `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with columns host, path, rule and verdict.

    rules: host, path, verdict.  A rule fits its host and every subdomain if the path starts with the rule's path.
    The longest rule (host and path together) wins; of equals the longer host, then `block` before `allow`.
    Without a rule, rule is null and verdict is `default`.

    Nulls and URLs without `://` have an empty host and path, which no rule fits.  Repeated rows are each judged; equal
    URLs are matched once.  Rules with a null or empty host fit nothing.  Columns named host, path, rule or verdict
    are replaced; all others pass.  Empty tables give empty results.
    """
    spark = pages.sparkSession
    out = without(pages, *[c for c in ("host", "path", "rule", "verdict") if c.lower() != url_col.lower()])
    rules = (
        rules.select(ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"))
        .where(F.length("r_host") > 0)
        .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
        .withColumn("digest", F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    )
    shapes = rules.select(F.size(F.split("r_host", r"\.")).alias("n"), F.length("r_path").alias("m")).distinct().collect()
    # the shapes are data in one literal: the plan is as large for a thousand of them as for one
    shape_list = F.from_json(F.lit(json.dumps(sorted(map(list, shapes)))), "array<array<int>>")

    u_host, u_path, h, p, b_rule, b_verdict = fresh(out.columns, "host", "path", "h", "p", "b_rule", "b_verdict")
    urls = out.select(host_of(F.col(f"`{url_col}`")).alias(h), path_of(F.col(f"`{url_col}`")).alias(p)).where(F.length(h) > 0).distinct()
    labels = F.split(h, r"\.")
    fitting = F.filter(shape_list, lambda s: (F.size(labels) >= s[0]) & (F.length(p) >= s[1]))
    keys = F.transform(fitting, lambda s: F.sha2(F.concat_ws("\n", F.array_join(F.slice(labels, -s[0], s[0]), "."), F.substring(F.col(p), F.lit(1), s[1])), 256))
    tried = urls.select(h, p, F.explode(keys).alias("tried")).withColumn("short", F.substring("tried", 1, PREFIX_HEX))
    n_rules = rules.limit(BROADCAST_RULES + 1).count()
    table = F.broadcast(rules) if n_rules <= BROADCAST_RULES else rules
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("r_verdict") == "block", "r_host", "r_path", "r_verdict")
    best = (
        tried.join(table, "short").where(F.col("tried") == F.col("digest"))
        .groupBy(h, p).agg(F.max(rank).alias("best"))
        .select(h, p, F.concat("best.r_host", "best.r_path").alias(b_rule), F.col("best.r_verdict").alias(b_verdict))
    )
    keyed = out.withColumn(u_host, host_of(F.col(f"`{url_col}`"))).withColumn(u_path, path_of(F.col(f"`{url_col}`")))
    joined = keyed.join(best, (F.col(u_host) == F.col(h)) & (F.col(u_path) == F.col(p)), "left")
    named = {"host": F.col(u_host), "path": F.col(u_path), "rule": F.col(b_rule), "verdict": F.coalesce(b_verdict, F.lit(default))}
    kept = [F.col(f"`{c}`") for c in out.columns]
    return joined.select(*kept, *[e.alias(n) for n, e in named.items() if n not in out.columns])
