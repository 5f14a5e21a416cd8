"""URL rules: host-suffix and path-prefix expressions, joined to the rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import UPPER

# Up to this many rules are broadcast: a digest and three numbers each, at most about 25 MB.
BROADCAST_RULES = 200_000
PREFIX_DIGITS = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null url or one without `://`."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digests(rules: DataFrame) -> DataFrame:
    """One row per distinct host and path; a rule given both ways blocks."""
    whole = F.concat("host", "path")
    return (
        rules.where("host is not null and path is not null and verdict in ('allow', 'block')")
        .groupBy("host", "path")
        .agg(F.max((F.col("verdict") == "block").cast("long")).alias("blocks"))
        .select(
            F.sha2(whole, 256).alias("rule_digest"),
            # Longest rule first, then the longest host: for one url these two name one rule.
            (F.length(whole) * F.lit(1 << 32) + F.length("host") * 2 + F.col("blocks")).alias("rank"),
        )
        .withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )


def judge(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """Judges every row of `pages` (page_id, url) by the longest rule (host, path, verdict) that fits.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Returns page_id, host, path, rule (null if none fits) and verdict, one row
    for each row of pages, repeated rows included. A null url, or one without
    `://`, has an empty host and path. Rules with a null part are ignored; a rule
    listed as allow and as block blocks. No pages: no rows; no rules: `default`
    for all. Other columns of pages are not read, whatever their names.
    """
    # Only the suffix and prefix lengths that some rule has: few, whatever the number of rules.
    lengths = (
        rules.where("host is not null and path is not null")
        .select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars"))
        .distinct()
        .collect()
    )
    host, path = split_url(F.col("url"))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    wanted = [
        F.when(
            (_labels(F.col("host")) >= r.labels) & (F.length("path") >= r.chars),
            F.concat(F.substring_index("host", ".", -r.labels), F.substring("path", 1, r.chars)),
        )
        for r in lengths
    ]
    expressions = F.array_compact(F.array(*wanted)) if wanted else F.array().cast("array<string>")
    expanded = urls.select(
        "row", "page_id", "host", "path", F.explode_outer(expressions).alias("expression")
    ).withColumn("prefix", F.substring(F.sha2("expression", 256), 1, PREFIX_DIGITS))
    digests = _digests(rules)
    fits = (F.col("prefix") == F.col("rule_prefix")) & (F.sha2("expression", 256) == F.col("rule_digest"))
    if digests.count() <= BROADCAST_RULES:
        ranked = expanded.join(F.broadcast(digests), fits, "left")
    else:
        # Each expression meets the rules once, however many urls share it; skew handling splits hot ones.
        known = (
            expanded.where("expression is not null")
            .select("expression", "prefix")
            .distinct()
            .join(digests, fits)
            .select(F.col("expression").alias("known"), "rank")
        )
        ranked = expanded.join(known, F.col("expression") == F.col("known"), "left")
    # The expressions of a row lie in one task, so they fold to one row before the shuffle.
    best = ranked.groupBy("row", "page_id", "host", "path").agg(F.max("rank").alias("rank"))
    total = F.shiftright("rank", 32).cast("int")
    host_length = F.shiftright(F.col("rank").bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int")
    return best.select(
        "page_id",
        "host",
        "path",
        F.when(
            F.col("rank").isNotNull(),
            F.concat(F.right("host", host_length), F.substring("path", F.lit(1), total - host_length)),
        ).alias("rule"),
        F.when(F.col("rank").isNull(), F.lit(default))
        .when(F.col("rank").bitwiseAND(F.lit(1)) == 1, F.lit("block"))
        .otherwise(F.lit("allow"))
        .alias("verdict"),
    )
