"""URL filter by expressions and short hash prefixes (operator 9), in DataFrame functions only.

A URL's host gives its suffixes by label, its path the prefixes of the lengths
that rules have; every (suffix, prefix) pair is one expression. Expressions meet
rules in an equi-join on the first four bytes of SHA-256, and the full digest
confirms. The rule with the longest expression wins.

Only distinct (host, start of path) keys are expanded, so a host that holds a
third of all pages costs one expansion; the keys that a rule fits are stored
and then meet the pages in a join whose skewed side adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8  # four bytes

# The rules of the query, as (kind, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    # A host has no "/" and a path starts with one, so the plain join of both is unambiguous.
    return F.sha2(F.concat(host, path), 256)


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict (columns of these names are replaced).

    `rules` has kind, host, path; a path starts with "/". A null URL or one
    without `://` has an empty host and path, which no rule fits; such a page
    and every page without a rule gets the `default` verdict. Of two rules
    with the same host and path "block" wins; among rules of the same length
    the longer host wins. Repeated pages each keep their row.
    """
    own = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("kind").isNotNull())
    own = own.groupBy("host", "path").agg(F.max("kind").alias("kind"))  # block > allow
    own = own.select(
        "kind", F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        F.size(F.split("host", r"\.")).alias("labels"), digest(F.col("host"), F.col("path")).alias("rule_digest"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    # What rules have bounds the expansion: their path lengths and their most host labels.
    bound = own.agg(F.collect_set("path_length").alias("lengths"), F.max("labels").alias("labels")).first()
    lengths, most = sorted(bound.lengths), bound.labels or 0

    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    found = pages.select(
        *[F.col(f"`{c}`") for c in rest], host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    if not lengths:
        return found.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    found = found.withColumn("__start", F.substring("path", 1, lengths[-1]))
    keys = found.where("host <> '' AND __start <> ''").select("host", "__start").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda n: F.array_join(F.slice(labels, -n, n), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("__start"))
    expressions = (
        keys.withColumn("suffix", F.explode(suffixes))
        .withColumn("cut", F.explode(fitting))
        .select("host", "__start", digest(F.col("suffix"), F.col("__start").substr(F.lit(1), F.col("cut"))).alias("own_digest"))
        .withColumn("prefix", F.substring("own_digest", 1, PREFIX_HEX))
    )
    best = (
        expressions.join(own, "prefix")
        .where("own_digest = rule_digest")
        .groupBy("host", "__start")
        .agg(F.max(F.struct(F.col("host_length") + F.col("path_length"), "host_length", "rule", "kind")).alias("won"))
    )
    # A table of its own: a small one is broadcast, and of a large one's join adaptive execution can split a hot host.
    best = stored(best, "best_rules")
    return found.join(best, ["host", "__start"], "left").select(
        *[F.col(f"`{c}`") for c in rest], "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.kind", F.lit(default)).alias("verdict"),
    )


def rules_frame(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "kind string, host string, path string")
