"""URL rules: host-suffix and path-prefix expressions, found by short hash prefixes and confirmed by full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the digest that are the join key (4 bytes).
PREFIX = 8
#: A rule is held so many times, and an expression asks one of these copies, so that a prefix that a third of all
#: URLs share (a whole top-level domain) is dealt over as many tasks where the join is not broadcast.
SALTS = 16


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end. A later `://` does not count, also where no path follows the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://[^/?#]*+(/[^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no '/', and a path is empty or starts with it, so the parts can't be confused.
    return F.sha2(F.concat(host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", otherwise: str = "allow") -> DataFrame:
    """The `keep` columns of every page with `host`, `path`, `rule` and `verdict`.

    rules: host, path, verdict. A rule fits its host and all subdomains, if the URL's path starts with the rule's. The
    longest rule that fits wins, between equally long ones the lower text, between rules of one text `block`.
    A URL is expanded only into expressions that a rule could have: suffixes of as many labels as some rule's host,
    prefixes as long as some rule's path. So a URL of a million labels or slashes has no more expressions than others.

    Null URLs and those without `://` have empty host and path and no rule; rules with null parts are left out; no
    rules: every verdict is `otherwise`; repeated pages are judged one by one; an empty table gives an empty table;
    columns of pages called like results do not clash unless kept.
    """
    rules = rules.select("host", "path", "verdict").dropna().distinct()
    shapes = rules.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    names = [f"k{i}" for i in range(len(keep))]
    rows = pages.select(
        *[F.col(k).alias(n) for n, k in zip(names, keep, strict=True)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("row"))
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in sorted(shapes["labels"])])) if shapes["labels"] else F.array()
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shapes["lengths"])]) if shapes["lengths"] else F.array()
    no_text = F.array().cast("array<string>")
    expanded = (
        rows.withColumn("suffix", F.explode_outer(F.when(F.col("host") != "", suffixes).otherwise(no_text)))
        .withColumn("prefix", F.explode_outer(F.filter(prefixes.cast("array<string>"), lambda p: p.isNotNull())))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("digest", 1, PREFIX)).withColumn("salt", (F.col("row") % SALTS).cast("int"))
    )
    known = rules.select(
        _digest(F.col("host"), F.col("path")).alias("rule_digest"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("rule_salt"))
    known = known.withColumn("rule_short", F.substring("rule_digest", 1, PREFIX))
    fits = expanded.join(known, (F.col("short") == F.col("rule_short")) & (F.col("salt") == F.col("rule_salt")), "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.struct(
        (-F.length("rule")).alias("shorter"), F.col("rule").alias("rule"), (F.col("rule_verdict") != "block").alias("mild"), F.col("rule_verdict").alias("verdict")))
    best = fits.groupBy("row").agg(
        *[F.first(n).alias(n) for n in names], F.first("host").alias("host"), F.first("path").alias("path"), F.min(confirmed).alias("best"))
    return best.select(
        *[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_report(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules, ["page_id"])
