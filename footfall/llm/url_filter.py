"""URL rules by host and path: a blocked Bloom filter of the listed rules, then an exact join.

Nulls: a null url, or one without ``://``, has empty host and path and meets no rule. An
empty rule table meets nothing. Repeated pages give repeated rows; of equal rules with
different verdicts the alphabetically first verdict holds ("allow" before "block")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.bloom import blocks_for, bloom_filter, may_contain
from footfall.llm.common import LOWER, UPPER, packed, staged, unpacked

#: After the first ``://``: the host up to / ? # or the end, then the path up to ? # or the end.
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 2)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as (verdict, "host/path") pairs, for lists that are written down by hand."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def _canonical(rules: DataFrame) -> DataFrame:
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, char_length(substring_index(rule, '/', 1)) + 1)")
    listed = rules.where("rule is not null and verdict is not null").select(
        host.alias("rule_host"), path.alias("rule_path"), "verdict"
    )
    return (
        listed.groupBy("rule_host", "rule_path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to each row of ``pages``.

    ``rules`` has ``verdict`` and ``rule`` (host, then path from the first slash). A rule fits
    its host and all subdomains if the path starts with the rule's; the longest rule wins.
    Every host suffix and path prefix that a rule could equal is tried on the filter; what
    passes is joined with the rules exactly. Distinct (host, path) pairs are judged once."""
    listed = staged(_canonical(rules), "rules")
    sizes = listed.agg(
        F.count("*").alias("rules"),
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
    ).first()
    blocks = blocks_for(sizes["rules"])
    lengths = listed.agg(F.collect_set(F.char_length("rule_path")).alias("lengths")).scalar()
    words = bloom_filter(listed, "rule", blocks).scalar()

    columns = pages.columns
    rows = pages.select(packed(pages), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
    labels = F.split("host", r"\.")
    # No rule has more labels than this, so longer host suffixes cannot fit one.
    deepest = F.least(F.size(labels), F.lit(sizes["labels"] or 1))
    hosts = F.transform(F.sequence(F.lit(1), deepest), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    paths = F.transform(F.filter("lengths", lambda n: n <= F.char_length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    candidates = (
        rows.select("host", "path")
        .distinct()
        .select("host", "path", lengths.alias("lengths"))
        .select("host", "path", F.explode(F.array_distinct(keys)).alias("rule"))
        .where(may_contain(words, blocks, F.col("rule")))
    )
    longest = F.max_by(F.struct("rule", "verdict"), F.char_length("rule")).alias("found")
    # Written, so that both sides of the last join are plain scans: Spark can then split the
    # rows of a host and path that most pages share.
    found = staged(candidates.join(listed.select("rule", "verdict"), "rule").groupBy("host", "path").agg(longest), "found")
    judged = rows.join(found, ["host", "path"], "left")
    return unpacked(
        judged,
        columns,
        host=F.col("host"),
        path=F.col("path"),
        rule=F.col("found.rule"),
        verdict=F.coalesce("found.verdict", F.lit(default)),
    )
