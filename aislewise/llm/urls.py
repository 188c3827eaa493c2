"""Operator 5: allow and block rules for URLs, matched by hashed host-suffix and path-prefix expressions.

Each distinct URL is expanded into the expressions "host suffix + path prefix" that any rule could equal: suffixes at
label boundaries with as many labels as some rule has, and prefixes as long as some rule's path. An expression is
looked up by the first 4 bytes of its SHA-256 in an equi-join; the full digests are compared afterwards, and of the
rules that are left the longest wins. All of it is DataFrame functions.

The expansion is exact: a suffix or prefix of another length equals no rule. Candidates are rare, so only they are
grouped again; a URL that owns a third of the rows is one row after the first grouping, which sums up map-side. Spark
picks the join: a rule list under its broadcast threshold is broadcast, a longer one is joined by shuffle, where
adaptive execution splits prefixes that many URLs share.

Defined results: host and path of a null URL, or one without ``://``, are empty, and only the default applies. Rules
that tie in length: the longer host wins, then block over allow. Every row gives one row, repeated rows included, null
page ids included. Columns other than ``page_id`` and ``url`` are not read. Rules with a null host, path or verdict,
or an empty host, fit nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm.common import ascii_lower

PREFIX_BYTES = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z in lower case, and the path before any query or fragment."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def whole_numbers(values: list[int]) -> Column:
    return F.array(*map(F.lit, sorted(values))).cast("array<int>")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows as a DataFrame."""
    names = ("host", "path", "verdict")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules])
    return spark.sql("SELECT r.* FROM (SELECT explode(:rules) AS r)", args={"rules": listed})


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``rules`` has host, path and verdict."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    urls = urls.withColumn("host", host).withColumn("path", path)

    digest = F.sha2(F.concat("host", F.lit("\n"), "path"), 256)
    listed = rules.select("host", "path", "verdict").where(
        "host IS NOT NULL AND host <> '' AND path IS NOT NULL AND verdict IS NOT NULL"
    )
    # One row: which numbers of labels and which path lengths occur. Bounded by the longest host and path of a rule.
    shapes = listed.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()
    listed = listed.select(
        digest.alias("rule_digest"),
        F.substring(digest, 1, 2 * PREFIX_BYTES).alias("prefix"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        "verdict",
    )

    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(whole_numbers(shapes.labels), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(whole_numbers(shapes.lengths), lambda n: n <= F.length("path")),
        lambda n: F.substr("path", F.lit(1), n),
    )
    asked = F.sha2(F.concat("suffix", F.lit("\n"), "start"), 256)
    expressions = (
        urls.select("*", F.explode(suffixes).alias("suffix"))
        .select("*", F.explode(prefixes).alias("start"))
        .select("page_id", "url", asked.alias("digest"), F.substring(asked, 1, 2 * PREFIX_BYTES).alias("prefix"))
    )
    candidates = expressions.join(listed, "prefix").where("digest = rule_digest")
    precedence = F.struct(F.length("rule"), "host_length", F.col("verdict") == "block")
    won = candidates.groupBy("page_id", "url").agg(
        F.max_by(F.struct("rule", "verdict"), precedence).alias("won"),
    )
    same = F.expr("u.page_id <=> w.page_id AND u.url <=> w.url")
    return (
        urls.alias("u")
        .join(won.alias("w"), same, "left")
        .select(
            "u.page_id",
            "host",
            "path",
            F.col("won.rule").alias("rule"),
            F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
            F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
        .drop("copy")
    )
