"""URL filters: allow and block rules on hosts and path prefixes, with DataFrame functions only.

Every URL is expanded into (host suffix, path prefix) expressions, of the label counts and prefix lengths that the
rules have; expressions meet rules by the first 8 hex digits of their SHA-256, the full digest confirms, and of the
rules that fit the longest one (host and path together; at the same length block before allow) gives the verdict.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``,
``#`` or the end. Defined cases: a null URL or one without ``://`` has an empty host and path, which no rule fits;
where no rule fits, rule is null and the verdict is ``default``; repeated rows and null ids are judged one by one;
rules given twice count once; a very long URL has as many expressions as any, those of the rules' label counts and
prefix lengths; further columns are ignored; an empty table or rule list gives no match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The rules of the query, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict."""
    rules = rules.select("verdict", "host", "path").where(F.col("host").isNotNull() & F.col("path").isNotNull()).distinct()
    # one row: label counts and prefix lengths are bounded by what a URL can hold
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]) or [1], sorted(shape["lengths"]) or [0]
    own = pages.select(F.col(id_column).alias("__id"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    own = own.select("__id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("__row"))
    names = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(names) >= n, F.array_join(F.slice(names, -n, n), ".")) for n in labels])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    pairs = F.flatten(F.transform(F.filter(suffixes, F.isnotnull), lambda h: F.transform(F.filter(prefixes, F.isnotnull), lambda p: F.concat(h, p))))
    asked = own.withColumn("digest", F.explode_outer(F.transform(pairs, lambda x: F.sha2(x, 256)))).withColumn("short", F.substring("digest", 1, 8))
    rule = F.concat("host", "path")
    known = rules.select(rule.alias("rule"), F.col("verdict").alias("says"), F.sha2(rule, 256).alias("known")).withColumn("short", F.substring("known", 1, 8))
    met = asked.join(known, "short", "left")
    fits = F.when(F.col("digest") == F.col("known"), F.struct(F.length("rule").alias("n"), (F.col("says") == "block").alias("b"), F.col("rule"), F.col("says")))
    best = met.groupBy("__row", F.col("__id").alias(id_column), "host", "path").agg(F.max(fits).alias("best"))
    return best.select(id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.says", F.lit(default)).alias("verdict"))
