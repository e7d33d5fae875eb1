"""Views over comparison results and state: the clean view, the latest comparison, monitoring figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.functions.text import under
from braidwork.functions.times import age_bucket, whole_days

#: The soft arrays of the historical clean view.
CLEAN_SOFT_PATHS = ("tradelines.tradelineRequest.disputeCodes", "credit.dob.disputeCodes", "credit.ssn.disputeCodes", "nonReported.disputeCodes")
_SCOPE = ["image_id", "segment", "ai_created_at", "segment_type", "scope_level", "scope_key"]


def with_scope(results: DataFrame, soft_paths: Sequence[str] = CLEAN_SOFT_PATHS) -> DataFrame:
    """The entity a row belongs to: a soft array's parent, an array item, or the segment type alone."""
    soft: Column = F.lit(False)
    for path in soft_paths:
        soft = soft | under(F.col("field_name"), path)
    keyed = F.col("array_key").isNotNull()
    level = F.when(keyed & soft, "soft_array_parent").when(keyed, "array_entity").otherwise("segment_type")
    key = F.when(keyed & soft, F.regexp_replace("array_key", "-[^-]+-[^-]+$", "")).when(keyed, F.col("array_key")).otherwise("__SEGMENT_TYPE_ONLY__")
    return results.withColumn("scope_level", level).withColumn("scope_key", key)


def clean_view(results: DataFrame, soft_paths: Sequence[str] = CLEAN_SOFT_PATHS) -> DataFrame:
    """Results without AI-only mismatches in a scope that another case covers and their own case doesn't.

    One aggregate per scope says which cases cover it, so a single left join takes the place of EXISTS and NOT EXISTS.
    """
    rows = with_scope(results, soft_paths)
    case = F.coalesce("case_id", F.lit(""))
    covered = rows.where("human_value is not null and segment_type is not null").groupBy(*_SCOPE).agg(F.collect_set(case).alias("covered_by"))
    noise = (~F.col("is_match")) & F.col("human_value").isNull() & F.col("ai_value").isNotNull() & F.col("segment_type").isNotNull()
    hidden = noise & F.col("covered_by").isNotNull() & ~F.array_contains("covered_by", case)
    return rows.join(covered, _SCOPE, "left").where(~F.coalesce(hidden, F.lit(False))).select(*results.columns)


def latest_view(results: DataFrame) -> DataFrame:
    """The rows of each image and segment's latest comparison."""
    newest = F.max("ai_iteration").over(Window.partitionBy("image_id", "segment"))
    return results.withColumn("__newest", newest).where(F.col("ai_iteration") == F.col("__newest")).drop("__newest")


def match_rate(results: DataFrame) -> DataFrame:
    matched, total = F.count_if("is_match"), F.count(F.lit(1))
    return results.groupBy("field_name").agg(
        matched.alias("matched"), F.count_if(~F.col("is_match")).alias("mismatched"), F.round(matched.cast("decimal(20,4)") * 100 / total, 2).cast("decimal(8,2)").alias("match_pct")
    )


def pending_ages(pending: DataFrame, as_of: Column) -> DataFrame:
    days = whole_days(F.col("first_seen_at"), as_of)
    return pending.groupBy("pending_type", age_bucket(days).alias("age_bucket")).agg(F.count(F.lit(1)).alias("cnt"))


def case_counts(results: DataFrame) -> DataFrame:
    """Quality figures by case: compared, mismatched, fields without a case."""
    return results.groupBy("image_id", "segment", "case_id").agg(F.count(F.lit(1)).alias("fields"), F.count_if(~F.col("is_match")).alias("mismatched"))


def worst_fields(results: DataFrame) -> DataFrame:
    """Match rates, the fields with the most mismatches first."""
    return match_rate(results).orderBy(F.desc("mismatched"), "field_name")


def create_views(spark, results: DataFrame, pending: DataFrame) -> None:
    """The views over stored tables: comparison_results_clean, comparison_results_latest and pending_by_age, for the
    session; a catalogue keeps them if the frames read its tables by name."""
    clean_view(results).createOrReplaceTempView("comparison_results_clean")
    latest_view(results).createOrReplaceTempView("comparison_results_latest")
    pending_ages(pending, F.current_timestamp()).createOrReplaceTempView("pending_by_age")
