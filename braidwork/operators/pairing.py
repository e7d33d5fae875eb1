"""Pairing a group's human contribution with its latest AI payload, with state carried from run to run.

A group is (image_id, segment). Inputs hold plain-text payloads: ``fresh`` as ``routing.keyed`` gives them, ``pending``
and ``pool`` as the state tables. All time logic uses the run's ``as_of``. Every "first" or "last" has a total order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.functions import payload as P
from braidwork.functions.text import joined_set, set_of
from braidwork.functions.times import as_timestamp, iso, whole_days
from braidwork.plans.config import POLICIES, Segment

GROUP = ["image_id", "segment"]
STEP_SECONDS = 1


def pool_reconciled(pool: DataFrame) -> DataFrame:
    """One row per content of a group: the first times, the last retry, the most retries."""
    keyed = pool.withColumn("content_key", P.content_signature(F.col("payload")))
    return keyed.groupBy(*GROUP, "content_key").agg(
        F.min("created_at").alias("created_at"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_retried_at").alias("last_retried_at"),
        F.max("retry_count").alias("retry_count"), F.min_by(F.struct("payload", "key_id"), F.struct("created_at", "payload")).alias("one"),
    ).select(*GROUP, "content_key", "one.payload", "one.key_id", "created_at", "first_seen_at", "last_retried_at", "retry_count")


def _stepped(known_at: Column, n: Column, start: Column) -> Column:
    step = F.when(known_at.isNull(), n - 1).otherwise(n) * STEP_SECONDS
    return F.timestamp_add("SECOND", step, F.coalesce(known_at, start))


def stepped_times(new: DataFrame, pooled: DataFrame, as_of: Column, keys: Sequence[str] = GROUP) -> DataFrame:
    """``new`` with created_at replaced so that discovery order is time order.

    Behind the group's latest known time M the i-th row gets M + i seconds; without one the first row keeps its own
    time (or the run's) and the i-th gets that plus i - 1 seconds.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("created_at").asc_nulls_first(), F.col("payload"))
    latest = pooled.groupBy(*keys).agg(F.max("created_at").alias("known_at"))
    own = new.withColumn("n", F.row_number().over(order)).withColumn("start", F.coalesce(F.first("created_at").over(order), as_of))
    at = _stepped(F.col("known_at"), F.col("n"), F.col("start"))
    return own.join(latest, list(keys), "left").withColumn("created_at", at).drop("n", "start", "known_at")


def ai_state(fresh: DataFrame, pool: DataFrame, as_of: Column) -> DataFrame:
    """All AI payloads of the groups after this run; replays of known content bring nothing new."""
    columns = [*GROUP, "payload", "key_id", "created_at"]
    signed = lambda df: df if "content_key" in df.columns else df.withColumn("content_key", P.content_signature(F.col("payload")))
    old, new = (signed(df).select(*columns, "content_key", *more) for df, more in ((pool, ["first_seen_at", "retry_count", F.lit(True).alias("known")]), (fresh.where("side = 'ai'"), [F.lit(False).alias("known")])))
    # one shuffle, by group: what follows stays within
    rows = old.unionByName(new, allowMissingColumns=True).repartition(*GROUP)
    old = lambda c: F.when(F.col("known"), F.col(c))
    one = F.min_by(F.struct("payload", "key_id", "created_at"), F.struct(~F.col("known"), F.col("created_at"), F.col("payload"), F.col("key_id"))).alias("one")
    rows = rows.groupBy(*GROUP, "content_key").agg(
        one, F.max("known").alias("known"), F.min(old("created_at")).alias("old_at"), F.min(old("first_seen_at")).alias("first_seen_at"), F.max(old("retry_count")).alias("retry_count")
    ).select(*GROUP, "content_key", "one.payload", "one.key_id", F.when(F.col("known"), F.col("old_at")).otherwise(F.col("one.created_at")).alias("created_at"), "known", "first_seen_at", "retry_count")
    order = Window.partitionBy(*GROUP, "known").orderBy(F.col("created_at").asc_nulls_first(), F.col("payload"))
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("start", F.coalesce(F.first("created_at").over(order), as_of))
    rows = rows.withColumn("known_at", F.max(old("created_at")).over(Window.partitionBy(*GROUP)))
    at = F.when(F.col("known"), F.col("created_at")).otherwise(_stepped(F.col("known_at"), F.col("n"), F.col("start")))
    retries = F.when(F.col("known"), F.coalesce("retry_count", F.lit(0)) + 1).otherwise(0).cast("long")
    rows = rows.select(*GROUP, "content_key", "payload", "key_id", at.alias("created_at"), F.coalesce("first_seen_at", as_of).alias("first_seen_at"), as_of.alias("last_retried_at"), retries.alias("retry_count"))
    return _with_latest(rows)


def _with_latest(rows: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.col("created_at").desc_nulls_last(), F.col("content_key").desc_nulls_last()))
    return rows.withColumn("is_latest", place == 1)


def latest_ai(rows: DataFrame) -> DataFrame:
    """The AI payload of each group that counts; rows of ``ai_state`` say which one it is."""
    rows = rows if "is_latest" in rows.columns else _with_latest(rows)
    return rows.where("is_latest").select(*GROUP, F.struct("payload", "key_id", "created_at", "content_key").alias("ai"))


def pending_reconciled(pending: DataFrame) -> DataFrame:
    """State of a group over its pending rows; signature and version come together, from the highest version."""
    per_group = pending.groupBy(*GROUP).agg(
        F.min("first_seen_at").alias("first_seen_at"), F.max("retry_count").alias("retry_count"),
        F.max_by(F.struct("last_compared_signature", "comparison_version"), F.struct("comparison_version", F.coalesce("last_compared_signature", F.lit("")))).alias("compared"),
        F.flatten(F.collect_list(set_of(F.col("merged_case_ids")))).alias("cases"),
        F.max_by("case_id", F.struct("created_at", "case_id")).alias("old_case"), F.max("created_at").alias("old_at"),
    )
    return per_group.select(*GROUP, "first_seen_at", "retry_count", F.col("compared.last_compared_signature").alias("signature"), F.coalesce("compared.comparison_version", F.lit(0)).cast("long").alias("version"), "cases", "old_case", "old_at")


def human_state(fresh: DataFrame, pending: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """One row per group with a human payload: the payload merged over cases, or (parts) those still waiting.

    Contributions of one part are folded in the order of time and case, a persisted payload first, so that it can't
    lose to a replay of its own content. The group's case is that of the latest contribution.
    """
    by_name = {s.name: s for s in segments}
    policies = {s.name: POLICIES.get(s.name, s.policy) for s in segments}
    columns = [*GROUP, "sub_type", "payload", "case_id", "key_id", "created_at"]
    part = F.when(F.col("pending_type") == "human", "default").otherwise(F.expr("substring(pending_type, length('human:') + 1)"))
    old = pending.select(*GROUP, part.alias("sub_type"), "payload", "case_id", "key_id", "created_at", F.lit(True).alias("is_old"))
    rows = old.unionByName(fresh.where("side = 'human'").select(*columns, F.lit(False).alias("is_old"))).withColumn("case_key", F.coalesce("case_id", F.lit("")))
    # one shuffle, by group, for the latest payload of a case's part, for what is said of the whole group and for the fold
    all_rows, rows = rows, rows.repartition(*GROUP)
    rank = F.row_number().over(Window.partitionBy(*GROUP, "is_old", "case_key", "sub_type").orderBy(F.col("created_at").desc_nulls_last(), F.col("payload").asc()))
    group = Window.partitionBy(*GROUP)
    rows = rows.withColumn("rank", rank).where("is_old or rank = 1").drop("rank")
    rows = rows.withColumn("own_cases", F.array_sort(F.array_remove(F.collect_set("case_key").over(group), "")))
    rows = rows.withColumn("group_case", F.max_by("case_id", F.when(F.col("case_id").isNotNull(), F.struct("created_at", (~F.col("is_old")).alias("new"), "case_id"))).over(group))
    versions = rows.withColumn("late", ~F.col("is_old")).withColumn("at", iso(F.col("created_at"))).withColumn("noted_case", F.when(~F.col("is_old"), F.col("case_id")))
    # of a case's new rows one is left, so their order is the same with and without the notes that the fold gives them
    parts = P.folded(
        versions, [*GROUP, "sub_type"], ["late", "created_at", "case_key", "payload", "key_id"], policies, ["key_id", "own_cases", "group_case"],
        case="noted_case", signed=True, at_most=all_rows.select(*GROUP, "sub_type"), together=True,
    )
    parts = parts.withColumn("created_at", as_timestamp(F.col("at"))).drop("at")
    part = F.struct(F.col("sub_type").alias("name"), "payload", "created_at", "key_id", "content")
    if not any(s.sub_types for s in segments) and pending.where("pending_type <> 'human'").isEmpty():  # a group is one part
        whole = parts.select(*GROUP, F.array(part).alias("parts"), F.col("created_at").alias("earliest"), F.col("created_at").alias("latest"), "own_cases", F.col("group_case").alias("case_id"))
    else:
        whole = parts.groupBy(*GROUP).agg(
            F.array_sort(F.collect_list(part)).alias("parts"), F.min("created_at").alias("earliest"), F.max("created_at").alias("latest"),
            F.first("own_cases").alias("own_cases"), F.first("group_case").alias("case_id"),  # the same in all parts
        )
    required = F.lit(None)
    for s in segments:
        required = F.when(F.col("segment") == s.name, F.array(*[F.lit(x) for x in s.required])).otherwise(required)
    merged_part = F.filter("parts", lambda p: p["name"] == "merged")
    complete = (F.size(merged_part) > 0) | (F.size(F.array_except(required, F.transform("parts", lambda p: p["name"]))) == 0)
    single = F.when(F.size(merged_part) > 0, F.get(merged_part, F.lit(0))).when(F.size(required) == 1, F.get("parts", F.lit(0)))
    whole = whole.withColumn("complete", complete).withColumn("single", single)
    # a function of Python is called for every row, so groups that need no joining pass it a null
    several = F.when(F.col("single").isNull() & F.col("complete"), F.transform("parts", lambda p: F.struct(p["name"].alias("name"), p["payload"].alias("payload"))))
    joins = any(len(s.required) > 1 for s in segments)
    joined = P.parts_joined(several, F.col("segment"), by_name) if joins else F.lit(None).cast("string")
    whole = whole.withColumn("joined", joined)
    own = F.col("single").isNotNull()
    out = whole.withColumn("payload", F.when(own, F.col("single.payload")).when(F.col("complete"), F.col("joined")))
    content = F.when(own, F.coalesce("single.content", F.btrim("single.payload")))
    out = out.withColumn("content_key", F.coalesce(content, P.content_signature(F.col("joined"))) if joins else content)
    many = F.size(required) > 1
    return out.select(
        *GROUP, "complete", F.when(~F.coalesce("complete", F.lit(False)), F.col("parts")).alias("parts"), "payload", F.coalesce("single.created_at", "earliest").alias("created_at"), F.coalesce("single.key_id", F.get("parts", F.lit(0))["key_id"]).alias("key_id"),
        F.when(many, "human:merged").otherwise("human").alias("pending_type"), "case_id", "own_cases", "content_key",
    )


@dataclass
class Routes:
    """What a run decides; every frame holds plain-text payloads."""

    matched: DataFrame
    case_pending: DataFrame
    case_aged: DataFrame
    ai_pending: DataFrame
    ai_aged: DataFrame


def pair(fresh: DataFrame, pending: DataFrame, pool: DataFrame, segments: Sequence[Segment], as_of: datetime, age_limit_days: int = 7, keep=lambda df, name: df) -> Routes:
    """Decide for every group. ``keep(df, name)`` may store a frame that several results read."""
    now = F.lit(as_of).cast("timestamp")
    ai = keep(ai_state(fresh, pool, now), "ai")
    human = human_state(fresh, pending, segments)
    state = human.join(pending_reconciled(pending), GROUP, "left").join(latest_ai(ai), GROUP, "left")
    current = F.when(F.col("complete") & F.col("ai").isNotNull(), F.concat_ws("|", "content_key", "ai.content_key"))
    fired = F.col("current").isNotNull() & ~F.col("current").eqNullSafe(F.col("signature"))
    state = state.withColumn("current", current).withColumn("fired", fired)
    state = state.withColumn("comparison_version", (F.coalesce("version", F.lit(0)) + F.col("fired").cast("int")).cast("long"))
    state = state.withColumn("since", F.coalesce("first_seen_at", now)).withColumn("retries", F.when(F.col("first_seen_at").isNull(), 0).otherwise(F.coalesce("retry_count", F.lit(0)) + 1).cast("long"))
    cases = joined_set(F.array_union(F.coalesce("cases", F.array().cast("array<string>")), "own_cases"))
    state = keep(state.withColumn("merged_case_ids", cases).withColumn("signature", F.coalesce("current", "signature")).drop("content_key"), "state")
    # an incomplete group keeps one row per part, a complete one a single row
    waiting = F.when(F.col("complete"), F.array(F.struct(F.col("pending_type").alias("t"), F.col("payload"), F.col("created_at"), F.col("key_id")))).otherwise(
        F.transform("parts", lambda p: F.struct(F.when(p["name"] == "default", "human").otherwise(F.concat(F.lit("human:"), p["name"])).alias("t"), p["payload"].alias("payload"), p["created_at"].alias("created_at"), p["key_id"].alias("key_id")))
    )
    rows = state.withColumn("row", F.explode(waiting)).select(
        *GROUP, "row.key_id", "case_id", F.col("row.t").alias("pending_type"), "row.payload", "row.created_at", F.col("since").alias("first_seen_at"), now.alias("last_retried_at"),
        F.col("retries").alias("retry_count"), F.lit(None).cast("string").alias("matched_ai_keys"), F.lit(0).cast("long").alias("next_ai_iteration"), "merged_case_ids",
        F.col("signature").alias("last_compared_signature"), "comparison_version", "fired",
    )
    old = (whole_days(F.col("first_seen_at"), now) >= age_limit_days) & ~F.coalesce("fired", F.lit(False))
    ai_old = whole_days(F.col("first_seen_at"), now) >= age_limit_days
    matched = state.where("fired").select(*GROUP, "key_id", "payload", "created_at", "case_id", "comparison_version", F.col("ai.payload").alias("ai_payload"), F.col("ai.created_at").alias("ai_created_at"))
    return Routes(matched, rows.where(~old).drop("fired"), rows.where(old).drop("fired"), ai.where(~ai_old).drop("content_key", "is_latest"), ai.where(ai_old).drop("content_key", "is_latest"))
