"""One reconciliation run: scan, route, pair, compare, write, advance the checkpoint.

Order of writes: results and dead letters under the run's name, then the new versions of the state, then the commit,
which names all of them and advances the window in one step. The lease is renewed before each write, so a run that was
overtaken stops there. Whatever fails before the commit is repeated by the next run over the same window, and what it
wrote is never seen.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions import crypto
from braidwork.functions import payload as P
from braidwork.operators import attribution, compare, pairing, routing
from braidwork.plans import schemas
from braidwork.plans.config import Options, Segment
from braidwork.sources import scans, state


#: Pairs whose fields a task sorts at once.
PAIRS_A_TASK = 20_000


_RESULT = ["image_id", "segment", "key_id", "case_id", "ai_iteration", "ai_created_at", "human_created_at", "field_name", "array_key", "segment_type", "human_value", "ai_value", "is_match"]


def results_of(matched: DataFrame, segments: tuple[Segment, ...], array_keys: dict[str, str], soft_arrays: dict[str, str], load_time: datetime, keep=lambda df, name: df) -> DataFrame:
    """Field rows of matched pairs (plain text). ``keep(df, name)`` may store their flattened fields, which are read by both
    ways of comparing: pairs without keyed, repeated or renamed fields are compared within their row, the others by pair."""
    labels = {root: label for s in segments for root, label in s.segment_types}
    rows = matched.select("*", F.inline(F.array(P.both_flattened(F.col("payload"), F.col("ai_payload"), array_keys))).alias("notes", "human_fields", "ai_fields")).drop("payload", "ai_payload")
    renamed = [s.name for s in segments if s.field_mappings]
    plain = compare.is_plain(F.col("human_fields")) & compare.is_plain(F.col("ai_fields"))
    rows = rows.withColumn("plain", plain & ~F.col("segment").isin(renamed) if renamed else plain)
    notes = F.array_sort(F.filter("notes", lambda x: x["path"].isNotNull() & x["case_id"].isNotNull()))
    rows = rows.withColumn("notes", F.when(F.col("plain"), notes).otherwise(F.col("notes"))).withColumn("lined", F.when(F.col("plain"), compare.lined_up(F.col("human_fields"), F.col("ai_fields"))))
    for side in ("human_fields", "ai_fields"):
        rows = rows.withColumn(side, F.when(~F.col("plain"), F.col(side)))
    rows = keep(rows.withColumnsRenamed({"comparison_version": "ai_iteration", "created_at": "human_created_at"}).withColumn("ai_iteration", F.col("ai_iteration").cast("int")), "fields")
    found = compare.plain_fields(rows.where("plain").drop("human_fields", "ai_fields"), "lined", labels)
    found = found.withColumn("case_id", F.coalesce("human_case", attribution.nearest_of(F.col("notes"), F.col("field_name")), "case_id")).select(*_RESULT)
    others = rows.where("not plain")
    if not others.isEmpty():
        found = found.unionByName(_by_pair(others, segments, soft_arrays, labels).select(*_RESULT))
    return found.withColumn("load_time", F.lit(load_time).cast("timestamp"))


def _by_pair(rows: DataFrame, segments: tuple[Segment, ...], soft_arrays: dict[str, str], labels: dict[str, str]) -> DataFrame:
    parts = compare.parts_for(rows, PAIRS_A_TASK)
    rows = rows.withColumn("pair", F.struct("image_id", "segment"))
    notes = rows.select("pair", F.inline("notes"))
    fields = compare.both_sides(rows, "human_fields", "ai_fields", parts)
    for s in segments:
        fields = compare.with_mappings(fields, s.field_mappings, (F.col("side") == "ai") & (F.col("pair.segment") == s.name))
    fields = compare.with_soft_keys(fields, soft_arrays, parts)
    found = compare.matched_fields(fields, labels)
    canonical = rows.select("pair", F.col("case_id").alias("canonical_case_id"))
    found = attribution.with_case(found, notes, canonical, parts)
    return found.join(rows.select("pair", "image_id", "segment", "key_id", "ai_iteration", "ai_created_at", "human_created_at"), "pair")


@dataclass
class Summary:
    run: str
    window: state.Window
    version: str


def run(spark: SparkSession, options: Options, as_of: datetime, keys: DataFrame | None = None, run_id: str | None = None, lease_seconds: float = 9000.0) -> Summary:
    """``keys`` (key_id, dek) decrypts and encrypts payloads and values; without it the tables hold plain text.

    Only one run at a time has the window: ``state.Held`` while another one's lease lasts.
    """
    checkpoint = state.Checkpoint(spark, options.checkpoint, lease_seconds)
    window = checkpoint.claim(as_of)
    held = [window]
    try:
        return _run(spark, options, checkpoint, held, keys, run_id)
    except state.Fenced:
        raise
    except BaseException:
        checkpoint.release(held[-1])
        raise


def _run(spark: SparkSession, options: Options, checkpoint: state.Checkpoint, held: list[state.Window], keys: DataFrame | None, run_id: str | None) -> Summary:
    """``held`` ends with the lease as last renewed."""
    window = held[-1]
    # the claim's number makes the name that of this attempt alone
    run_id = f"{run_id}-{window.step:06d}" if run_id else f"{window.step:06d}-{window.current_stop:%Y%m%dT%H%M%S}"
    opened = (lambda df: crypto.decrypted(df, keys)) if keys is not None else lambda df: df
    closed = (lambda df, *cs: crypto.encrypted(df, keys, *cs)) if keys is not None else lambda df, *cs: df
    methods = [m for s in options.segments for m in (s.ai_method, s.human_method)]
    ai = scans.lookback(spark.read.parquet(options.ai_source), window.current_stop, f"{options.ai_lookback_hours} HOURS", methods=methods)
    human = scans.lookback(spark.read.parquet(options.human_source), window.current_stop, f"{options.human_lookback_days} DAYS", methods=methods)
    fresh = opened(ai.unionByName(human, allowMissingColumns=True))
    pending = opened(state.read_version(spark, f"{options.state}/pending", window.version, schemas.PENDING))
    pool = opened(state.read_version(spark, f"{options.state}/pool", window.version, schemas.AI_PENDING))
    work = f"{options.state}/work/{run_id}-{uuid.uuid4().hex[:8]}"

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    fresh = routing.keyed(fresh, options.segments, options.image_path, options.filter_path, options.filter_value)
    held.append(checkpoint.renew(held[-1]))
    routes = pairing.pair(keep(fresh, "fresh"), pending, pool, options.segments, window.current_stop, options.age_limit_days, keep)
    results = results_of(routes.matched, options.segments, options.array_keys, options.soft_arrays, window.current_stop, keep)
    results = keep(results, "results")  # the clustered write reads its rows twice, once for the borders of its ranges
    outputs = {}
    held.append(checkpoint.renew(held[-1]))
    outputs["results"] = state.append_run(schemas.fitted(closed(results, "human_value", "ai_value"), schemas.RESULTS), options.results, run_id, "load_time", ["image_id", "field_name"])
    stop = F.lit(window.current_stop).cast("timestamp")
    dead = closed(routes.case_aged, "payload").withColumn("reason", F.lit(f"No matching AI iteration within {options.age_limit_days} days"))
    dead_ai = closed(routes.ai_aged, "payload").withColumn("pending_type", F.lit("ai")).withColumn("reason", F.lit(f"No matching human payload within {options.age_limit_days} days"))
    dead = dead.unionByName(dead_ai, allowMissingColumns=True).withColumn("aged_out_at", stop)
    held.append(checkpoint.renew(held[-1]))
    outputs["dead_letters"] = state.append_run(schemas.fitted(dead, schemas.DEAD_LETTERS), options.dead_letters, run_id, "aged_out_at")
    held.append(checkpoint.renew(held[-1]))
    state.write_version(schemas.fitted(closed(routes.case_pending, "payload"), schemas.PENDING), f"{options.state}/pending", run_id)
    state.write_version(schemas.fitted(closed(routes.ai_pending, "payload"), schemas.AI_PENDING), f"{options.state}/pool", run_id)
    checkpoint.advance(held[-1], run_id, outputs)
    state.remove(spark, work)
    return Summary(run_id, window, run_id)


def results(spark: SparkSession, options: Options, at_step: int | None = None) -> DataFrame:
    """Committed results, as of a commit of the checkpoint."""
    return state.committed(state.Checkpoint(spark, options.checkpoint), "results", options.results, schemas.RESULTS, at_step)


def dead_letters(spark: SparkSession, options: Options, at_step: int | None = None) -> DataFrame:
    return state.committed(state.Checkpoint(spark, options.checkpoint), "dead_letters", options.dead_letters, schemas.DEAD_LETTERS, at_step)
