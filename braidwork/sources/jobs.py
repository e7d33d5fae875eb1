"""Job history: Spark's own event logs as a table of jobs, with what they read, wrote and shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of the event log that are read; others are passed over by the scan.
EVENTS = (
    "Event string, `Job ID` long, `Submission Time` long, `Completion Time` long, `Stage IDs` array<long>, `Job Result` struct<Result: string>, `Stage ID` long, "
    "`Task Info` struct<`Launch Time`: long, `Finish Time`: long, Failed: boolean>, "
    "`Task Metrics` struct<`Executor CPU Time`: long, `Memory Bytes Spilled`: long, `Disk Bytes Spilled`: long, `Input Metrics`: struct<`Bytes Read`: long, `Records Read`: long>, "
    "`Output Metrics`: struct<`Bytes Written`: long>, `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>>"
)
#: How an application's id stands in the name of its log.
APPLICATION = r"(application_\d+_\d+|app-\d+-\d+|local-\d+)"


def job_history(spark: SparkSession, logs: str) -> DataFrame:
    """One row a job of the event logs in a folder: application, job_id, submitted, completed, seconds, state, stages,
    tasks, failed_tasks, slot_seconds, bytes_read, rows_read, bytes_written, shuffle_bytes, spilled_bytes.

    A stage counts for the first job that lists it, which is the one that ran it. A job without an end is RUNNING.
    """
    events = spark.read.schema(EVENTS).json(logs, recursiveFileLookup=True)
    own = F.coalesce(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), APPLICATION, 1), F.lit("")), F.col("_metadata.file_name")).alias("application")
    events = events.select(own, "*").where(F.col("Event").isin("SparkListenerJobStart", "SparkListenerJobEnd", "SparkListenerTaskEnd"))
    by_job = F.col("Event") == "SparkListenerJobStart"
    jobs = events.where(F.col("Job ID").isNotNull()).groupBy("application", F.col("Job ID").alias("job_id")).agg(
        F.max(F.when(by_job, F.col("Submission Time"))).alias("start"), F.max("Completion Time").alias("end"), F.max(F.when(by_job, F.col("Stage IDs"))).alias("stage_ids"), F.max("Job Result.Result").alias("result"),
    )
    ran = jobs.select("application", "job_id", F.explode("stage_ids").alias("stage_id")).groupBy("application", "stage_id").agg(F.min("job_id").alias("job_id"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    metric = lambda *path: F.col(".".join(["`Task Metrics`", *(f"`{p}`" for p in path)]))
    work = events.where("Event = 'SparkListenerTaskEnd'").groupBy("application", F.col("Stage ID").alias("stage_id")).agg(
        F.count(F.lit(1)).alias("tasks"), F.count_if("Task Info.Failed").alias("failed_tasks"), total(F.col("`Task Info`.`Finish Time`") - F.col("`Task Info`.`Launch Time`")).alias("slot_ms"),
        total(metric("Input Metrics", "Bytes Read")).alias("bytes_read"), total(metric("Input Metrics", "Records Read")).alias("rows_read"), total(metric("Output Metrics", "Bytes Written")).alias("bytes_written"),
        total(metric("Shuffle Write Metrics", "Shuffle Bytes Written")).alias("shuffle_bytes"), total(metric("Memory Bytes Spilled") + metric("Disk Bytes Spilled")).alias("spilled_bytes"),
    )
    sums = ["tasks", "failed_tasks", "slot_ms", "bytes_read", "rows_read", "bytes_written", "shuffle_bytes", "spilled_bytes"]
    per_job = work.join(ran, ["application", "stage_id"]).groupBy("application", "job_id").agg(F.count(F.lit(1)).alias("stages"), *[F.sum(c).alias(c) for c in sums])
    state = F.when(F.col("end").isNull(), "RUNNING").when(F.col("result") == "JobSucceeded", "SUCCEEDED").otherwise("FAILED")
    out = jobs.join(per_job, ["application", "job_id"], "left").na.fill(0, ["stages", *sums])
    return out.select(
        "application", "job_id", F.timestamp_millis("start").alias("submitted"), F.timestamp_millis("end").alias("completed"), ((F.col("end") - F.col("start")) / 1000).alias("seconds"), state.alias("state"), "stages", "tasks", "failed_tasks",
        (F.col("slot_ms") / 1000).alias("slot_seconds"), "bytes_read", "rows_read", "bytes_written", "shuffle_bytes", "spilled_bytes",
    )


def slowest(jobs: DataFrame, n: int = 20) -> DataFrame:
    """The jobs that took longest, with what each read a second of its slots: much read means too much scanned, long with
    few slot seconds means that it waited."""
    rate = F.when(F.col("slot_seconds") > 0, F.col("bytes_read") / F.col("slot_seconds"))
    return jobs.withColumn("bytes_a_slot_second", rate).orderBy(F.col("seconds").desc_nulls_last(), "application", "job_id").limit(n)
