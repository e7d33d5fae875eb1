"""The run as a micro-batch: arriving files trigger it, and all that is there is taken at once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from braidwork.plans.config import Options
from braidwork.plans.run import run


def run_available(spark: SparkSession, options: Options, log: str, clock: Callable[[], datetime], keys: DataFrame | None = None) -> StreamingQuery:
    """Run once over what has arrived since the last call, on either side. The stream only says that there is something
    new; what is read is the run's own lookback window, so late rows are seen and replays are dropped by content. The
    checkpoint's claim keeps two calls from opening a window each."""
    sources = [spark.readStream.schema(spark.read.parquet(x).schema).parquet(x).select("created_at") for x in (options.human_source, options.ai_source)]
    arrivals = sources[0].unionByName(sources[1])

    def batch(rows: DataFrame, number: int) -> None:
        if not rows.isEmpty():
            run(spark, options, clock(), keys)

    return arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", log).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Event counts per tumbling window and type; on a stream, state is dropped behind the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
