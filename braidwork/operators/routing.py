"""From source rows to keyed rows: which segments and which side, which part, which image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.functions import payload as P
from braidwork.functions.text import image_key
from braidwork.plans.config import Segment


def method_table(rows: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """method, side, segment: a few rows, as many as the configuration names."""
    pairs = [(m, side, s.name) for s in segments for m, side in ((s.ai_method, "ai"), (s.human_method, "human"))]
    return rows.sparkSession.createDataFrame(pairs, "method string, side string, segment string")


def routed(rows: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """One row per segment that lists the row's method; rows of unknown methods go, and their scan is spared."""
    methods = [m for s in segments for m in (s.ai_method, s.human_method)]
    table = method_table(rows, segments)
    return rows.where(F.col("method").isin(methods)).join(F.broadcast(table), "method")  # bounded by the configuration


def sub_type(keys, segment: Segment):
    """The first part whose discriminator is among the payload's keys and whose negative one is not; null for none."""
    if not segment.sub_types:
        return F.lit("default")
    out = F.lit(None).cast("string")
    for s in reversed(segment.sub_types):
        fits = F.array_contains(keys, s.discriminator)
        if s.negative:
            fits &= ~F.array_contains(keys, s.negative)
        out = F.when(fits, s.name).otherwise(out)
    return out


def keyed(rows: DataFrame, segments: Sequence[Segment], image_path: str, filter_path: str | None = None, filter_value: str | None = None) -> DataFrame:
    """Plain-text payload rows -> image_id, segment, side, sub_type, payload (unwrapped), case_id, key_id, created_at.

    Rows without an image or (on the human side) without a known part go. The payload filter is for the human side. An AI
    payload's ``content_signature`` comes along as content_key.
    """
    out = routed(rows, segments)
    if "case_id" not in out.columns:
        out = out.withColumn("case_id", F.lit(None).cast("string"))
    # unfolded, so that a filter on what was read does not read it again below
    read = F.inline(F.array(P.opened(F.col("payload"), F.col("side") == "human", image_path, filter_path))).alias("payload", "__image", "__filter", "__keys", "content_key")
    out = out.select(*[c for c in out.columns if c != "payload"], read)
    if filter_path:
        out = out.where((F.col("side") == "ai") | F.coalesce(F.col("__filter") == filter_value, F.lit(False)))
    out = out.withColumn("image_id", image_key(F.col("__image")))
    part = F.lit(None).cast("string")
    for s in segments:
        part = F.when(F.col("segment") == s.name, sub_type(F.col("__keys"), s)).otherwise(part)
    out = out.withColumn("sub_type", F.when(F.col("side") == "human", part))
    out = out.where(F.col("image_id").isNotNull() & ((F.col("side") == "ai") | F.col("sub_type").isNotNull()))
    return out.select("image_id", "segment", "side", "sub_type", "payload", "case_id", "key_id", "created_at", "content_key")
