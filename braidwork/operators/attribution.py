"""Which case a compared field belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.functions.text import joined_set


def nearest_note(fields: DataFrame, notes: DataFrame) -> DataFrame:
    """``fields`` (pair, field_name, …) plus ``noted``: the case noted for the longest ancestor path.

    A path is expanded into its ancestors and meets the notes by equality, instead of comparing all prefixes.
    """
    paths = fields.select("pair", "field_name").distinct()
    parts = F.split("field_name", r"\.")
    depth = F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")
    steps = paths.select("pair", "field_name", depth).withColumn("path", F.array_join(F.slice(F.split("field_name", r"\."), 1, F.col("depth")), "."))
    found = steps.join(notes, ["pair", "path"]).groupBy("pair", "field_name").agg(F.max_by("case_id", "depth").alias("noted"))
    return fields.join(found, ["pair", "field_name"], "left")


def _note_of(notes: Column, path: Column) -> Column:
    """The case noted for a path, in an array of struct(path, case_id) by path: log2(size) steps, the largest first."""
    steps = F.transform(F.sequence(F.ceil(F.log2(F.size(notes) + F.lit(1))).cast("int"), F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    at = F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= F.size(notes)) & (F.get(notes, n + step - 1)["path"] <= path), n + step).otherwise(n))
    found = F.get(notes, at - 1)
    return F.when(found["path"] == path, found["case_id"])


def nearest_of(notes: Column, path: Column) -> Column:
    """The case noted for the longest ancestor of a path, itself first, in an array of struct(path, case_id) by path."""
    parts = F.split(path, r"\.")
    above = F.transform(F.sequence(F.size(parts) - 1, F.lit(1), F.lit(-1)), lambda n: _note_of(notes, F.array_join(F.slice(parts, F.lit(1), n), ".")))
    return F.when((F.size(notes) > 0) & path.isNotNull(), F.coalesce(_note_of(notes, path), F.when(F.size(parts) > 1, F.get(F.filter(above, lambda x: x.isNotNull()), F.lit(0)))))


def with_case(compared: DataFrame, notes: DataFrame, canonical: DataFrame, parts: int | None = None) -> DataFrame:
    """``compared`` plus case_id: the item's own, else for AI-only items the case that their item or array has alone
    (null if several), else the nearest note, else the pair's canonical case. ``canonical`` has a row for a pair.

    ``compared`` is read once and shuffled once, by pair, into ``parts`` partitions (``spark.sql.shuffle.partitions`` if not
    given). A pair's notes come beside its rows, in the order of their paths.
    """
    by_pair = lambda df: df.repartition("pair") if parts is None else df.repartition(parts, "pair")
    told = notes.where("path is not null").select("pair", "path", "case_id").unionByName(canonical.select("pair", F.lit(None).cast("string").alias("path"), F.col("canonical_case_id").alias("case_id")))
    told = by_pair(told.where("pair is not null")).groupBy("pair", "path").agg(F.max("case_id").alias("case_id"))
    noted = F.array_sort(F.collect_list(F.when(F.col("path").isNotNull() & F.col("case_id").isNotNull(), F.struct("path", "case_id"))))
    told = told.groupBy("pair").agg(noted.alias("__notes"), F.max(F.when(F.col("path").isNull(), F.col("case_id"))).alias("__main"))
    rows = by_pair(compared).withColumn("__array", F.substring_index("field_name", ".", 1))
    own = F.when(F.col("pair").isNotNull() & F.col("__array").isNotNull() & F.col("array_key").isNotNull(), F.col("human_case"))
    for name, keys in (("__", ["pair", "__array", "array_key"]), ("__array_", ["pair", "__array"])):
        rows = rows.withColumn(f"{name}low", F.min(own).over(Window.partitionBy(*keys))).withColumn(f"{name}high", F.max(own).over(Window.partitionBy(*keys)))
    nearest = nearest_of(F.col("__notes"), F.col("field_name"))
    alone = F.when(F.col("__low") == F.col("__high"), F.col("__low")).when(F.col("__low").isNull() & (F.col("__array_low") == F.col("__array_high")), F.col("__array_low"))
    inferred = F.col("array_key").isNotNull() & F.col("__array_low").isNotNull() & F.col("human_case").isNull() & F.col("human_value").isNull()
    case = F.when(F.col("human_case").isNotNull(), F.col("human_case")).when(inferred, alone).otherwise(F.coalesce(nearest, F.col("__main")))
    return rows.join(told, "pair", "left").select(*compared.columns, case.alias("case_id"))


def lineage(rows: DataFrame, keys: list[str], case: str = "case_id") -> DataFrame:
    return rows.groupBy(*keys).agg(joined_set(F.collect_set(case)).alias("merged_case_ids"))
