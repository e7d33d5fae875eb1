"""Relational building blocks that the run, the views and the reports share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tagged_union(frames: dict[str, DataFrame], tag: str = "tag") -> DataFrame:
    """Bag union by name, each row with the name of its frame."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of every key the first row in an order that has to be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def latest_by(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str]) -> DataFrame:
    """Of every key the row with the latest time, a null time losing, then the smallest tie columns."""
    return first_by(df, keys, [F.col(at).desc_nulls_last(), *[F.col(t).asc() for t in ties]])


def latest_with_ties(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Of every key all rows with the latest time."""
    latest = F.max(at).over(Window.partitionBy(*keys))
    return df.withColumn("__latest", latest).where(F.col(at) == F.col("__latest")).drop("__latest")


def not_in(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def presence(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per key the number of rows in each frame; keys of any frame."""
    every = tagged_union({name: df.select(*keys) for name, df in frames.items()})
    return every.groupBy(*keys).agg(*[F.count_if(F.col("tag") == name).alias(f"n_{name}") for name in frames])


def as_of_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, out: str) -> DataFrame:
    """``left`` plus the latest ``right_at`` strictly before ``left_at`` with the same keys.

    Both sides in one sorted pass per key instead of a join on <: the running maximum of the earlier rows.
    """
    rows = left.select("*", F.lit(1).alias("__side"), F.col(left_at).alias("__at"), F.lit(None).cast(dict(right.dtypes)[right_at]).alias("__seen"))
    marks = right.select(*keys, F.lit(0).alias("__side"), F.col(right_at).alias("__at"), F.col(right_at).alias("__seen"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    # strictly before: equal times must not count, so only values of smaller times are in the frame
    # times without a zone are compared as they are: in a zone with summer time two of them may be one moment
    plain = dict(both.dtypes)["__at"] == "timestamp_ntz"
    instant = F.concat(F.col("__at").cast("string"), F.lit("Z")) if plain else F.col("__at")
    micros = F.unix_micros(instant.cast("timestamp"))
    w = Window.partitionBy(*keys).orderBy(micros).rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn(out, F.max("__seen").over(w)).where("__side = 1").drop("__side", "__at", "__seen")


def above_average(df: DataFrame, keys: Sequence[str], value: str, factor: float) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the average of their key."""
    w = Window.partitionBy(*keys)
    return df.withColumn("avg_value", F.avg(value).over(w)).where(F.col(value) > factor * F.col("avg_value"))


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    """Of every key the first ``most`` rows in an order that has to be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= most).drop("__rank")


def numbered_batches(df: DataFrame, order: Sequence[str], size: int, slots: int = 64) -> DataFrame:
    """Rows numbered from 1 in a total order (nulls first) and cut into batches, without a task that sorts all of them.

    A sample of bounded size gives the borders of ``slots`` ranges; a row's number is its place in its range behind the
    rows of the ranges before. Any borders give the same numbers.
    """
    key = F.struct(*order)
    sample = df.select(key.alias("k")).sample(min(1.0, 20 * slots / max(1, df.count())), seed=7).orderBy("k").collect()
    borders = [r.k for r in sample[:: max(1, len(sample) // slots)]]
    kinds = [df.schema[c].dataType for c in order]
    literal = lambda row: F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, kinds, order, strict=True)])
    slot = F.size(F.filter(F.array(*map(literal, borders)), lambda b: b <= key)) if borders else F.lit(0)
    rows = df.withColumn("__slot", slot)
    sizes = rows.groupBy("__slot").agg(F.count(F.lit(1)).alias("__rows"))
    # one row a range
    before = sizes.select("__slot", (F.sum("__rows").over(Window.orderBy("__slot")) - F.col("__rows")).alias("__before"))
    n = F.row_number().over(Window.partitionBy("__slot").orderBy(*order)) + F.col("__before")
    numbered = rows.join(F.broadcast(before), "__slot").withColumn("n", n)
    return numbered.withColumn("batch", F.floor((F.col("n") - 1) / size)).drop("__slot", "__before")
