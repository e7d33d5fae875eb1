"""Tables clustered by keys, with versions: range-pruned scans, snapshots, and replacement by one atomic step.

A version is written once, by ranges of its keys: each range is a folder of its own, sorted inside, so that the row
groups' statistics are narrow. Beside it stand the ranges' borders and sizes. The table's ledger says which version
counts from when on: a new version is written and verified first, then one record swaps it in. Older versions stay
readable as of their time until ``forget`` removes them.

Equal keys may lie in several neighbouring ranges, since a key can hold more rows than one range should.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from braidwork.sources.ledger import Ledger
from braidwork.sources.state import remove


class Conflict(RuntimeError):
    """Another driver has replaced the table since this one read it."""


class Refused(RuntimeError):
    """A new version did not pass its checks; the table is as it was."""


@dataclass(frozen=True)
class Part:
    """A run of neighbouring ranges, to be read as one piece of a parallel scan."""

    part_no: int
    first: int
    last: int
    low: Any
    high: Any
    rows: int


class ClusteredTable:
    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str] = ()):
        """``keys``: what a new version is clustered by; a scan goes by the first of them."""
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), tuple(keys)
        self.ledger = Ledger(spark, f"{self.folder}/_ledger")

    def replace(
        self, df: DataFrame, at: datetime, ranges: int | None = None, row_group_bytes: int = 128 << 20,
        must_be_none: Mapping[str, Column] | None = None, expected_rows: int | None = None, based_on: int | None = None,
    ) -> int:
        """Write ``df`` as a new version, check it, and swap it in as of ``at``; returns the version's number.

        No row may fit a condition of ``must_be_none``, and there have to be ``expected_rows``; else ``Refused``. The swap
        is a ``Conflict`` if the table has changed since version ``based_on`` (by default since the call). ``df`` may read the table itself.
        """
        numbers = self.ledger.numbers()
        before = based_on if based_on is not None else (numbers[-1] if numbers else -1)
        name, n = uuid.uuid4().hex, ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        spread, no = (_unused(x, df) for x in ("spread", "range_no"))
        # the number of the row splits a key that holds too many rows for one range
        numbered = df.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange(n, *self.keys, spread).drop(spread)
        placed = numbered.withColumn(no, F.spark_partition_id()).sortWithinPartitions(no, *self.keys)
        placed.write.option("parquet.block.size", row_group_bytes).partitionBy(no).parquet(f"{self.folder}/{name}/data")
        try:
            written = self.spark.read.schema(placed.schema).parquet(f"{self.folder}/{name}/data")
            wrong = {what: F.count_if(condition) for what, condition in (must_be_none or {}).items()}
            found = written.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"wrong {i}") for i, c in enumerate(wrong.values())]).first()
            faults = [f"{found[f'wrong {i}']} rows: {what}" for i, what in enumerate(wrong) if found[f"wrong {i}"]]
            if expected_rows is not None and found["rows"] != expected_rows:
                faults.append(f"{found['rows']} rows instead of {expected_rows}")
            if faults:
                raise Refused("; ".join(faults))
            key = self.keys[0]
            borders = written.groupBy(F.col(no).alias("range_no")).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"))
            borders.coalesce(1).write.parquet(f"{self.folder}/{name}/ranges")
            if not self.ledger.put(before + 1, {"version": name, "at": at.isoformat(), "range": no, "key": key, "schema": placed.schema.json(), "rows": found["rows"]}):
                raise Conflict(f"version {before + 1} of {self.folder} is another driver's")
        except BaseException:
            remove(self.spark, f"{self.folder}/{name}")
            raise
        return before + 1

    def _record(self, as_of: datetime | None, version: int | None) -> dict:
        numbers = self.ledger.numbers()
        for number in reversed(numbers if version is None else [version]):
            record = self.ledger.get(number)
            if as_of is None or datetime.fromisoformat(record["at"]) <= as_of:
                return record
        raise LookupError(f"no version of {self.folder} as of {as_of}")

    def _read(self, record: dict) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(record["schema"]))).parquet(f"{self.folder}/{record['version']}/data")

    def _ranges(self, record: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{record['version']}/ranges")

    def read(self, as_of: datetime | None = None, version: int | None = None) -> DataFrame:
        """The whole table, as of a time or a version; by default the last one."""
        record = self._record(as_of, version)
        return self._read(record).drop(record["range"])

    def ranges(self, as_of: datetime | None = None) -> DataFrame:
        """range_no, low, high, rows, nulls of a version's ranges."""
        return self._ranges(self._record(as_of, None))

    def scan(self, low: Any = None, high: Any = None, as_of: datetime | None = None) -> DataFrame:
        """Rows with low <= key < high: of the folders only those of overlapping ranges are listed and read, and of these
        only the row groups that the key can be in. A null border is open; rows without a key are in no range."""
        record = self._record(as_of, None)
        overlaps = F.lit(True)
        own = F.col(record["key"]).isNotNull()
        if low is not None:
            overlaps, own = overlaps & (F.col("high") >= F.lit(low)), own & (F.col(record["key"]) >= F.lit(low))
        if high is not None:
            overlaps, own = overlaps & (F.col("low") < F.lit(high)), own & (F.col(record["key"]) < F.lit(high))
        first, last = self._ranges(record).where(overlaps).agg(F.min("range_no"), F.max("range_no")).first()
        inside = F.col(record["range"]).between(first, last) if first is not None else F.lit(False)
        return self._read(record).where(inside & own).drop(record["range"])

    def parts(self, most: int, as_of: datetime | None = None) -> list[Part]:
        """At most ``most`` parts of about equal numbers of rows, by the ranges' sizes; no row is read."""
        sizes = self._ranges(self._record(as_of, None))
        order = Window.orderBy("range_no")  # one row a range
        before = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        part = F.floor(before * most / F.greatest(F.sum("rows").over(Window.partitionBy()), F.lit(1)))
        found = sizes.withColumn("part", part).groupBy("part").agg(F.min("range_no").alias("first"), F.max("range_no").alias("last"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"))
        return [Part(i, r["first"], r["last"], r["low"], r["high"], r["rows"]) for i, r in enumerate(found.orderBy("part").collect())]

    def read_part(self, part: Part, as_of: datetime | None = None) -> DataFrame:
        """The rows of one part; parts share no row, and together they are the version."""
        record = self._record(as_of, None)
        return self._read(record).where(F.col(record["range"]).between(part.first, part.last)).drop(record["range"])

    def forget(self, before: datetime) -> int:
        """Delete the data of versions that a later one had replaced by ``before``; returns how many."""
        numbers, gone = self.ledger.numbers(), 0
        records = [self.ledger.get(n) for n in numbers]
        for old, new in zip(records, records[1:], strict=False):
            if datetime.fromisoformat(new["at"]) <= before:
                remove(self.spark, f"{self.folder}/{old['version']}")
                gone += 1
        return gone


def _unused(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
