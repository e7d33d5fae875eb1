"""Waiting groups as keyed state of a stream: each waits from its first row and ages out after a week.

A group's wait begins with its first row and takes in every row of the age limit after it; when the watermark has
passed its end, the group is emitted with what it has of either side and its state goes. A row behind the end begins
the next wait. Rows are only judged when the watermark has passed, so the result does not depend on how the stream was
cut into batches or how its files were ordered, as long as no row is later than the watermark allows.

State: per group the start of its wait and, per second since, how many rows of either side there were. So a group's
state is bounded by the age limit and the watermark's delay in seconds, whatever the number of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state with timers needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AGED = "key string, first_seen long, n_ai long, n_human long"


class Waiting(StatefulProcessor):
    def __init__(self, age_seconds: int):
        self.age = age_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # seconds, ai and human are arrays beside each other; passed: end of the last wait that was emitted
        self.state = handle.getValueState("waiting", "passed long, seconds array<long>, ai array<long>, human array<long>")

    def _load(self) -> tuple[int, dict[int, list[int]]]:
        passed, seconds, ai, human = self.state.get() or (-(1 << 62), (), (), ())
        return passed, {s: [a, h] for s, a, h in zip(seconds, ai, human, strict=True)}  # in the order of seconds

    def _store(self, passed: int, rows: list[tuple[int, list[int]]], timer: int | None) -> None:
        """``timer``: the second that the group's timer is set to, None if it has none or that one has gone off."""
        self.state.update((passed, [s for s, _ in rows], [n[0] for _, n in rows], [n[1] for _, n in rows]))
        due = rows[0][0] + self.age if rows else None
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer * 1000)
            if due is not None:
                self.handle.registerTimer(due * 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed, known = self._load()
        timer = next(iter(known)) + self.age if known else None
        for row in rows:
            if row.second >= passed:
                known.setdefault(row.second, [0, 0])[row.human] += 1
        self._store(passed, sorted(known.items()), timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        passed, known = self._load()
        rows, at = list(known.items()), 0
        while at < len(rows) and (rows[at][0] + self.age) * 1000 <= now:
            first = rows[at][0]
            passed, ai, human = first + self.age, 0, 0
            while at < len(rows) and rows[at][0] < passed:
                ai, human, at = ai + rows[at][1][0], human + rows[at][1][1], at + 1
            yield Row(key=str(key[0]), first_seen=first, n_ai=ai, n_human=human)
        self._store(passed, rows[at:], None)

    def close(self) -> None:
        pass


def aged_groups(rows: DataFrame, key: str, side: str, at: str, age_days: int = 7, late: str = "1 hour") -> DataFrame:
    """A stream's aged groups: key, first_seen_at, n_ai, n_human. ``side`` is 'ai' or 'human', ``at`` the rows' time.

    Rows without a key or a time are in no group. The session needs the state store of ``with_state_store``.
    """
    own = rows.select(F.col(key).cast("string").alias("key"), F.col(side).alias("side"), F.col(at).cast("timestamp").alias("at")).where("key is not null and at is not null")
    timed = own.withWatermark("at", late).select("key", "at", F.unix_seconds("at").alias("second"), F.coalesce(F.col("side") == "human", F.lit(False)).cast("int").alias("human"))
    aged = timed.groupBy("key").transformWithState(Waiting(age_days * 86400), AGED, "Append", "EventTime")
    return aged.select("key", F.timestamp_seconds("first_seen").alias("first_seen_at"), "n_ai", "n_human")


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session of its own, beside ``spark``, whose streams keep their state in the store that timers need."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return own
