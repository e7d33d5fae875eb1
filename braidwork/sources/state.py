"""Sinks of a run: the checkpoint with its lease, versioned state, appends that a commit makes visible.

A run claims the open window with a lease and writes into folders of its own claim. Its commit, one record of the
checkpoint's ledger, advances the window and names those folders in one step: readers follow the commits, so they see a
run's outputs all at once, and a failed or overtaken attempt never. Files are read and written by Spark only, so any
store it knows will do.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.sources.ledger import Ledger


class Held(RuntimeError):
    """Another driver's lease on the window has not ended."""


class Fenced(RuntimeError):
    """The lease was lost to another driver; what this one wrote stays unseen."""


@dataclass(frozen=True)
class Window:
    """last_extracted < rows seen so far; current_stop: where the claimed run ends; version: the state that counts.

    step: the number of the ledger's record, which is the fencing number of a claim; owner, expires: its lease.
    """

    last_extracted: datetime
    current_stop: datetime
    version: str = ""
    step: int = 0
    owner: str = ""
    expires: float = 0.0

    @property
    def start(self) -> datetime:
        """Where the window's rows begin: an hour before what has been seen, for rows that came late."""
        return self.last_extracted - timedelta(hours=1)

    @property
    def is_open(self) -> bool:
        return self.current_stop != self.last_extracted


class Checkpoint:
    """The ledger of a pipeline's windows; its last record counts.

    A record can only be written behind the one that its writer has read. So of two drivers that claim at once one gets
    the window and the other is refused; a driver whose lease ended goes on only until another has taken the window over,
    and its renewal or commit then fails, since that number is taken.
    """

    def __init__(self, spark: SparkSession, path: str, lease_seconds: float = 9000.0, clock: Callable[[], float] = time.time):
        """``lease_seconds``: how long a claim holds without a renewal; by default a run's whole time budget."""
        self.spark, self.path, self.lease_seconds, self.clock = spark, path, lease_seconds, clock
        self.ledger = Ledger(spark, path)

    def _put(self, kind: str, window: Window, **more) -> Window | None:
        record = {"kind": kind, "last_extracted": window.last_extracted.isoformat(), "current_stop": window.current_stop.isoformat(), "version": window.version, "owner": window.owner, "expires": window.expires}
        return window if self.ledger.put(window.step, record | more) else None

    def seed(self, at: datetime) -> Window:
        """The first window of an empty ledger; behind other records a window that begins anew at ``at``."""
        while True:
            numbers = self.ledger.numbers()
            window = self._put("seed", Window(at, at, step=numbers[-1] + 1 if numbers else 0))
            if window is not None:
                return window

    def read(self) -> Window:
        """The window in whole seconds; an unseeded checkpoint is an error."""
        found = self.ledger.last()
        if found is None:
            raise LookupError(f"no checkpoint in {self.path}")
        number, r = found
        whole = [datetime.fromisoformat(r[c]).replace(microsecond=0) for c in ("last_extracted", "current_stop")]
        return Window(*whole, r["version"], number, r["owner"], r["expires"])

    def claim(self, now: datetime, owner: str | None = None) -> Window:
        """Open the window up to ``now``, or take over one that a dead or failed run left open, as it is.

        ``Held`` while another owner's lease on it lasts.
        """
        owner = owner or uuid.uuid4().hex
        while True:
            window = self.read()
            if window.is_open and window.owner != owner and window.expires > self.clock():
                raise Held(f"{window.owner} holds the window to {window.current_stop} for {window.expires - self.clock():.0f} s more")
            stop = window.current_stop if window.is_open else now.replace(microsecond=0)
            mine = self._put("claim", replace(window, current_stop=stop, step=window.step + 1, owner=owner, expires=self.clock() + self.lease_seconds))
            if mine is not None:
                return mine

    def renew(self, window: Window) -> Window:
        """Prolong the lease; ``Fenced`` where another driver has the window now. Every write of a run comes behind one."""
        mine = self._put("renew", replace(window, step=window.step + 1, expires=self.clock() + self.lease_seconds))
        if mine is None:
            raise Fenced(f"record {window.step + 1} is not of {window.owner}")
        return mine

    def advance(self, window: Window, version: str, outputs: Mapping[str, str] | None = None) -> Window:
        """Commit: the window's end has been reached, ``version`` is its state, ``outputs`` its folders by table."""
        done = self._put("commit", Window(window.current_stop, window.current_stop, version, window.step + 1), run_owner=window.owner, outputs=dict(outputs or {}))
        if done is None:
            raise Fenced(f"record {window.step + 1} is not of {window.owner}")
        return done

    def release(self, window: Window) -> None:
        """End the lease of a run that failed; its window stays open for the next one. Without effect if it was lost."""
        self._put("release", replace(window, step=window.step + 1, expires=0.0))

    def revert(self, window: Window) -> Window:
        """Close the window without advancing, as if it had not been claimed."""
        done = self._put("revert", Window(window.last_extracted, window.last_extracted, window.version, window.step + 1))
        if done is None:
            raise Fenced(f"record {window.step + 1} is not of {window.owner}")
        return done

    def commits(self, at_step: int | None = None) -> list[dict]:
        """Commit records up to ``at_step``, the oldest first."""
        numbers = [n for n in self.ledger.numbers() if at_step is None or n <= at_step]
        found = [{"step": n} | self.ledger.get(n) for n in numbers]
        return [r for r in found if r["kind"] == "commit"]


def committed(checkpoint: Checkpoint, table: str, folder: str, ddl: str, at_step: int | None = None) -> DataFrame:
    """The appended table as of a commit (the last one by default): rows of the runs that commits name, with run and day.

    A run whose partitions retention has dropped is passed over.
    """
    spark = checkpoint.spark
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = {s.getPath().getName() for s in files.listStatus(path)} if files.exists(path) else set()
    runs = [r["outputs"][table] for r in checkpoint.commits(at_step) if r["outputs"].get(table) in there]
    schema = f"{ddl.replace(' not null', '')}, run string, day date"
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/{r}" for r in runs])


def vacuum(checkpoint: Checkpoint, folder: str, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Delete run folders that no commit names and that have not been written to for a while: what attempts left behind."""
    fs_path = checkpoint.spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(folder).getFileSystem(checkpoint.spark._jsc.hadoopConfiguration())
    before = (checkpoint.clock() - older_than.total_seconds()) * 1000
    old = {s.getPath().getName(): s.getPath() for s in files.globStatus(fs_path(f"{folder}/run=*")) or [] if s.getModificationTime() <= before}
    named = {x for r in checkpoint.commits() for x in r["outputs"].values()}  # read behind the listing
    gone = sorted(set(old) - named)
    for name in gone:
        files.delete(old[name], True)
    return gone


def read_version(spark: SparkSession, folder: str, version: str, ddl: str) -> DataFrame:
    """The state of a version; before the first one an empty table. No age filter: old rows have to be seen to age out."""
    if not version:
        return spark.createDataFrame([], ddl.replace(" not null", ""))
    return spark.read.parquet(f"{folder}/v={version}")


def write_version(df: DataFrame, folder: str, version: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/v={version}")


def append_run(df: DataFrame, folder: str, run: str, day_of: str, clustered_by: Sequence[str] = ()) -> str:
    """Write a run's rows by day into its own folder, whose name it returns; a commit makes them visible.

    With ``clustered_by`` each file holds a range of these columns, in their order, so that a reader's filter on them
    skips files and row groups. Nothing that may be visible is deleted: a run's name holds its claim's number, so another
    attempt has another folder.
    """
    rows = df.withColumn("day", F.to_date(day_of))
    if clustered_by:
        # run is the folder's name alone: with a constant to partition by, the writer would sort anew, by that and day only
        rows = rows.repartitionByRange("day", *clustered_by).sortWithinPartitions("day", *clustered_by)
    rows.write.mode("append").partitionBy("day").parquet(f"{folder}/run={run}")
    return f"run={run}"


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_before(spark: SparkSession, folder: str, cutoff: str, column: str = "day") -> list[str]:
    """Retention: delete the partitions of days before the cutoff; returns them. No file is read."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.globStatus(fs_path(f"{folder}/run=*/{column}=*")):
        path = status.getPath()
        if path.getName().removeprefix(f"{column}=") < cutoff:
            files.delete(path, True)
            gone.append(f"{path.getParent().getName()}/{path.getName()}")
    return sorted(gone)


def add_column(df: DataFrame, name: str, value) -> DataFrame:
    """Migration: a column that older rows lack, filled where it is null."""
    return df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
