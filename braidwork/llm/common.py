"""What the corpus operators share: the folder for intermediate tables and small column helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word: a run of characters other than U+0020 and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only in local mode where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="braidwork-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def bounded_batches(spark: SparkSession, most: str = "8m") -> None:
    """Arrow batches of at most about 8 MB for the session, unless it has a limit of its own: the default counts rows
    and 64 MB, and a batch is held several times, in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "67108864"):
        spark.conf.set(name, most)


def give_back() -> None:
    """Hand memory that a finished piece of Python work has freed back to the system.

    A worker stays for the tasks after it, of other stages too, and allocators keep what was freed; beside a JVM that
    has grown to its limit that is what an executor lacks.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/braidwork/{spark.sparkContext.applicationId}"


def drop_stored(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them are of no use afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one that is no column of the frames in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_numbers(docs: DataFrame, name: str = "__row") -> DataFrame:
    """``docs`` with a further column, a number of its own for each row, written once: every later scan reads the same."""
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_blocks(docs: DataFrame, most: int = 1 << 26) -> int:
    """How many blocks the texts are dealt into: two for each shuffle partition, more if one would pass ``most`` bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(2 * shuffle_parts(docs.sparkSession), -(-size // most))
