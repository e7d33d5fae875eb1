"""Source scans with a trailing lookback, and metadata scans over the session's catalogue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lookback(source: DataFrame, end: datetime, interval: str, at: str = "created_at", methods: list[str] | None = None) -> DataFrame:
    """Rows with end - interval <= at < end. Literals reach the scan, so row groups are skipped; where the table is
    partitioned by ``day`` of the same column, whole days are."""
    stop = F.lit(end).cast(dict(source.dtypes)[at])
    start = stop - F.expr(f"INTERVAL {interval}")
    out = source.where((F.col(at) >= start) & (F.col(at) < stop))
    if "day" in source.columns:
        out = out.where((F.col("day") >= F.to_date(start)) & (F.col("day") <= F.to_date(stop)))
    return out.where(F.col("method").isin(methods)) if methods else out


def columns_of(spark: SparkSession, tables: list[str]) -> DataFrame:
    """table_name, column_name, data_type, position of tables or views."""
    rows = [(t, f.name, f.dataType.simpleString(), i) for t in tables for i, f in enumerate(spark.table(t).schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")


def dataset_options(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.locationUri or "", t.name, t.tableType, bool(t.isTemporary)) for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name)]
    return spark.createDataFrame(rows, "database string, location string, table_name string, table_type string, is_temporary boolean")


def qualified(spark: SparkSession, dataset: str, table: str) -> str:
    """The name by which the session finds a dataset's table: below its database, or a view of the session itself."""
    own = f"`{dataset}`.`{table}`"
    return own if spark.catalog.databaseExists(dataset) and spark.catalog.tableExists(own) else table


def tables_of(spark: SparkSession, tables: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """Of tables or views by dataset: (dataset, table_name, table_type) and (dataset, table_name, column_name, data_type,
    position)."""
    kind = lambda d, t: "VIEW" if spark.catalog.getTable(qualified(spark, d, t)).tableType in ("VIEW", "TEMPORARY") else "BASE TABLE"
    names = [(d, t, kind(d, t)) for d, all_ in tables.items() for t in all_]
    columns = [(d, t, f.name, f.dataType.simpleString(), i) for d, all_ in tables.items() for t in all_ for i, f in enumerate(spark.table(qualified(spark, d, t)).schema.fields)]
    return (
        spark.createDataFrame(names, "dataset string, table_name string, table_type string"),
        spark.createDataFrame(columns, "dataset string, table_name string, column_name string, data_type string, position int"),
    )


def storage_of(spark: SparkSession, folders: dict[tuple[str, str], str]) -> DataFrame:
    """dataset, table_name, total_rows, total_bytes, deleted of Parquet folders by (dataset, table): rows from the
    footers, bytes from the listing of the files; no file is read."""
    rows = []
    for (dataset, table), folder in folders.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
        rows.append((dataset, table, spark.read.parquet(folder).count(), files.agg(F.sum("length")).first()[0] or 0, False))
    return spark.createDataFrame(rows, "dataset string, table_name string, total_rows long, total_bytes long, deleted boolean")


def partitions_of(table: DataFrame, partition: str) -> DataFrame:
    """partition_id, total_rows, total_bytes of a partitioned Parquet table, by its files' metadata."""
    files = table.groupBy(F.col(partition).cast("string").alias("partition_id"), "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
    return files.groupBy("partition_id").agg(F.sum("rows").alias("total_rows"), F.sum("file_size").alias("total_bytes"))


PAGE = "struct<documents: array<struct<name: string, createTime: string, updateTime: string>>, nextPageToken: string>"


def listed_documents(pages: DataFrame) -> DataFrame:
    """pages(page_token, body), as a document store's listing gives them, -> path, create_time, update_time, page_token."""
    body = pages.select("page_token", F.from_json("body", PAGE).alias("page"))
    return body.select("page_token", F.inline("page.documents")).select(F.col("name").alias("path"), F.to_timestamp("createTime").alias("create_time"), F.to_timestamp("updateTime").alias("update_time"), "page_token")


def missing_pages(pages: DataFrame) -> DataFrame:
    """Tokens that a page names as the next one, without a page of that token: the listing broke off there."""
    named = pages.select(F.get_json_object("body", "$.nextPageToken").alias("page_token")).where("page_token <> ''").distinct()
    return named.join(pages.select("page_token"), "page_token", "left_anti")


def key_ranges(splits: list[str]) -> list[tuple[int, str | None, str | None]]:
    """Ranges [low, high) that split points cut a key space into; the first and the last are open."""
    borders = [None, *sorted(set(splits)), None]
    return [(i, low, high) for i, (low, high) in enumerate(zip(borders, borders[1:], strict=False))]


def scan_ranges(documents: DataFrame, key: str, splits: list[str], read_time: datetime | None = None, changed: str = "update_time") -> DataFrame:
    """``documents`` with range_no, the key range that a row's key falls into, by a snapshot: rows that changed after
    ``read_time`` are left out. Each range is a part of its own where the table is written by range_no."""
    at = F.lit(None).cast("int")
    for i, low, high in key_ranges(splits):
        own = F.lit(True) if low is None else F.col(key) >= low
        at = F.when(own if high is None else own & (F.col(key) < high), i).otherwise(at)
    rows = documents.withColumn("range_no", at)
    return rows if read_time is None else rows.where(F.col(changed) <= F.lit(read_time).cast(dict(documents.dtypes)[changed]))


def path_parts(path: str = "path") -> list:
    """Columns of a document path: collection group, parent, depth, id."""
    parts = F.split(path, "/")
    return [
        F.get(parts, F.size(parts) - 2).alias("collection_group"),
        F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "/").alias("parent"),
        F.floor(F.size(parts) / 2).cast("int").alias("depth"),
        F.get(parts, F.size(parts) - 1).alias("id"),
    ]
