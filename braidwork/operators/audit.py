"""Data-age audit: how old the dated rows of each table are, what could not be checked, what deleting would save."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidwork.functions import payload as P
from braidwork.functions.times import as_timestamp
from braidwork.operators.relational import first_of_each
from braidwork.sources.scans import qualified

DATE_NAME = r"date|time|_at$|_dt$|_ts$"
_DATED = ("timestamp", "timestamp_ntz", "date")


def date_columns(columns: DataFrame) -> DataFrame:
    """Columns of date types, and text columns whose name says that they hold dates."""
    named = F.lower("column_name").rlike(DATE_NAME) & (F.col("data_type") == "string")
    return columns.where(F.col("data_type").isin(*_DATED) | named)


def years_before(as_of: Column, years: int) -> Column:
    """The day ``years`` years before ``as_of``."""
    return F.add_months(F.to_date(as_of), -12 * years)


_TABLE = ["dataset", "table_name"]


def audit_plan(tables: DataFrame, columns: DataFrame, storage: DataFrame, min_gb: float, max_scan_gb: float, batch: int) -> DataFrame:
    """dataset, table_name, date_columns, names, total_rows, table_gb, est_gb, reason, batch_no of every base table or
    snapshot outside hidden datasets. ``reason`` says why a table is not checked; the others get batch numbers.

    The estimate is 16 bytes a row and date column. Listings of tables are small, so they are numbered in one window.
    """
    listed = tables.where(F.col("table_type").isin("BASE TABLE", "SNAPSHOT") & ~F.startswith("dataset", F.lit("_")))
    dated = date_columns(columns).groupBy(*_TABLE).agg(F.count(F.lit(1)).alias("date_columns"), F.array_sort(F.collect_list("column_name")).alias("names"))
    left, right = listed.alias("t"), storage.alias("s")
    sized = left.join(right, (F.col("t.dataset") == F.col("s.dataset")) & (F.col("t.table_name") == F.col("s.table_name")) & ~F.col("s.deleted"), "left")
    sized = sized.groupBy("t.dataset", "t.table_name").agg(F.coalesce(F.any_value("s.total_rows"), F.lit(0)).alias("total_rows"), (F.coalesce(F.any_value("s.total_bytes"), F.lit(0)) / F.pow(F.lit(1024), 3)).alias("table_gb"))
    plan = sized.join(dated, _TABLE, "left").withColumn("est_gb", F.col("total_rows") * F.col("date_columns") * 16 / F.pow(F.lit(1024), 3))
    reason = (
        F.when(F.col("date_columns").isNull(), "no date-like column").when(F.col("table_gb") < min_gb, "below min_table_gb")
        .when(F.col("est_gb") > max_scan_gb, F.format_string("too large (~%.1f GB estimated scan)", F.col("est_gb")))
    )
    plan = plan.withColumn("reason", reason)
    place = F.row_number().over(Window.partitionBy(F.col("reason").isNull()).orderBy(*_TABLE)) - 1
    return plan.withColumn("batch_no", F.when(F.col("reason").isNull(), F.floor(place / batch).cast("int")))


def audit_batches(plan: DataFrame) -> DataFrame:
    """batch_no, tables_in_batch (names in order), and the tables with their date columns."""
    name = F.concat_ws(".", *_TABLE)
    entry = F.array_sort(F.collect_list(F.struct(name.alias("name"), "dataset", "table_name", "names")))
    rows = plan.where("reason is null").groupBy("batch_no").agg(entry.alias("tables"))
    return rows.select("batch_no", F.array_join("tables.name", ", ").alias("tables_in_batch"), "tables").orderBy("batch_no")


def ages(df: DataFrame, table: str, columns: Sequence[str], cutoff: Column) -> DataFrame:
    """Per column: oldest, newest, dated, older than the cutoff, and values that are no date; one scan of the table."""
    kinds = dict(df.dtypes)
    value = lambda c: as_timestamp(F.col(c)) if kinds[c] == "string" else F.col(c).cast("timestamp")
    raw = lambda c: F.col(c).cast("string")
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), value(c).alias("value"), raw(c).alias("raw")) for c in columns])
    return df.select(F.inline(entries)).groupBy("column_name").agg(
        F.min("value").alias("oldest"), F.max("value").alias("newest"), F.count("value").alias("n_dated"),
        F.count_if(F.col("value") < cutoff.cast("timestamp")).alias("n_old"), F.count_if(F.col("raw").isNotNull() & F.col("value").isNull()).alias("n_unreadable"),
    ).select(F.lit(table).alias("table_name"), "*")


AGES = "dataset string, table_name string, column_name string, oldest timestamp, newest timestamp, n_dated bigint, n_old bigint, n_unreadable bigint"


def audit(spark: SparkSession, plan: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ages, unchecked tables with the reason, errors by batch) of an ``audit_plan``.

    Batches run one after the other, so that one that fails, when its tables are read, ends no other; what is gathered
    is a row a date column.
    """
    found, errors, failed = [], [], []
    for row in audit_batches(plan).collect():
        try:
            parts = [ages(spark.table(qualified(spark, t.dataset, t.table_name)), t.table_name, t.names, cutoff).select(F.lit(t.dataset).alias("dataset"), "*") for t in row.tables]
            found += reduce(lambda a, b: a.unionByName(b), parts).collect()
        except Exception as problem:  # whatever a table's files raise
            errors.append((row.batch_no, row.tables_in_batch, str(problem)[:200]))
            failed += [(t.dataset, t.table_name) for t in row.tables]
    lost = spark.createDataFrame([(*t, "batch failed") for t in failed], "dataset string, table_name string, problem string")
    unchecked = plan.join(lost, _TABLE, "left").select(*_TABLE, "table_gb", "date_columns", F.coalesce("reason", "problem").alias("reason")).where("reason is not null")
    return spark.createDataFrame(found, AGES), unchecked, spark.createDataFrame(errors, "batch_no int, tables_in_batch string, message string")


def audit_report(found: DataFrame, storage: DataFrame) -> DataFrame:
    """Ages with the tables' sizes and the share and size of what is old, the largest first."""
    gb = lambda c: c / F.pow(F.lit(1024), 3)
    share = F.try_divide(F.col("n_old").cast("double"), F.col("total_rows"))
    rows = found.join(storage.where(~F.col("deleted")).drop("deleted"), _TABLE, "left")
    rows = rows.withColumn("pct_old", F.round(share * 100, 1)).withColumn("table_gb", F.round(gb(F.col("total_bytes")), 2)).withColumn("est_old_gb", F.round(share * gb(F.col("total_bytes")), 2))
    return rows.drop("total_bytes").orderBy(F.desc_nulls_last("est_old_gb"), F.desc_nulls_last("table_gb"), *_TABLE, "column_name")


def collection_summary(documents: DataFrame, group: str, at: str, size: str, cutoff: Column) -> DataFrame:
    """Per collection its documents, the oldest, how many are old and their size, the largest first."""
    old = F.col(at) < cutoff
    found = documents.groupBy(group).agg(
        F.count(F.lit(1)).alias("docs"), F.min(at).alias("oldest"), F.count_if(old).alias("docs_old"),
        F.round(F.sum(F.when(old, F.col(size)).otherwise(0)) / F.pow(F.lit(1024), 3), 2).alias("old_gb"),
    )
    return found.orderBy(F.desc("old_gb"), group)


def document_ages(documents: DataFrame, date_field_of: Mapping[str, str], cutoff: Column) -> DataFrame:
    """Documents (collection_path, path, create_time, update_time, date_fields as JSON) before the cutoff, by the date
    field that their collection has, if it has one and it can be read, else by their creation."""
    mapping = documents.sparkSession.createDataFrame(list(date_field_of.items()), "collection_path string, field string")
    rows = documents.join(F.broadcast(mapping), "collection_path", "left")  # a row a configured collection
    business = as_timestamp(F.expr("get_json_object(date_fields, concat('$.', field))"))
    rows = rows.withColumn("business", business.cast(dict(documents.dtypes)["create_time"]))
    source = F.when(F.col("business").isNotNull(), "date field").otherwise("createTime")
    found = rows.select("collection_path", "path", F.coalesce("business", "create_time").alias("age_ts"), source.alias("age_source"), (F.col("update_time") >= cutoff).alias("updated_since"))
    return found.where(F.col("age_ts") < cutoff).orderBy("collection_path", "age_ts", "path")


def old_partitions(partitions: DataFrame, cutoff_id: str) -> DataFrame:
    """Over partitions (partition_id, total_rows, total_bytes): all and those before the cutoff's."""
    old = F.col("partition_id") < cutoff_id
    total = lambda c: (F.sum(c).alias(c), F.sum(F.when(old, F.col(c)).otherwise(0)).alias(f"old_{c.removeprefix('total_')}"))
    return partitions.agg(*total("total_rows"), *total("total_bytes"))


def age_check(df: DataFrame, at: str, cutoff: Column) -> DataFrame:
    """total, with the field, older than the cutoff, oldest, share of old rows in percent (null without rows)."""
    total, old = F.count(F.lit(1)), F.count_if(F.col(at) < cutoff)
    return df.agg(total.alias("total"), F.count(at).alias("with_field"), old.alias("older"), F.min(at).alias("oldest"), F.round(F.try_divide(old.cast("decimal(20,4)") * 100, total), 1).cast("decimal(6,1)").alias("old_pct"))


def savings(share: Column, storage: Column, recovery: Column, one_time: Column) -> list[Column]:
    """Monthly saving, and months until the one-time cost is back."""
    monthly = share * (storage + recovery)
    return [monthly.alias("monthly_saving"), F.try_divide(one_time, monthly).alias("payback_months")]


def purge_outcome(batch: DataFrame, failed: DataFrame, skipped: DataFrame) -> DataFrame:
    """Dry run of a purge: what a batch's documents would end as; failed and skipped ones are listed, the rest goes."""
    marks = failed.select("path", F.lit("FAILED").alias("outcome")).union(skipped.select("path", F.lit("SKIPPED").alias("outcome")))
    marks = marks.groupBy("path").agg(F.min("outcome").alias("outcome"))
    return batch.join(marks, "path", "left").withColumn("outcome", F.coalesce("outcome", F.lit("DELETED")))


def guarded(batch: DataFrame, allowed: Sequence[str], most: int, scanned_at: Column, not_before: Column) -> DataFrame:
    """The batch, or an error: empty, too large, of a group that is not allowed, or scanned too long ago."""
    facts = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("collection_group").isin(*allowed)).alias("foreign"), F.min(scanned_at).alias("scanned"), F.max(not_before).alias("limit")).first()
    if not facts.n:
        raise ValueError("the batch is empty")
    if facts.n > most or facts.foreign or facts.scanned < facts.limit:
        raise ValueError(f"the batch breaks a rule: {facts.n} documents, {facts.foreign} of other groups, scanned {facts.scanned}")
    return batch


def approved_batch(spark: SparkSession, approved: DataFrame, batch_id: str) -> DataFrame:
    """The documents of one approved batch, by a parameter and never by text put into SQL."""
    return spark.sql("SELECT path, collection_group FROM {approved} WHERE batch_id = :batch", args={"batch": batch_id}, approved=approved)


def sampled_old_share(df: DataFrame, id_column: str, at: str, cutoff: Column, size: int = 300) -> DataFrame:
    """Share of old documents in a sample: the first ``size`` by name."""
    sample = df.orderBy(id_column).limit(size)
    old = F.count_if(F.col(at) < cutoff)
    return sample.agg(F.count(F.lit(1)).alias("sampled"), old.alias("older"), F.try_divide(old, F.count(F.lit(1))).alias("share"))


def sampled_fields(documents: DataFrame, group: str, id_column: str, payload: str, size: int = 20) -> DataFrame:
    """Which fields hold dates in the first ``size`` documents of each collection: group, field, documents with one."""
    sample = first_of_each(documents, [group], [F.col(id_column)], size)
    fields = sample.select(group, F.inline(P.flattened(F.col(payload), {}))).where(as_timestamp(F.col("value")).isNotNull())
    return fields.groupBy(group, "field").agg(F.count(F.lit(1)).alias("n"))


def oldest(df: DataFrame, at: str, *ties: str) -> DataFrame:
    """The one oldest row; null times come last."""
    return df.orderBy(F.col(at).asc_nulls_last(), *ties).limit(1)


def date_fields(documents: DataFrame, id_column: str, payload: str) -> DataFrame:
    """Per field path of JSON documents: how many values are timestamps, the oldest and the newest."""
    fields = documents.select(id_column, F.inline(P.flattened(F.col(payload), {}))).withColumn("at", as_timestamp(F.col("value")))
    return fields.where(F.col("at").isNotNull()).groupBy("field").agg(F.count(F.lit(1)).alias("n_dated"), F.min("at").alias("oldest"), F.max("at").alias("newest"))


def document_bytes(path: Column, fields: Column) -> Column:
    """Estimated stored size: 16 bytes and one more than each part of the path, and 32 bytes a document, besides its fields
    (an array of struct(name, value)), each name and text value one byte longer than its UTF-8."""
    name = F.aggregate(F.split(path, "/"), F.lit(16), lambda acc, x: acc + F.octet_length(x) + 1)
    return name + 32 + F.aggregate(fields, F.lit(0), lambda acc, f: acc + F.octet_length(f["name"]) + 1 + F.coalesce(F.octet_length(f["value"]) + 1, F.lit(1)))


def completeness(expected: DataFrame, scanned: DataFrame, group: str, number: str) -> DataFrame:
    """Per group the documents expected and scanned, and whether all of them were."""
    found = scanned.groupBy(group).agg(F.count(F.lit(1)).alias("scanned"))
    joined = expected.join(found, group, "left").withColumn("scanned", F.coalesce("scanned", F.lit(0)))
    return joined.withColumn("complete", F.col("scanned") >= F.col(number))


def reconciled(batch: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Documents of a batch without exactly one outcome; none if every one was deleted, skipped or failed once."""
    counts = outcomes.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return batch.select("path").join(counts, "path", "left").where(F.coalesce("n", F.lit(0)) != 1).select("path")


def must_be_none(df: DataFrame, what: str) -> None:
    """A check after a migration."""
    n = df.count()
    if n:
        raise ValueError(f"{n} rows {what}")
