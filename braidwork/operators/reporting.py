"""The case-processing report: a star of left joins, derived times, and measures that survive fan-out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.functions.text import first_label
from braidwork.functions.times import as_timestamp, local_time, month_of, seconds_between
from braidwork.operators.relational import as_of_latest, latest_with_ties

def star(fact: DataFrame, joins: Sequence[tuple[DataFrame, str, str]], parts: int | None = None) -> DataFrame:
    """The fact left-joined with each (table, own column, its key); columns have to differ in name.

    ``parts``: how many partitions the rows are dealt to before each join, so that what a task sorts stays bounded; for
    joins whose tables are too large to be broadcast.
    """
    out = fact
    for table, own, key in joins:
        out = (out if parts is None else out.repartition(parts, own)).join(table, out[own] == table[key], "left")
    return out


def fan_out_safe(rows: DataFrame, dims: Sequence[str], key: str, measures: dict[str, Column]) -> DataFrame:
    """Measures over distinct ``key`` per group, whatever the joins multiplied.

    ``measures`` aggregate over one row a key; the first pass brings each group to those rows.
    """
    inputs = [c for c in rows.columns if c not in {*dims, key}]
    one = rows.where(F.col(key).isNotNull()).groupBy(*dims, key).agg(*[F.min(c).alias(c) for c in inputs])
    return one.groupBy(*dims).agg(*[m.alias(name) for name, m in measures.items()])


@dataclass(frozen=True)
class Measure:
    """An aggregate over one row a ``key``: count, sum, average, min or max of ``column``."""

    key: str
    kind: str = "count"
    column: str | None = None


def symmetric_measures(rows: DataFrame, dims: Sequence[str], measures: Mapping[str, Measure], parts: int | None = None) -> DataFrame:
    """Measures of several primary keys of one star in one pass, each over the distinct values of its own key in a group.

    Every row is expanded to one small row a key, with that key's columns only; a group's rows of one key meet once and
    leave a single row, before the shuffle already, so neither fan-out nor a hot group reaches one task. A null key is no
    row of its table and counts nowhere.

    ``parts``: how many partitions the rows of all keys are dealt to by their key, before they are aggregated; a task's
    memory then follows their number. Without it Spark aggregates its own partitions first.
    """
    keys = list(dict.fromkeys(m.key for m in measures.values()))
    columns = {k: list(dict.fromkeys(m.column for m in measures.values() if m.key == k and m.column)) for k in keys}
    wanted = list(dict.fromkeys(c for cs in columns.values() for c in cs))
    types = dict(rows.dtypes)
    each = [
        F.struct(F.lit(i).alias("which"), F.col(k).cast("string").alias("id"), *[(F.col(c) if c in columns[k] else F.lit(None).cast(types[c])).alias(f"v{j}") for j, c in enumerate(wanted)])
        for i, k in enumerate(keys)
    ]
    names = [F.col(d).alias(f"d{i}") for i, d in enumerate(dims)]
    own = [f"d{i}" for i in range(len(dims))]
    expanded = rows.select(*names, F.inline(F.array(*each)))
    expanded = expanded if parts is None else expanded.repartition(parts, *own, "which", "id")
    # rows of a group without any key stay, so that the group is there
    one = expanded.groupBy(*own, "which", "id").agg(*[F.min(f"v{j}").alias(f"v{j}") for j in range(len(wanted))] or [F.count(F.lit(1)).alias("n")])
    functions = {"sum": F.sum, "average": F.avg, "min": F.min, "max": F.max}

    def total(m: Measure) -> Column:
        mine = (F.col("which") == keys.index(m.key)) & F.col("id").isNotNull()
        return F.count_if(mine) if m.kind == "count" else functions[m.kind](F.when(mine, F.col(f"v{wanted.index(m.column)}")))

    found = one.groupBy(*own).agg(*[total(m).alias(name) for name, m in measures.items()])
    return found.withColumnsRenamed(dict(zip(own, dims, strict=True)))


def processing_group(columns: Sequence[Column], patterns: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """The group whose LIKE patterns fit a location, role or company text; which groups there are is configuration."""
    return first_label(columns, patterns, default)


def any_outcome(outcomes: DataFrame, key: str, value: str) -> DataFrame:
    """Per key one of its known values: the smallest, so that a rerun gives the same."""
    return outcomes.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("outcome"))


def last_event_of(events: DataFrame, key: str, category: str, at: str, names: dict[str, str]) -> DataFrame:
    """Per key the latest time of each category, one column a category, in a single pass."""
    return events.groupBy(key).agg(*[F.max(F.when(F.col(category) == value, F.col(at))).alias(name) for name, value in names.items()])


def case_processing(images: DataFrame, outcomes: DataFrame, attached: DataFrame, cases: DataFrame, events: DataFrame, history: DataFrame, users: DataFrame, roles: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per image, attachment, case and event of finished work, with its times in New York and its seconds."""
    latest = latest_with_ties(images, ["file_name"], "load_date")
    outcome = any_outcome(outcomes, "file_name", "final_action")
    owners = history.where("field = 'Owner'").select(F.col("case_id").alias("what_id"), F.col("new_value").alias("owner_id"), F.col("created_date").alias("assigned_raw"))
    timed = as_of_latest(events, owners.withColumn("assigned_raw", as_timestamp(F.col("assigned_raw"))), ["what_id", "owner_id"], "end_at", "assigned_raw", "assigned_at")
    done = last_event_of(events, "what_id", "event_category", "end_at", {"doc_review_at": "Document Review", "auth_at": "Consumer Authentication"})
    timed = timed.join(done, "what_id", "left")
    timed = timed.withColumn("processing_seconds", seconds_between(F.col("assigned_at"), F.col("end_at")))
    for name in ("doc_review", "auth"):
        timed = timed.withColumn(f"assignment_to_{name}_seconds", seconds_between(F.col("assigned_at"), F.col(f"{name}_at")))
    rows = latest.join(outcome, "file_name", "left")
    rows = star(rows, [(attached.withColumnsRenamed({"case_id": "attached_case"}), "file_name", "name"), (cases, "attached_case", "id"), (timed.withColumnsRenamed({"id": "event_id"}), "attached_case", "what_id"), (users.withColumnsRenamed({"id": "user_id"}), "owner_id", "user_id"), (roles.withColumnsRenamed({"id": "role_id", "name": "role_name"}), "user_role_id", "role_id")])
    rows = rows.where("outcome is not null and parent_id is null and confirmation_number is not null and end_at is not null and name is not null and processing_seconds is not null")
    end = local_time(F.col("end_at"))
    group = processing_group([F.col(c) for c in ("location", "role_name", "rollup", "developer_name", "company", "department", "division")], groups)
    return rows.withColumn("end_time", end).withColumn("end_month", month_of(end)).withColumn("processing_group", group).withColumn("user_name", F.concat("first_name", F.lit(" "), "last_name"))


def exploded_numbers(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("value", F.explode_outer(F.split(column, ";")))
