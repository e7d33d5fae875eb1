"""Migrations of the stored tables: copy, verify, swap.

A migration computes new versions of the tables it changes from the ones that count, each is written and verified on
its own, and then one record of the database's ledger names all of them, so readers see the whole change or none of it.
What fails on the way, a check above all, leaves every table as it was. Applied migrations are in the ledger, so a
second call only does what is new.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.sources.clustered import ClusteredTable, Conflict
from braidwork.sources.ledger import Ledger
from braidwork.sources.state import add_column

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Migration:
    """change: tables before -> the changed ones; must_be_none: by table, what no row of it may be; rows: tables before ->
    how many rows a changed one has to have."""

    name: str
    change: Callable[[Tables], Tables]
    must_be_none: Mapping[str, Mapping[str, Column]] = field(default_factory=dict)
    rows: Callable[[Tables], Mapping[str, int]] = lambda tables: {}


class Database:
    """Tables of a folder, each clustered by its keys, whose counting versions one ledger names together."""

    def __init__(self, spark: SparkSession, folder: str, keys: Mapping[str, Sequence[str]]):
        self.spark, self.ledger = spark, Ledger(spark, f"{folder}/_database")
        self.tables = {t: ClusteredTable(spark, f"{folder}/{t}", k) for t, k in keys.items()}

    def _last(self) -> tuple[int, dict[str, int], list[str]]:
        found = self.ledger.last()
        return (found[0], found[1]["versions"], found[1]["applied"]) if found else (-1, {}, [])

    def names(self) -> list[str]:
        return sorted(self._last()[1])

    def applied(self) -> list[str]:
        return self._last()[2]

    def read(self, table: str) -> DataFrame:
        versions = self._last()[1]
        if table not in versions:
            raise LookupError(f"no table {table}")
        return self.tables[table].read(version=versions[table])

    def load(self, frames: Tables, at: datetime) -> None:
        """First versions of tables, as they are."""
        self._swap(frames, at, Migration("load", lambda t: t), {})

    def _swap(self, changed: Tables, at: datetime, m: Migration, rows: Mapping[str, int]) -> None:
        number, versions, applied = self._last()
        wrote = {t: self.tables[t].replace(df, at, must_be_none=m.must_be_none.get(t), expected_rows=rows.get(t)) for t, df in changed.items()}
        if not self.ledger.put(number + 1, {"versions": versions | wrote, "applied": [*applied, m.name], "at": at.isoformat()}):
            raise Conflict(f"{m.name}: another driver has changed the tables")

    def migrate(self, migrations: Sequence[Migration], at: datetime) -> list[str]:
        """Apply those that have not been, in order; returns their names."""
        done = []
        for m in migrations:
            if m.name in self.applied():
                continue
            before = {t: self.read(t) for t in self.names()}
            self._swap(m.change(before), at, m, m.rows(before))
            done.append(m.name)
        return done


AI_POOL = ["image_id", "key_id", "segment", "payload", "created_at", "first_seen_at", "last_retried_at", "retry_count"]


def _is_ai() -> Column:
    return F.col("pending_type") == "ai"


def _split_ai(tables: Tables) -> Tables:
    pending = tables["pending_comparisons"]
    pool = pending.where(_is_ai()).select(AI_POOL)
    if "ai_pending_comparisons" in tables:
        pool = tables["ai_pending_comparisons"].unionByName(pool)
    rest = add_column(add_column(pending.where(~_is_ai()), "case_id", F.lit(None).cast("string")), "matched_ai_keys", F.lit(None).cast("string")).drop("matched_ai_count")
    changed = {"ai_pending_comparisons": pool, "pending_comparisons": rest}
    for name in ("comparison_results", "dead_letter_comparisons", "human_payloads"):
        if name in tables:
            changed[name] = add_column(tables[name], "case_id", F.lit(None).cast("string"))
    return changed


def _split_rows(tables: Tables) -> dict[str, int]:
    there = tables["ai_pending_comparisons"].count() if "ai_pending_comparisons" in tables else 0
    moved, all_ = tables["pending_comparisons"].agg(F.count_if(_is_ai()), F.count(F.lit(1))).first()
    return {"ai_pending_comparisons": there + moved, "pending_comparisons": all_ - moved}


def _pending(change: Callable[[DataFrame], DataFrame]) -> Callable[[Tables], Tables]:
    return lambda tables: {"pending_comparisons": change(tables["pending_comparisons"])}


def _same_rows(tables: Tables) -> dict[str, int]:
    return {"pending_comparisons": tables["pending_comparisons"].count()}


def migrations() -> list[Migration]:
    """The pool of AI payloads apart from the pending ones, the counter, the lineage set, the signature."""
    n_keys = F.coalesce(F.when(F.col("matched_ai_keys").isNotNull(), F.size(F.split("matched_ai_keys", ";"))), F.lit(0)).cast("long")
    version = lambda df: add_column(df, "comparison_version", F.coalesce(F.col("next_ai_iteration"), F.lit(0)).cast("long"))
    none_of = lambda what, condition: {"pending_comparisons": {what: condition}}
    return [
        Migration("001_split_ai_pending", _split_ai, none_of("an AI row", _is_ai()), _split_rows),
        Migration("002_next_ai_iteration", _pending(lambda df: add_column(df, "next_ai_iteration", n_keys)), none_of("no counter", F.col("next_ai_iteration").isNull()), _same_rows),
        Migration("004_merged_case_ids", _pending(lambda df: add_column(df, "merged_case_ids", F.col("case_id"))), none_of("a case without lineage", F.col("case_id").isNotNull() & F.col("merged_case_ids").isNull()), _same_rows),
        Migration(
            "005_comparison_signature", _pending(lambda df: version(add_column(df, "last_compared_signature", F.lit(None).cast("string")))), none_of("no version", F.col("comparison_version").isNull()), _same_rows
        ),
    ]
