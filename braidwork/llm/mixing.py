"""Mixing sources to target weights, with DataFrame functions only.

Each document gets a hash-random key. Within its source documents stand in the order of that key; the order is cut
into key ranges ("slots"), whose sums give every range its offset, so that prefix sums of word counts need no task
that holds a whole source; there are as many ranges as shuffle partitions. A source's budget is taken in that order: whole epochs first, then the head of one more
epoch, the last document of which is cut at the exact word.

Targets: the mix has ``share`` times all words; a source gets its part by weight but never more than ``most_epochs``
times its own words, and what it can't take goes to the others by weight.

Defined cases: null or empty text: size 0, takes 0; null source: a source of its own, last in the order of sources;
equal keys (repeated rows): ordered by id and size, which leaves only interchangeable rows tied; a very long text: one
size, and one use of it is cut at its word; empty table: empty result; further columns are ignored by ``mix_sources`` and
kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, n_words, shuffle_parts, stored, unused, with_row_numbers


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most_epochs: float) -> DataFrame:
    """sizes(source, source_size) -> (source, source_size, target), one row per source.

    A source is full when the level at which the others would stand reaches its cap per weight. Sources in the order
    of cap per weight: those before the level are full, the rest share what is left by weight.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.withColumn("weight", F.get(cycle, (F.row_number().over(place) - 1) % len(weights)))
        .withColumn("cap", F.col("source_size") * F.lit(float(most_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", (F.col("words") - F.col("full_before")) / (F.col("all_weight") - F.col("weight_before")))
    )
    # behind the first source that it does not fill, the level only falls
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def _mix(rows: DataFrame, weights: Sequence[float], share: float, most_epochs: float, seed: str) -> DataFrame:
    """rows(doc_id, source, text and any ids) -> all but the text, plus size, source_size, target, taken, epochs, last_words."""
    ids = [c for c in rows.columns if c != "text"]
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    slot = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * shuffle_parts(rows.sparkSession) / F.lit(1 << 32)).cast("int")
    keyed = rows.select(*ids, n_words(F.col("text")).alias("size"), key.alias("key"))
    keyed = stored(keyed.withColumn("slot", slot), "mix-sizes")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    slots = keyed.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    targets = source_targets(slots.groupBy("source").agg(F.sum("slot_size").alias("source_size")), weights, share, most_epochs)
    ahead = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.withColumn("slot_start", F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)))
    offsets = offsets.join(targets, same(offsets, targets)).select(offsets["source"].alias("o_source"), offsets["slot"].alias("o_slot"), "slot_start", "source_size", "target")
    order = ["key", "doc_id", "size", *[c for c in ids if c not in ("doc_id", "source")]]
    within = Window.partitionBy("source", "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inner_start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, placed["source"].eqNullSafe(offsets["o_source"]) & (placed["slot"] == offsets["o_slot"]))
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    start = F.col("slot_start") + F.col("inner_start")
    last = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("epochs") * F.col("source_size") - start)).cast("long")
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("last_words", last)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("last_words"))
        .select(*ids, "size", "source_size", "target", "taken", "epochs", "last_words")
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most_epochs: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, taken, epochs, last_words.

    ``taken`` = ``epochs`` whole uses plus ``last_words`` words of one more use.
    """
    return _mix(docs.select("doc_id", "source", "text"), weights, share, most_epochs, seed)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most_epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, repeated by epoch; a cut use has its first words only.

    Rows are told apart by a number that is stored with them, since two scans of one table may split it differently.
    Texts are shuffled once, to meet what is taken of them, and not sorted: the narrow side, one row a number, is the one
    that is held. Rows without a word are not part of a mix and stay as they are.
    """
    row, each, uses = (unused(n, docs) for n in ("__row", "__use", "__uses"))
    numbered = with_row_numbers(docs, row)
    plan = _mix(numbered.select("doc_id", "source", "text", F.col(row).alias("row")), weights, share, most_epochs, seed)
    plan = plan.where((F.col("taken") > 0) | (F.col("size") == 0))
    last = F.when(F.col("last_words") == F.col("size"), -1).otherwise(F.col("last_words").cast("int"))
    whole = F.array_repeat(F.lit(-1), F.when(F.col("size") == 0, 1).otherwise(F.col("epochs")).cast("int"))
    taken = plan.select(F.col("row").alias(row), F.when(F.col("last_words") > 0, F.concat(whole, F.array(last))).otherwise(whole).alias(uses))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    text = F.when(F.col(each) < 0, F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.col(each), F.lit(0))), " "))
    return numbered.join(taken.hint("shuffle_hash"), row).withColumn(each, F.explode(uses)).withColumn("text", text).select(*docs.columns)
