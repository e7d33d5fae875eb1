"""Field by field comparison of two payloads in one pass over flattened values.

Inputs are rows (pair, side, field, match_key, place, value, case_id): ``pair`` names what is compared, ``side`` is
human or ai, the rest is what ``payload.flattened`` gives. Both sides stand in one frame, so a payload is parsed once
and shuffled once, by pair (and field); keys, ranks and the outer join are windows and a grouping within that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.functions.text import last_part, renamed, same_text, under


def parts_for(rows: DataFrame, most: int) -> int | None:
    """How many partitions hold ``rows`` with at most about ``most`` in each, None if Spark's own number is enough. It
    counts the rows, so they should be stored ones."""
    n = -(-rows.count() // most)
    return n if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def both_sides(rows: DataFrame, human: str, ai: str, parts: int | None = None) -> DataFrame:
    """Flattened values of the two array columns of the same rows, tagged by side, all of a pair in one partition.

    The arrays are shuffled as they are and unfold behind that, so what follows within a pair needs no further shuffle.
    ``parts``: how many partitions, ``spark.sql.shuffle.partitions`` if not given.
    """
    rows = rows.select("pair", human, ai)
    rows = rows.repartition("pair") if parts is None else rows.repartition(parts, "pair")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(c).alias("fields")) for side, c in (("human", human), ("ai", ai))])
    return rows.select("pair", F.inline(sides)).select("pair", "side", F.inline("fields"))


def sided(human: DataFrame, ai: DataFrame) -> DataFrame:
    """Values that come as two frames, tagged by side."""
    return human.withColumn("side", F.lit("human")).unionByName(ai.withColumn("side", F.lit("ai")))


def with_mappings(rows: DataFrame, mappings: Sequence[tuple[str, str]], where: Column | None = None) -> DataFrame:
    """Rename path prefixes in the rows ``where``; values of paths that fall together follow each other, the renamed
    ones last."""
    if not mappings:
        return rows
    own = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    moved = rows.withColumn("__own", own).withColumn("__new", F.when(F.col("__own"), renamed(F.col("field"), mappings)).otherwise(F.col("field")))
    moved = moved.withColumn("__late", F.col("__new") != F.col("field"))
    keys = [c for c in ("pair", "side") if c in rows.columns]
    place = F.row_number().over(Window.partitionBy(*keys, "__new", "__own").orderBy("__late", "field", "place")) - 1
    moved = moved.withColumn("place", F.when(F.col("__own"), place).otherwise(F.col("place")).cast("int"))
    return moved.withColumn("field", F.col("__new")).select(*rows.columns)


def _overlap(a: str, b: str) -> bool:
    return a != b and (a.startswith(f"{b}.") or b.startswith(f"{a}."))


def _apart(arrays: Mapping[str, str]) -> list[dict[str, str]]:
    """Batches of arrays whose paths don't lie in each other, nor their parents' paths: one pass each."""
    batches: list[dict[str, str]] = []
    for array, parent in arrays.items():
        fits = (b for b in batches if not any(_overlap(array, x) or _overlap(parent, y) for x, y in b.items()))
        found = next(fits, None)
        if found is None:
            batches.append({array: parent})
        else:
            found[array] = parent
    return batches


def _first_under(paths: Sequence[str]) -> Column:
    """The number of the path that a field lies under; null if there is none."""
    return F.coalesce(*[F.when(under(F.col("field"), p), i) for i, p in enumerate(paths)], F.lit(None).cast("int"))


def soft_keys(rows: DataFrame, arrays: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """``rows`` plus new_key, the key of a soft array's item by both sides; null for all other rows. ``arrays`` are the
    arrays' paths with their parents', none of which lies in another.

    Within a parent, items whose key is on both sides pair up; the others pair by rank of their sorted keys, and what
    is left stands against XXX. A parent has to be there as a key of its own, on either side. Everything happens
    within a pair, in one shuffle, for all arrays at once; it sorts a partition several times, so ``parts``, the number
    of partitions, has to follow the input for a task's memory not to (``spark.sql.shuffle.partitions`` if not given).
    """
    key, parents = F.col("match_key"), list(dict.fromkeys(arrays.values()))
    which = F.when(F.instr("match_key", "-") > 0, _first_under(list(arrays)))
    of_array = F.get(F.array(*[F.lit(parents.index(p)) for p in arrays.values()]), F.col("__which"))
    role = lambda k, own, parent: F.struct(k.alias("__key"), F.lit(own).alias("__own"), parent.alias("__parent"))
    above, own = F.regexp_replace(key, "-[^-]*$", ""), role(key, True, _first_under(parents))
    roles = F.when(F.col("__which").isNotNull(), F.array(role(above, False, of_array), own)).otherwise(F.array(own))
    met = (rows.repartition("pair") if parts is None else rows.repartition(parts, "pair")).withColumn("__which", which).withColumn("__role", F.explode(roles)).select("*", "__role.*").drop("__role")
    # an item's row stands at its own key, where it may be another item's parent, and at its parent's, where it stays
    is_parent = F.col("__own") & F.col("__parent").isNotNull() & F.col("__key").isNotNull()
    met = met.withColumn("__found", F.max(is_parent).over(Window.partitionBy("pair", "__key", "__parent")))
    met = met.where(F.col("__own") == F.col("__which").isNull()).withColumn("__child", F.col("__which").isNotNull() & F.col("__found"))
    has = lambda side: F.max(F.col("__child") & (F.col("side") == side)).over(Window.partitionBy("pair", "match_key", "__which"))
    met = met.withColumn("__human", has("human")).withColumn("__ai", has("ai"))
    kind = ["pair", "__key", "__which", "__child", "__human", "__ai"]
    met = met.withColumn("__rank", F.dense_rank().over(Window.partitionBy(*kind).orderBy("match_key")))
    slot = Window.partitionBy("pair", "__key", "__which", "__child", F.col("__human") & F.col("__ai"), "__rank")
    code = lambda side: F.coalesce(last_part(F.max(F.when(F.col("side") == side, key)).over(slot)), F.lit("XXX"))
    new = F.when(F.col("__child"), F.concat_ws("-", "__key", code("ai"), code("human")))
    return met.withColumn("new_key", new).select(*rows.columns, "new_key")


def with_soft_keys(rows: DataFrame, arrays: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """The rows with their new keys, in the arrays' own paths only; arrays that lie in others come in further passes."""
    for batch in _apart(arrays):
        rows = soft_keys(rows, batch, parts).withColumn("match_key", F.coalesce("new_key", "match_key")).select(*rows.columns)
    return rows


def matched_fields(rows: DataFrame, segment_types: Mapping[str, str] | None = None) -> DataFrame:
    """pair, field_name, array_key, ordinal, human_value, ai_value, is_match, segment_type and both sides' cases.

    The ordinal counts a side's values of a field and key. Where a field has a key on either side, its values without
    one don't count. Values of one ordinal stand against each other; a side without one is null there.
    """
    order = ["match_key", "side", "place"]
    every = Window.partitionBy("pair", "field").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.withColumn("__keyed", F.max(F.col("match_key").isNotNull()).over(every)).where(~F.col("__keyed") | F.col("match_key").isNotNull())
    found = found.withColumn("ordinal", F.row_number().over(Window.partitionBy("pair", "field", "match_key", "side").orderBy("place")))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{'case' if c == 'case_id' else c}")
    met = found.groupBy("pair", "field", "match_key", "ordinal").agg(of("human", "value"), of("ai", "value"), of("human", "case_id"), of("ai", "case_id"))
    return met.select(
        "pair", F.col("field").alias("field_name"), F.col("match_key").alias("array_key"), "ordinal", "human_value", "ai_value",
        same_text(F.col("human_value"), F.col("ai_value")).alias("is_match"),
        segment_type(F.col("field"), F.col("match_key"), segment_types or {}).alias("segment_type"), "human_case", "ai_case",
    )


def is_plain(fields: Column) -> Column:
    """Whether no value of ``payload.flattened`` has a key and no path comes twice."""
    return F.forall(fields, lambda x: x["match_key"].isNull() & (x["place"] == 0))


def lined_up(human: Column, ai: Column) -> Column:
    """The values of two arrays that are plain, by path: array of struct(field, side: 0 human, 1 AI, value, case_id)."""
    side = lambda fields, n: F.transform(fields, lambda x: F.struct(x["field"].alias("field"), F.lit(n).alias("side"), x["value"].alias("value"), x["case_id"].alias("case_id")))
    return F.array_sort(F.concat(side(human, 0), side(ai, 1)))


def plain_fields(rows: DataFrame, lined: str, segment_types: Mapping[str, str] | None = None) -> DataFrame:
    """``rows`` plus field_name, array_key, human_value, ai_value, is_match, segment_type and human_case, as ``matched_fields``
    gives them, for pairs of plain arrays: each is compared within its row. ``lined``: a stored column of ``lined_up``."""
    at = lambda i: F.get(F.col(lined), i)

    def met(x: Column, i: Column) -> Column:
        both, human = at(i + 1)["field"].eqNullSafe(x["field"]), x["side"] == 0
        found = F.struct(x["field"].alias("field_name"), F.when(human, x["value"]).alias("human_value"), F.when(both, at(i + 1)["value"]).when(~human, x["value"]).alias("ai_value"), F.when(human, x["case_id"]).alias("human_case"))
        return F.when((i == 0) | (at(i - 1)["field"] != x["field"]), found)

    out = rows.select("*", F.inline(F.filter(F.transform(F.col(lined), met), lambda x: x.isNotNull())))
    key = F.lit(None).cast("string")
    return out.select("*", key.alias("array_key"), same_text(F.col("human_value"), F.col("ai_value")).alias("is_match"), segment_type(F.col("field_name"), key, segment_types or {}).alias("segment_type"))


def compared(human: DataFrame, ai: DataFrame, segment_types: Mapping[str, str] | None = None) -> DataFrame:
    """``matched_fields`` of two frames."""
    return matched_fields(sided(human, ai), segment_types)


def segment_type(path: Column, array_key: Column, labels: Mapping[str, str]) -> Column:
    """The label of the path's root, else the root; null for a scalar at the root that is in no array."""
    root = F.substring_index(path, ".", 1)
    label = root
    for name, text in labels.items():
        label = F.when(root == name, F.lit(text)).otherwise(label)
    return F.when((F.instr(path, ".") > 0) | array_key.isNotNull(), label)
