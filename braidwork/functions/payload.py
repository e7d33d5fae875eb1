"""Arrow functions over JSON payload columns; the only Python in the reconciliation plans.

Built-in JSON functions rewrite numbers (1.00 becomes 1.0), and values are compared as text, so payloads are parsed
here, once a stage, in Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from braidwork.sources.ledger import shared_folder

from . import jsontree as jt
from .jsonscan import flatten_texts, lists_of
from .merging import Policy, Version, join_parts, joint_shape, merge, shape_of, tag_proofs

FIELDS = "array<struct<field:string,match_key:string,place:int,value:string,case_id:string>>"
NOTES = "array<struct<path:string,case_id:string>>"


def flattened(payload: Column, keys: Mapping[str, str]) -> Column:
    """array of (field, match_key, place, value, case_id); empty for a null, blank or malformed payload."""

    @F.arrow_udf(FIELDS)
    def run(texts: pa.Array) -> pa.Array:
        return flatten_texts(texts, keys)

    return run(payload)


def _per_text(kind: str, function):
    types = {"string": pa.string(), "array<string>": pa.list_(pa.string())}

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode("encode")  # equal texts once
        return pa.array([function(x) for x in coded.dictionary.to_pylist()], types[kind]).take(coded.indices)

    return run


def extracted(payload: Column, path: str) -> Column:
    """The value at a path like ``a.b[2].c``; null where the payload or a step misses."""
    return _per_text("string", lambda text: None if (tree := jt.try_object(text)) is None else jt.extract(tree, path))(payload)


def unwrapped(payload: Column) -> Column:
    return _per_text("string", jt.unwrap)(payload)


def top_keys(payload: Column) -> Column:
    return _per_text("array<string>", lambda text: list(jt.try_object(text) or {}))(payload)


def opened(payload: Column, wrapped: Column, image_path: str, filter_path: str | None = None) -> Column:
    """struct(payload, unwrapped where ``wrapped``; the texts at two paths of it, image and filter; its keys; where it is not
    ``wrapped``, the ``content_signature`` of an object), in one pass that parses a payload once."""

    @F.arrow_udf("payload string, image string, filter string, keys array<string>, content string")
    def run(texts: pa.Array, flags: pa.Array) -> pa.Array:
        seen: dict[tuple, tuple] = {}  # equal texts once

        def one(text, flag):
            tree = jt.try_object(text)
            if tree is None and flag:
                text = jt.unwrap(text)
                tree = jt.try_object(text)
            if tree is None:
                return text, None, None, [], None
            return text, jt.extract(tree, image_path), jt.extract(tree, filter_path) if filter_path else None, list(tree), None if flag else _signed(tree)

        out = []
        for x in zip(texts.to_pylist(), flags.to_pylist(), strict=True):
            if x not in seen:
                seen[x] = one(*x)
            out.append(seen[x])
        kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, names=["payload", "image", "filter", "keys", "content"])

    return run(payload, wrapped)


def _signed(tree: dict) -> str:
    """``content_signature`` of an object."""
    return hashlib.sha256(jt.content_text(tree).encode("utf-8", "surrogatepass")).hexdigest()


def content_signature(payload: Column) -> Column:
    """SHA-256 of the canonical JSON without provenance; of a text that is no object, the trimmed text itself."""

    def one(text):
        tree = jt.try_object(text)
        return None if tree is None else jt.content_text(tree)

    plain = _per_text("string", one)(payload)
    return F.coalesce(F.sha2(plain, 256), F.btrim(payload))


def stamped(payload: Column, case_id: Column, policies: Mapping[str, Policy], segment: Column) -> Column:
    """The payload with its fields attributed to its case; as it is where it has no case or is no object."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, cases: pa.Array, segments: pa.Array) -> pa.Array:
        def one(text, case, name):
            tree = _noted(text, case, name, policies) if case else None
            return text if tree is None else jt.dump(tree)

        return pa.array([one(*x) for x in zip(texts.to_pylist(), cases.to_pylist(), segments.to_pylist(), strict=True)], pa.string())

    return run(payload, case_id, segment)


def _noted(text: str | None, case: str | None, name: str, policies: Mapping[str, Policy]) -> dict | None:
    """The object of a text, its fields attributed to the case if there is one."""
    tree = jt.try_object(text)
    if tree is None or not case:
        return tree
    return jt.stamp(tree, case, frozenset(policies[name].atomic) if name in policies else frozenset())


def cases_taken(payload: Column) -> Column:
    """struct(payload without case notes, notes: map path -> case); a payload that has none is left as it is written."""

    @F.arrow_udf(f"payload string, notes {NOTES}")
    def run(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_taken(texts), names=["payload", "notes"])

    return run(payload)


def _taken(texts: pa.Array) -> list[pa.Array]:
    note = pa.struct([("path", pa.string()), ("case_id", pa.string())])
    payloads, paths, cases, ends = [], [], [], []
    for text in texts.to_pylist():
        tree = jt.try_object(text) if text is not None and jt.may_have_notes(text) else None
        if tree is not None:
            tree, notes = jt.take_cases(tree)
            text = jt.dump(tree)
            paths += notes.keys()
            cases += notes.values()
        payloads.append(text)
        ends.append(len(paths))
    return [pa.array(payloads, pa.string()), lists_of(ends, [paths, cases], note)]


def both_flattened(human: Column, ai: Column, keys: Mapping[str, str]) -> Column:
    """struct(notes of the human payload as in ``cases_taken``, and what is ``flattened`` of it without them and of the AI's),
    in one pass."""

    @F.arrow_udf(f"notes {NOTES}, human {FIELDS}, ai {FIELDS}")
    def run(texts: pa.Array, others: pa.Array) -> pa.Array:
        payloads, notes = _taken(texts)
        return pa.StructArray.from_arrays([notes, flatten_texts(payloads, keys), flatten_texts(others, keys)], names=["notes", "human", "ai"])

    return run(human, ai)


def folded(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], policies: Mapping[str, Policy], keep: Sequence[str] = (), hot_rows: int = 100_000, ranges: int | None = None,
    case: str | None = None, signed: bool = False, at_most: DataFrame | None = None, together: bool = False,
) -> DataFrame:
    """rows(keys, keep, segment, payload, at) -> keys, keep (of a key's first row), payload, at: each key's payloads
    merged in ``order``; one that is no object counts only if there is no other, and then the latest.

    Keys of more than ``hot_rows`` rows are cut into consecutive ranges of their order, which are merged side by side, and
    then the ranges' results in order, one record each. That gives what a merge row by row gives where ``merging.shape_of``
    says so; a hot key that is not of that kind is merged row by row after all.

    ``case``: a column whose case a row's payload is ``stamped`` with before it counts; ``signed`` adds ``content``, the
    ``content_signature`` of an object. ``at_most`` has at least as many rows of each key, and is cheaper to count.
    ``together`` says that all rows of a key already stand in one partition.
    """
    spark, columns = rows.sparkSession, [*keys, *keep]
    many_of = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows).drop("__n")
    hot = many_of(rows)
    if (at_most is not None and many_of(at_most).isEmpty()) or hot.isEmpty():
        return _folded_in_order(rows, keys, order, policies, keep, case, signed, together)
    folder = shared_folder(spark)
    hot.write.parquet(f"{folder}/hot")
    hot = spark.read.schema(hot.schema).parquet(f"{folder}/hot")

    def these(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        own = some.toDF(*[f"__k{i}" for i in range(len(keys))])
        return df.join(own, [df[k].eqNullSafe(own[f"__k{i}"]) for i, k in enumerate(keys)], how)

    needed = list(dict.fromkeys([*columns, *order, "segment", "payload", "at", *([case] if case else [])]))
    many = these(rows.select(needed), hot, "left_semi")
    many.write.parquet(f"{folder}/rows")
    many = spark.read.schema(many.schema).parquet(f"{folder}/rows")
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = _ready(many.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order), columns, case)
    _partial(ready, len(keys), policies).write.parquet(f"{folder}/ranges")
    partials = spark.read.schema(_partial_schema(ready)).parquet(f"{folder}/ranges")
    _joined(partials, keys, keep, policies, signed).write.parquet(f"{folder}/joined")
    joined = spark.read.schema(_joined(partials, keys, keep, policies, signed).schema).parquet(f"{folder}/joined")
    rest = these(many, joined.where("not __regular").select(*keys), "left_semi")
    out = _folded_in_order(these(rows, hot, "left_anti"), keys, order, policies, keep, case, signed)
    out = out.unionByName(joined.where("__regular").drop("__regular"))
    return out if joined.where("not __regular").isEmpty() else out.unionByName(_folded_in_order(rest, keys, order, policies, keep, case, signed))


def _ready(rows: DataFrame, columns: Sequence[str], case: str | None) -> DataFrame:
    return rows.select(*columns, F.col("segment").alias("__segment"), (F.col(case) if case else F.lit(None).cast("string")).alias("__case"), "payload", "at")


def _partial_schema(ready: DataFrame) -> StructType:
    own = StructType([f for f in ready.schema.fields if f.name not in ("payload", "at", "__case")])
    more = "payload string, at string, __part int, __first string, __last string, __rows long, __best string, __best_at string, __shape string"
    return StructType([*own.fields, *StructType.fromDDL(more).fields])


class _Range:
    """The merge of consecutive rows of one key, as far as it has come."""

    def __init__(self, policy: Policy):
        self.policy, self.rows, self.version, self.best = policy, 0, None, (None, None)
        self.first = self.last = None
        self.shape: dict[str, str] | None = {}

    def add(self, version: Version | None, rows: int, best: tuple, first: str | None, last: str | None, shape: dict[str, str] | None) -> None:
        if not self.rows or (best[1] or "") > (self.best[1] or ""):
            self.best = best
        self.rows += rows
        if version is None:
            return
        rises = self.version is None or (first is not None and self.last is not None and first > self.last)
        self.shape = joint_shape(self.shape, shape) if rises and last is not None else None
        self.version = version if self.version is None else merge(self.version, version, self.policy)
        self.first, self.last = (first if self.first is None else self.first), last

    def record(self) -> tuple[str | None, str | None]:
        """The key's payload and time: a single row's own text, else the merged one."""
        return (jt.dump(self.version.tree), self.version.at) if self.version is not None and self.rows > 1 else self.best


def _in_batches(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _partial(ready: DataFrame, n: int, policies: Mapping[str, Policy]) -> DataFrame:
    """A record per key and partition; times of rows that are objects, and their shape, null where a merge is not associative."""
    result = _partial_schema(ready)
    schema = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, key, head, range_, out = TaskContext.get().partitionId(), None, None, None, []

        def closed() -> tuple:
            tree = None if range_.version is None else jt.dump(range_.version.tree)
            at = None if range_.version is None else range_.version.at
            return (*head, tree, at, part, range_.first, range_.last, range_.rows, *range_.best, None if range_.shape is None else json.dumps(range_.shape))

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                name, case, text, at = row[-4:]
                if range_ is None or row[:n] != key:
                    if range_ is not None:
                        out.append(closed())
                    key, head, range_ = row[:n], row[:-3], _Range(policies.get(name, Policy()))
                tree = _noted(text, case, name, policies)
                text = jt.dump(tree) if case and tree is not None else text
                range_.add(None if tree is None else Version(tree, at), 1, (text, at), at, at, None if tree is None else shape_of(tree, range_.policy))
            if len(out) >= 1000:
                yield _in_batches(out, schema)
                out = []
        if range_ is not None:
            out.append(closed())
        if out:
            yield _in_batches(out, schema)

    return ready.mapInArrow(run, result)


def _joined(partials: DataFrame, keys: Sequence[str], keep: Sequence[str], policies: Mapping[str, Policy], signed: bool = False) -> DataFrame:
    """Ranges of a key merged in their order: at most one a partition, so a task holds few records."""
    columns, n = [*keys, *keep], len(keys)
    result = StructType([*partials.select(*columns).schema.fields, *StructType.fromDDL(f"payload string, at string{', content string' if signed else ''}, __regular boolean").fields])
    schema = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, range_, out = None, None, None, []

        def closed() -> tuple:
            text, at = range_.record()
            tree = jt.try_object(text) if signed else None
            content = (None if tree is None else _signed(tree),) if signed else ()
            return (*head, text, at, *content, range_.shape is not None)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                name, tree, at, _, first, last, rows, best, best_at, shape = row[len(columns) :]
                if range_ is None or row[:n] != key:
                    if range_ is not None:
                        out.append(closed())
                    key, head, range_ = row[:n], row[: len(columns)], _Range(policies.get(name, Policy()))
                version = None if tree is None else Version(jt.parse(tree), at)
                range_.add(version, rows, (best, best_at), first, last, None if shape is None else json.loads(shape))
            if len(out) >= 1000:
                yield _in_batches(out, schema)
                out = []
        if range_ is not None:
            out.append(closed())
        if out:
            yield _in_batches(out, schema)

    return partials.repartition(*keys).sortWithinPartitions(*keys, "__part").mapInArrow(run, result)


def _begins(keys: Sequence[pa.Array], before: list | None) -> np.ndarray:
    """Where a row's keys differ from those of the row above; ``before``: the keys above the first row, None for none."""
    out = np.zeros(len(keys[0]), bool)
    out[0] = before is None or before != [c[0].as_py() for c in keys]
    for c in keys:
        if pa.types.is_nested(c.type):
            values = c.to_pylist()
            out[1:] |= np.array([a != b for a, b in zip(values[1:], values[:-1], strict=True)], bool)
        else:
            a, b = c.slice(1), c.slice(0, len(c) - 1)
            out[1:] |= pc.coalesce(pc.not_equal(a, b), pc.not_equal(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
    return out


def _folded_in_order(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], policies: Mapping[str, Policy], keep: Sequence[str], case: str | None = None, signed: bool = False, together: bool = False
) -> DataFrame:
    """``folded`` row by row.

    A key's rows pass one after the other in a sorted partition, so a task holds one merged record, however many rows a
    key has.
    """
    columns = [*keys, *keep]
    ready = _ready((rows if together else rows.repartition(*keys)).sortWithinPartitions(*keys, *order), columns, case)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a key's own columns stay in Arrow; of the open key the first row's are held as a batch
        key, head, count, best, merged, waiting = None, None, 0, (None, None), None, None

        def closed() -> tuple:
            tree, (text, at) = None, best
            if merged is not None and count > 1:
                tree, at = merged.tree, merged.at
                text = jt.dump(tree)
            elif count == 1 and (signed or waiting[1]):
                tree = _noted(waiting[2], waiting[1], waiting[0], policies)
                text = jt.dump(tree) if waiting[1] and tree is not None else text
            return (text, at, *((None if tree is None else _signed(tree),) if signed else ()))

        def rows_of(heads: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
            made = [pa.array(c, pa.string()) for c in zip(*out, strict=True)]
            return pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip([*heads.columns, *made], schema, strict=True)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            begins = _begins(batch.columns[:n], key if count else None)
            out: list[tuple] = []
            for begun, *this in zip(begins.tolist(), *[c.to_pylist() for c in batch.columns[-4:]], strict=True):
                name, _, text, at = this
                if begun:
                    if count:
                        out.append(closed())
                    # a key's first payload is parsed when a second one comes; alone, it is the result as it is, but for notes
                    count, best, merged, waiting = 1, (text, at), None, this
                    continue
                if (at or "") > (best[1] or ""):
                    best = (text, at)
                for _, own, some, when in (waiting, this) if count == 1 else (this,):
                    if (tree := _noted(some, own, name, policies)) is not None:
                        version = Version(tree, when)
                        merged = version if merged is None else merge(merged, version, policies.get(name, Policy()))
                count += 1
            heads = batch.select(list(range(len(columns)))).take(pa.array(np.flatnonzero(begins)))
            heads = heads if head is None else pa.concat_batches([head, heads])
            head, key = heads.slice(heads.num_rows - 1), [c[-1].as_py() for c in batch.columns[:n]]
            if out:
                yield rows_of(heads.slice(0, len(out)), out)
        if count:
            yield rows_of(head, [closed()])

    result = ready.drop("__segment", "__case").schema
    if signed:
        result = StructType([*result.fields, *StructType.fromDDL("content string").fields])
    schema = to_arrow_schema(result)
    return ready.mapInArrow(run, result)


def parts_joined(parts: Column, segment: Column, segments: Mapping[str, object]) -> Column:
    """One record of an array of struct(name, payload), by the segment's sub-types; null of a null array."""

    @F.arrow_udf("string")
    def run(lists: pa.Array, names: pa.Array) -> pa.Array:
        out = []
        for items, name in zip(lists.to_pylist(), names.to_pylist(), strict=True):
            if items is None:
                out.append(None)
                continue
            own = segments[name]
            trees = {x["name"]: jt.try_object(x["payload"]) for x in items}
            trees = {k: v for k, v in trees.items() if v is not None}
            for s in own.sub_types:
                if s.name in trees and s.proofs_field and s.proofs_label:
                    trees[s.name] = tag_proofs(trees[s.name], s.proofs_field, s.proofs_label)
            if not trees:
                out.append(items[0]["payload"] if len(items) else None)
                continue
            discriminators = {s.name: s.discriminator for s in own.sub_types}
            out.append(jt.dump(join_parts(trees, discriminators, own.base, own.policy.arrays)))
        return pa.array(out, pa.string())

    return run(parts, segment)
