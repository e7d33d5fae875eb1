"""N-gram Jaccard join with signature trees, exact for the threshold.

1. Texts with the same set of shingles form a class; only classes go on. A table of counters, whose size follows the
   input up to ``MOST_SLOTS``, estimates how common a shingle is.
2. A class emits its rarest shingles, so many that two sets over the threshold must share three of them; any order
   that all classes share is exact, the rare-first one keeps the meetings few. A shingle's place in its set limits the
   sizes of the sets that can link if it is among the first in common, so every class has an interval of sizes there.
   Classes whose intervals allow each other are candidates after three meetings at shingles of few classes; at a
   shingle of more classes, those whose intervals overlap are chained. Candidate components are the blocks.
3. In a block the sets hang in a tree whose nodes hold the OR of their bitmaps, their range of sizes and how many
   shingles share bits. A walk over node pairs drops those whose sizes or whose largest possible overlap rule a link
   out, and those that are connected already; what is left is intersected exactly.
   A block of more than ``BLOCK_SHINGLES`` shingles or ``BLOCK_SETS`` sets is cut into chunks: first all chunks meet
   the first one, then only those pairs of chunks meet that are not yet one component.
4. The links' components are the result. Shingles and sets are compared by 64-bit hashes.

Rows get a number that is written once, with their text, and everything joins on it or on the class. A class that very
many rows have is looked up by broadcast, which at most ``4 x`` the shuffle partitions of classes can need.

Defined cases: null, empty or blank text: no shingles, a component of its own; fewer words than a shingle: the whole
sequence is the one shingle; repeated rows and equal texts: one class; null ids: a row of its own in the result, and
not the smallest id of a component unless it has no other; further columns are ignored, whatever their names; an empty
table gives an empty result. A very long text is hashed in steps and costs memory by its number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordkernel as wk
from .common import bounded_batches, give_back, shuffle_parts, stored, unused, with_row_numbers
from .graph import components

#: Counters of how common shingles are, by the first bits of their hash: at least, at most (64 MB where they are
#: broadcast), text bytes for each, and how many of them travel together.
LEAST_SLOTS, MOST_SLOTS, SLOT_BYTES, SLICE = 1 << 20, 1 << 24, 1024, 1 << 14
#: Tables of counters that are added up in one task.
_FAN_IN = 256
#: Entries of a bucket, about; the buckets' number follows the input.
BUCKET_ENTRIES = 400_000
#: Shingles and sets of a chunk of a candidate component, about.
BLOCK_SHINGLES, BLOCK_SETS = 2_000_000, 20_000
BITS, LEAF, FAN = 1024, 32, 8
_MOST = (1 << 20) - 1
#: Beyond every size.
_ANY = np.int64(1 << 40)
#: Shingles in common that any two different sets over the threshold have among their emitted ones (with a threshold
#: of 0.67 or more; a lower one is refused), and the most classes of a shingle whose meetings are counted by pair.
MEETINGS, FEW = 3, 24


def shingle_sets(p: wk.Words, size: int) -> Iterator[np.ndarray]:
    """Per row its set of shingle hashes, sorted."""
    g, at = wk.grams(p, size)
    ends = np.searchsorted(at, p.bounds)
    for row in range(p.rows):
        a, b = int(p.bounds[row]), int(p.bounds[row + 1])
        if b - a >= size:
            yield np.unique(g[ends[row] : ends[row + 1]])
        elif b > a:
            total = np.full(1, b - a, np.uint64)
            for j in range(b - a):
                total += p.hash[a + j : a + j + 1] * wk._MULTIPLIERS[j]
            yield wk.mix64(total)
        else:
            yield np.zeros(0, np.uint64)


def set_class(s: np.ndarray) -> int:
    """A 64-bit name of the set, the same for equal sets only (but for hash collisions)."""
    parts = np.array([wk.mix64(s).sum(dtype=np.uint64), wk.mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64)
    name = wk.mix64(parts[:1] * np.uint64(0x9E3779B97F4A7C15) + parts[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(len(s)))
    return int(name.astype(np.int64)[0])


def _slot_bits(numbered: DataFrame) -> int:
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(min(MOST_SLOTS, max(LEAST_SLOTS, size // SLOT_BYTES))).bit_length() - 1


def _profile(numbered: DataFrame, size: int, bits: int) -> DataFrame:
    """row, doc_id, n, class of every row; and in further rows a task's counters: how many sets hold a shingle of a slot."""
    slots, shift = 1 << bits, np.uint64(64 - bits)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(slots, np.int32)
        names = ["row", "doc_id", "n", "class", "slice", "task", "many"]
        for batch in batches:
            for p in wk.parts(batch.column(2), lower=True):
                ns, classes, held = [], [], [np.zeros(0, np.uint64)]
                for s in shingle_sets(p, size):
                    ns.append(len(s))
                    classes.append(set_class(s) if len(s) else None)
                    held.append(s >> shift)
                held, times = np.unique(np.concatenate(held), return_counts=True)
                many[held.astype(np.int64)] += times.astype(np.int32)
                none = pa.nulls(p.rows, pa.int32()), pa.nulls(p.rows, pa.int32()), pa.nulls(p.rows, pa.binary())
                own = batch.slice(p.first, p.rows)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(ns, pa.int64()), pa.array(classes, pa.int64()), *none], names=names)
        slices = [i for i in range(slots // SLICE) if many[i * SLICE : (i + 1) * SLICE].any()]
        for at in range(0, len(slices), 64):
            some = slices[at : at + 64]
            none = [pa.nulls(len(some), pa.int64())] * 4
            task = pa.array(np.full(len(some), TaskContext.get().partitionId(), np.int32))
            packed = pa.array([many[i * SLICE : (i + 1) * SLICE].tobytes() for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([*none, pa.array(some, pa.int32()), task, packed], names=names)
        del many
        give_back()

    return numbered.mapInArrow(profile, "row long, doc_id long, n long, class long, slice int, task int, many binary")


def _rank(counters: DataFrame, bits: int) -> np.ndarray:
    """The slots' places from the rarest to the most common one; tables are added up in groups of bounded size."""

    def add(kind: type):
        def total(table: pa.Table) -> pa.Table:
            found = np.zeros(SLICE, np.int64)
            for x in table["many"]:
                found += np.frombuffer(x.as_py(), kind)
            return pa.table({"slice": table["slice"][:1], "many": pa.array([found.tobytes()], pa.binary())})

        return total

    own = counters.select("slice", F.floor(F.col("task") / _FAN_IN).alias("group"), "many")
    own = own.groupBy("slice", "group").applyInArrow(add(np.int32), "slice int, many binary")
    found = own.groupBy("slice").applyInArrow(add(np.int64), "slice int, many binary").toArrow()
    many = np.zeros(1 << bits, np.int64)
    for i, packed in zip(found["slice"].to_pylist(), found["many"], strict=True):
        many[i * SLICE : (i + 1) * SLICE] = np.frombuffer(packed.as_py(), np.int64)
    rank = np.empty(1 << bits, np.uint32)
    rank[np.argsort(many, kind="stable")] = np.arange(1 << bits, dtype=np.uint32)
    return rank


def _prefixes(numbered: DataFrame, rank: np.ndarray, bits: int, size: int, percent: int, buckets: int) -> DataFrame:
    """bucket, and as packed arrays the entries (shingle, class, set size) of each class's rarest shingles."""
    shared = numbered.sparkSession.sparkContext.broadcast(rank)
    shift, low = np.uint64(64 - bits), np.uint64((1 << (64 - bits)) - 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, met = shared.value, set()
        keys: list[np.ndarray] = []
        owners: list[tuple[int, int, int]] = []
        held = 0

        def out() -> pa.RecordBatch:
            k = np.concatenate(keys)
            of = np.array(owners, np.int64)
            owner = np.repeat(np.arange(len(of)), of[:, 2])
            place = np.arange(len(k)) - np.repeat(np.cumsum(of[:, 2]) - of[:, 2], of[:, 2])
            bucket = (wk.mix64(k) % np.uint64(buckets)).astype(np.int32)
            o = np.argsort(bucket, kind="stable")
            k, owner, bucket, place = k[o], owner[o], bucket[o], place[o]
            first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            last = np.append(first[1:], len(k))
            classes, sizes = of[owner, 0], pack_size(of[owner, 1], place)
            packed = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), packed(k), packed(classes), packed(sizes)], names=["bucket", "shingles", "classes", "sizes"])

        for batch in batches:
            for p in wk.parts(batch.column(0), lower=True):
                for s in shingle_sets(p, size):
                    if not len(s) or (name := set_class(s)) in met:
                        continue
                    met.add(name)
                    key = (order[(s >> shift).astype(np.int64)].astype(np.uint64) << shift) | (s & low)
                    take = min(len(s), len(s) + percent * -len(s) // 100 + MEETINGS)
                    keys.append(np.sort(key)[:take])
                    owners.append((name, len(s), take))
                    held += take
                if held >= 1 << 19:
                    yield out()
                    keys, owners, held = [], [], 0
        if keys:
            yield out()
        keys, owners = [], []
        met.clear()
        give_back()

    return numbered.select("text").mapInArrow(emit, "bucket int, shingles binary, classes binary, sizes binary")


def pack_size(n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A set's size (20 bits, larger ones as the largest number) and how far into its order a shingle stands (4096ths)."""
    return (np.minimum(n, _MOST).astype(np.uint32) << np.uint32(12)) | (place * 4096 // n).astype(np.uint32)


def unpack_size(packed: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The size, and the largest size of another set that can link if this shingle is one of the first in common.

    Of the set only the shingles from this one on, and fewer than MEETINGS before it, can be common, so their number
    limits the overlap; it has to be percent / (100 + percent) of both sizes.
    """
    n = (packed >> np.uint32(12)).astype(np.int64)
    left = n - ((packed & np.uint32(4095)).astype(np.int64) * n >> 12) + MEETINGS - 1
    reach = np.minimum(((100 + percent) * left - percent * n) // percent, 100 * n // percent)
    return n, np.where(n >= _MOST, _ANY - 1, np.maximum(reach, 0))


def chained(group: np.ndarray, n: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (places) that connect, within each group, all entries of which each one's reach covers the other's size.

    Entries stand in the order of group and size. Of two such entries the smaller one reaches over its own size; those
    that do are intervals, and an interval joins the farthest one before it if that covers its size. An entry that
    doesn't reach its own size joins the farthest interval among the sizes it reaches, if that covers it. One edge an
    entry at most, whatever the number of pairs.
    """
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(len(group))
    is_open = reach >= n
    far = group * _ANY + np.where(is_open, reach, 0)
    farthest = np.maximum.accumulate(np.where(far == np.maximum.accumulate(far), place, 0))
    # the last entry before, or among the sizes that a shorter reach covers
    before = np.where(is_open, place - 1, np.searchsorted(group * _ANY + n, group * _ANY + np.minimum(n, reach), "right") - 1)
    to = farthest[np.maximum(before, 0)]
    joins = (before >= 0) & (group[to] == group) & is_open[to] & (reach[to] >= n) & (to != place)
    return to[joins], place[joins]


def _meetings(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): candidates for a link, or at least a chain of candidates between any two that link."""

    def meet(table: pa.Table) -> pa.Table:
        join = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
        key, name, packed = join("shingles", np.uint64), join("classes", np.int64), join("sizes", np.uint32)
        o = np.argsort(key, kind="stable")
        same = key[o][1:] == key[o][:-1]
        some = o[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
        some = some[np.lexsort((name[some], packed[some], key[some]))]
        key, name, (n, reach) = key[some], name[some], unpack_size(packed[some], percent)
        once = np.concatenate(([True], (key[1:] != key[:-1]) | (name[1:] != name[:-1]))) if len(key) else np.zeros(0, bool)
        key, name, n, reach = key[once], name[once], n[once], reach[once]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, np.int64)
        group = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        few = (np.diff(edge) <= FEW)[group]
        a, b, times = [], [], []
        for step in range(1, FEW):
            pick = np.flatnonzero((group[step:] == group[:-step]) & few[step:] & (n[step:] <= reach[:-step]) & (n[:-step] <= reach[step:]))
            a.append(np.minimum(name[pick], name[pick + step]))
            b.append(np.maximum(name[pick], name[pick + step]))
            times.append(np.ones(len(pick), np.int64))
        many = np.flatnonzero(~few)
        x, y = (name[many[i]] for i in chained(group[many], n[many], reach[many]))
        a.append(np.minimum(x, y))
        b.append(np.maximum(x, y))
        times.append(np.full(len(x), MEETINGS, np.int64))
        a, b, times = np.concatenate(a), np.concatenate(b), np.concatenate(times)
        o = np.lexsort((b, a))
        a, b, times = a[o], b[o], times[o]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
        total = np.add.reduceat(times, first) if len(first) else times
        found = pa.table({"a": a[first], "b": b[first], "times": total.astype(np.int64)})
        del join, key, name, packed, n, reach, a, b, times, table
        give_back()
        return found

    met = entries.groupBy("bucket").applyInArrow(meet, "a long, b long, times long")
    return met.groupBy("a", "b").agg(F.sum("times").alias("times")).where(F.col("times") >= MEETINGS).select("a", "b")


def tree_links(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> np.ndarray:
    """Labels after all sets that link have become one; sets that have one label already needn't be compared."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    lowest = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
    order = np.lexsort((sizes, lowest, (np.log(np.maximum(sizes, 1)) / np.log(1.15)).astype(np.int64)))
    sets, sizes = [sets[i] for i in order], sizes[order]
    # sets of one label are a group; a smaller group moves to the larger one
    names, label = np.unique(labels[order], return_inverse=True)
    members = [[] for _ in names]
    for i, own in enumerate(label.tolist()):
        members[own].append(i)
    at = np.concatenate(([0], np.cumsum(sizes)))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
    words = np.empty((m, BITS // 64), np.uint64)
    slack = np.empty(m, np.int64)
    for lo in range(0, m, 1024):
        hi = min(m, lo + 1024)
        bitmap = np.zeros((hi - lo, BITS), dtype=bool)
        bitmap[np.repeat(np.arange(hi - lo), sizes[lo:hi]), (np.concatenate(sets[lo:hi]) & np.uint64(BITS - 1)).astype(np.int64)] = True
        words[lo:hi] = np.packbits(bitmap, axis=1).view(np.uint64)
        slack[lo:hi] = sizes[lo:hi] - bitmap.sum(axis=1)

    def merge(a: int, b: int) -> None:
        x, y = int(label[a]), int(label[b])
        if len(members[x]) < len(members[y]):
            x, y = y, x
        label[members[y]] = x
        members[x].extend(members[y])
        members[y] = []
        names[x] = min(names[x], names[y])

    def compare(a: int, lo: int, hi: int) -> None:
        """Set a with the sets lo to hi - 1, exactly."""
        own = ids[at[a] : at[a + 1]]
        member[own] = True
        both = np.add.reduceat(member[ids[at[lo] : at[hi]]].astype(np.int64), at[lo:hi] - at[lo])
        member[own] = False
        for b in np.flatnonzero((100 * both >= percent * (sizes[a] + sizes[lo:hi] - both)) & (label[lo:hi] != label[a])).tolist():
            if label[a] != label[lo + b]:
                merge(a, lo + b)

    for i in range(m - 1):
        if label[i] != label[i + 1]:
            compare(i, i + 1, i + 2)
    # levels: (first set of each node, OR, smallest size, largest size, largest slack)
    levels, width = [], LEAF
    start = np.arange(0, m, width)
    levels.append((start, np.bitwise_or.reduceat(words, start, axis=0), np.minimum.reduceat(sizes, start), np.maximum.reduceat(sizes, start), np.maximum.reduceat(slack, start)))
    while len(start) > 1:
        group = np.arange(0, len(start), FAN)
        _, bits, least, most, spare = levels[-1]
        start = start[group]
        levels.append((start, np.bitwise_or.reduceat(bits, group, axis=0), np.minimum.reduceat(least, group), np.maximum.reduceat(most, group), np.maximum.reduceat(spare, group)))

    def possible(xs: tuple, ys: tuple) -> np.ndarray:
        """Which pairs of the nodes xs and ys may hold a link; each is (OR, smallest, largest, slack)."""
        common = np.bitwise_count(xs[0][:, None, :] & ys[0][None, :, :]).sum(axis=2, dtype=np.int64)
        most = common + np.minimum(xs[3][:, None], ys[3][None, :])
        fits = (100 * xs[2][:, None] >= percent * ys[1][None, :]) & (100 * ys[2][None, :] >= percent * xs[1][:, None])
        return fits & ((100 + percent) * most >= percent * (xs[1][:, None] + ys[1][None, :]))

    def span(level: int, i: int) -> tuple[int, int]:
        start = levels[level][0]
        return int(start[i]), int(start[i + 1]) if i + 1 < len(start) else m

    def joined(level: int, i: int, j: int) -> bool:
        (a, b), (c, d) = span(level, i), span(level, j)
        first = label[a]
        return bool((label[a:b] == first).all() and (i == j or (label[c:d] == first).all()))

    todo = [(len(levels) - 1, 0, 0)]
    while todo:
        level, i, j = todo.pop()
        if joined(level, i, j):
            continue
        if level:
            kids = lambda n: slice(n * FAN, min((n + 1) * FAN, len(levels[level - 1][0])))  # noqa: B023, E731
            a, b = kids(i), kids(j)
            may = possible(tuple(x[a] for x in levels[level - 1][1:]), tuple(x[b] for x in levels[level - 1][1:]))
            todo += [(level - 1, a.start + x, b.start + y) for x, y in zip(*np.nonzero(may), strict=True) if i != j or x <= y]
        else:
            (a, b), (c, d) = span(0, i), span(0, j)
            may = possible((words[a:b], sizes[a:b], sizes[a:b], slack[a:b]), (words[c:d], sizes[c:d], sizes[c:d], slack[c:d]))
            may &= label[a:b, None] != label[None, c:d]
            for x in np.flatnonzero(may.any(axis=1)):
                if (may[x] & (label[c:d] != label[a + x])).any():
                    compare(a + int(x), c, d)
    out = np.empty(m, np.int64)
    out[order] = names[label]
    return out


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """rows(block, root, class, label, shingles) -> (a, b): label of a class, and a smaller one it is linked with."""

    def link(table: pa.Table) -> pa.Table:
        root, name, label = (table[c].to_numpy() for c in ("root", "class", "label"))
        shingles = table["shingles"]
        order = np.lexsort((name, root))
        edge = np.flatnonzero(np.concatenate(([True], root[order][1:] != root[order][:-1])))
        before, after = [], []
        for lo, hi in zip(edge, np.append(edge[1:], len(order)), strict=True):
            own = order[lo:hi]
            own = own[np.concatenate(([True], name[own][1:] != name[own][:-1]))]
            if len(own) > 1:
                sets = [np.frombuffer(shingles[int(i)].as_py(), np.uint64) for i in own]
                now = tree_links(sets, label[own], percent)
                moved = now != label[own]
                before.append(label[own][moved])
                after.append(now[moved])
        none = np.zeros(0, np.int64)
        del table, shingles
        give_back()
        return pa.table({"a": np.concatenate([none, *before]), "b": np.concatenate([none, *after])})

    return rows.groupBy("block").applyInArrow(link, "a long, b long").distinct()


def _groups(numbered: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """numbered(row, doc_id, text), a stored table -> rows(row, doc_id, n, class), and per class of any text
    (class, many, first): how many rows have it, and the first row (none, doc_id, row) of its component."""
    if 3 * percent < 200:
        raise ValueError("the threshold has to be 67 percent or more")
    spark = numbered.sparkSession
    bounded_batches(spark)
    bits = _slot_bits(numbered)
    profile = stored(_profile(numbered, size, bits), "shingle-profile")
    rows = profile.where(F.col("slice").isNull()).select("row", "doc_id", "n", "class")
    rank = _rank(profile.where(F.col("slice").isNotNull()), bits)
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_parts(spark), -(-total * (100 - percent) // (100 * BUCKET_ENTRIES)))
    meetings = _meetings(_prefixes(numbered, rank, bits, size, percent, buckets), percent)
    candidates = components(meetings.select("a", "b"))

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(first, F.max("n").alias("n"), F.count(F.lit(1)).alias("many"))
    classes = stored(classes, "classes")
    named = classes.join(candidates.select(F.col("node").alias("class"), "root"), "class")
    named = stored(named.select(F.col("first.row").alias("first_row"), F.col("class").alias("wanted"), "root", "n"), "candidates")
    loads = named.groupBy("root").agg(F.sum("n").alias("load"), F.count(F.lit(1)).alias("sets"))
    chunked = loads.select("root", F.ceil(F.greatest(F.col("load") / BLOCK_SHINGLES, F.col("sets") / BLOCK_SETS)).cast("int").alias("chunks"))
    blocks = max(1, (named.agg(F.sum("n")).first()[0] or 0) // (BLOCK_SHINGLES // 2))
    named = named.join(chunked, "root")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in wk.parts(batch.column(0), lower=True):
                part = batch.slice(p.first, p.rows)
                sets = pa.array([s.tobytes() for s in shingle_sets(p, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), sets], names=["class", "root", "chunks", "shingles"])
        give_back()

    # one plan at every size: the candidates grow with the input, so they are not broadcast while they happen to be few;
    # their narrow rows are held by partition, and the texts pass unsorted
    texts = numbered.join(named.hint("shuffle_hash"), numbered["row"] == named["first_row"]).select("text", "wanted", "root", "chunks")
    sets = texts.mapInArrow(read, "class long, root long, chunks int, shingles binary")
    chunk = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    # a whole component, or chunk by chunk together with the first chunk
    others = F.when(F.col("chunks") == 1, F.array(F.pmod(F.xxhash64("root"), F.lit(blocks)))).otherwise(
        F.transform(
            F.when(F.col("chunk") == 0, F.sequence(F.lit(1), F.greatest(F.col("chunks") - 1, F.lit(1)))).otherwise(F.array("chunk")),
            lambda j: F.lit(-1) - F.abs(F.xxhash64("root", j) % F.lit(1 << 62)),
        )
    )
    met = sets.withColumn("chunk", chunk).withColumn("block", F.explode(others)).withColumn("label", F.col("class"))
    links = stored(_block_links(met.select("block", "root", "class", "label", "shingles"), percent), "links")
    if not chunked.where(F.col("chunks") > 2).isEmpty():
        labels = components(links)
        split = sets.where(F.col("chunks") > 2).withColumn("chunk", chunk)
        split = split.join(labels.select(F.col("node").alias("class"), F.col("root").alias("known")), "class", "left")
        split = stored(split.withColumn("label", F.coalesce("known", "class")).drop("known"), "chunks")
        held = split.groupBy("root", "chunk").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        left, right = held.where(F.col("chunk") > 0), held.where(F.col("chunk") > 0).select("root", *[F.col(c).alias(f"{c}2") for c in ("chunk", "low", "high")])
        pairs = left.join(right, "root").where((F.col("chunk") < F.col("chunk2")) & (F.least("low", "low2") != F.greatest("high", "high2")))
        pairs = pairs.select("root", F.xxhash64("root", "chunk", "chunk2").alias("block"), F.explode(F.array("chunk", "chunk2")).alias("chunk"))
        more = _block_links(split.join(pairs, ["root", "chunk"]).select("block", "root", "class", "label", "shingles"), percent)
        links = stored(links.union(more), "links")
    found = components(links).select(F.col("node").alias("class"), F.col("root").alias("found"))
    grouped = stored(classes.join(found, "class", "left").select("class", "many", F.col("first").alias("own"), F.coalesce("found", "class").alias("group")), "grouped")
    # pre-aggregated, and stored so that the join has shuffles of its own, whose hot groups adaptive execution can split
    smallest = stored(grouped.groupBy("group").agg(F.min("own").alias("first")), "smallest")
    return rows, grouped.join(smallest, "group").select("class", "many", "first")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    numbered = with_row_numbers(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "row")
    rows, classes = _groups(numbered.select("row", "doc_id", "text"), size, percent)
    classes = stored(classes.select("class", "many", F.col("first.doc_id").alias("smallest")), "components")
    # classes of so many rows that they would be uneven in a shuffle; there can't be more of them than the divisor says
    hot = 4 * shuffle_parts(docs.sparkSession)
    common = F.broadcast(classes.where(F.col("many") * hot > rows.count()).select("class", "smallest"))
    alone, others = rows.where(F.col("class").isNull()), rows.where(F.col("class").isNotNull())
    rare = others.join(common, "class", "left_anti").join(classes.select("class", "smallest"), "class")
    found = others.join(common, "class").unionByName(rare).unionByName(alone.withColumn("smallest", F.col("doc_id")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that link, directly or not, with a kept one.

    Of a component the row with the smallest doc_id stays (null ids last, then the first in the table). Texts without
    a word link with nothing and stay.
    """
    number = unused("row", docs)
    numbered = with_row_numbers(docs, number)
    own = numbered.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, classes = _groups(own, size, percent)
    kept = classes.select(F.col("first.row").alias(number)).distinct().union(rows.where(F.col("class").isNull()).select("row"))
    return numbered.join(stored(kept, "kept").hint("shuffle_hash"), number, "left_semi").select(*docs.columns)
