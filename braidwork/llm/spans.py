"""Substring dedup with suffix automata of reference shards.

A word goes if it lies in a run of ``window`` words whose word sequence also starts in a document with a smaller id.

A suffix automaton of everything that repeats has no size bound, so none is broadcast to all tasks. Instead:

1. Documents are dealt into blocks of bounded size by a hash of id and text. Every window has an anchor, the smallest hash among the grams
   of ``gram`` words inside it; equal windows have equal anchors. Blocks send their distinct anchors (about one in
   five words), and get back those that more than one document has.
2. For each returned anchor a block sends its distinct contexts, the words of all windows of that anchor, with the
   smallest id that has them, to the anchor's reference shard. An anchor in many blocks may have as many contexts as
   documents (a short line in different surroundings), so its windows travel one by one, each to the shard of its own
   words; equal windows still meet. A shard builds the suffix automaton of its contexts
   over words, hands the smallest id from each state up the suffix links, and streams every context through it: the
   state that stands for the last ``window`` words names the smallest document with that sequence.
3. The blocks look up their contexts again and remove the covered words: maximal spans of ``window`` words or more.

What a shard builds and streams are thus the contexts, runs of up to ``2 window - gram`` words, and not whole documents:
those would have to pass every shard's automaton. All words that any match can cover are in them.

The texts are shuffled once; all three steps read that shuffle. A block sends each anchor and context once, however
many of its documents hold it, so a passage that a third of all documents share is at most one row per block. What
blocks send is packed by block and bucket (or group), so there are never more rows than anchors or contexts.
Words are compared by 32-bit hashes inside contexts whose anchor agrees in 64 bits; a false match needs every word
hash of a run of ``window`` words to collide or agree.

Defined cases: null, empty or blank text: no words; fewer words than a window: nothing is removed; a null id counts as
larger than every id; rows that repeat an id are one document as to "smaller", and each is cleaned; further columns
pass through; an empty table gives an empty result. Memory follows a block's text (the number of blocks follows the
texts' bytes) and one text's words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordkernel as wk
from .common import bounded_batches, give_back, text_blocks, unused
from .wordkernel import U64

WINDOW, GRAM = 13, 5
GROUPS_PER_PARTITION = 2
#: Names of the columns that ``remove_repeated_spans`` adds.
RESULT = ("__n_words", "__n_removed", "__kept")
#: Reference shards of a group; a task builds one automaton after the other.
SHARDS = 16
#: An anchor in more blocks than this is split by its windows.
HOT_BLOCKS = 64
NO_ID = np.iinfo(np.int64).max
_HELD = 1 << 19


class Contexts:
    """The anchors of a part's windows: first and last window of each, its hash, and a hash of its context's words."""

    def __init__(self, p: wk.Words, window: int, gram: int):
        n = len(p.hash) - window + 1
        none = np.zeros(0, np.int64)
        self.low = self.high = none
        self.anchor = self.key = np.zeros(0, np.uint64)
        self.window = window
        if n <= 0:
            return
        value = np.full(len(p.hash), np.iinfo(np.uint64).max, np.uint64)
        g, at = wk.grams(p, gram)
        value[at] = g
        width = window - gram + 1
        least = np.lib.stride_tricks.sliding_window_view(value, width)[:n].argmin(axis=1) + np.arange(n)
        own = np.flatnonzero(p.row[:n] == p.row[window - 1 :])
        if not len(own):
            return
        least = least[own]
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        self.low, self.high = own[first], own[np.append(first[1:], len(own)) - 1]
        self.anchor = value[least[first]]
        size = len(p.hash) + 1
        up, self.down = wk._powers(size)
        self.total = np.zeros(size, np.uint64)
        np.cumsum(p.hash * up[: size - 1], out=self.total[1:])
        self.key = self.keys(self.low, self.high)

    def keys(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A hash of the words of the windows from ``low`` to ``high``."""
        end = high + self.window
        return wk.mix64((self.total[end] - self.total[low]) * self.down[low] + (end - low).astype(np.uint64))

    def single(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the contexts ``some``, each window: its place, its context, and a hash of its words."""
        n = self.high[some] - self.low[some] + 1
        at = np.repeat(self.low[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return at, np.repeat(some, n), self.keys(at, at) if len(at) else np.zeros(0, np.uint64)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1]))) if len(sorted_) else np.zeros(0, np.int64)
    return first, np.append(first[1:], len(sorted_))


class Automaton:
    """Suffix automaton of several word sequences; every state knows the smallest document with its sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [int(NO_ID)]

    def add(self, words: list[int], document: int) -> None:
        following, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for word in words:
            to = following[last].get(word)
            if to is not None and length[to] == length[last] + 1:
                if document < least[to]:
                    least[to] = document
                last = to
                continue
            if to is None:
                new = len(link)
                following.append({})
                link.append(0)
                length.append(length[last] + 1)
                least.append(document)
                at = last
                while at >= 0 and word not in following[at]:
                    following[at][word] = new
                    at = link[at]
                if at >= 0:
                    to = following[at][word]
                    link[new] = to if length[to] == length[at] + 1 else self._split(at, word, to)
                last = new
            else:
                last = self._split(last, word, to)
                if document < least[last]:
                    least[last] = document

    def _split(self, at: int, word: int, to: int) -> int:
        following, link = self.next, self.link
        copy = len(link)
        following.append(following[to].copy())
        link.append(link[to])
        self.length.append(self.length[at] + 1)
        self.least.append(int(NO_ID))
        link[to] = copy
        while at >= 0 and following[at].get(word) == to:
            following[at][word] = copy
            at = link[at]
        return copy

    def finish(self) -> None:
        """Hand the smallest documents from longer to shorter sequences."""
        link, least = self.link, self.least
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            up = link[state]
            if up >= 0 and least[state] < least[up]:
                least[up] = least[state]

    def least_documents(self, words: list[int], window: int) -> list[int]:
        """For each run of ``window`` words the smallest document that holds it; NO_ID where none does."""
        following, link, length, least = self.next, self.link, self.length, self.least
        state = matched = 0
        found = []
        for i, word in enumerate(words):
            to = following[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(word)
            if to is None:
                matched = 0
            else:
                state, matched = to, matched + 1
                while matched > window and length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
            if i >= window - 1:
                found.append(least[state] if matched >= window else int(NO_ID))
        return found


def remove_repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, names: Sequence[str] = RESULT) -> DataFrame:
    """``docs`` (doc_id, text and any others) plus three columns called ``names``: the number of words, of those removed,
    and the kept words joined by a space. The names have to be new."""
    if taken := {c.lower() for c in docs.columns} & {n.lower() for n in names}:
        raise ValueError(f"columns of these names are there already: {sorted(taken)}")
    bounded_batches(docs.sparkSession)
    columns, hot_blocks, block_name = docs.columns, HOT_BLOCKS, unused("__block", docs)
    blocks = text_blocks(docs)
    parts = max(1, blocks // 2)
    groups = GROUPS_PER_PARTITION * parts
    # ids that very many rows share, null ones too, are dealt by their texts
    dealt = docs.withColumn(block_name, F.pmod(F.xxhash64("doc_id", F.crc32("text")), F.lit(blocks)).cast("int")).repartition(parts, block_name)
    id_at, text_at, block_at = (dealt.columns.index(c) for c in ("doc_id", "text", block_name))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            anchor, doc, block = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = (wk.mix64(anchor) % U64(parts)).astype(np.int64) * blocks + block
            o = np.lexsort((doc, anchor, bucket))
            anchor, doc, bucket = anchor[o], doc[o], bucket[o]
            again = (anchor[1:] == anchor[:-1]) & (bucket[1:] == bucket[:-1])
            # of a block's equal anchors the first stays, and a second one if another document has it too
            other = np.concatenate(([False], again & (doc[1:] != doc[:-1])))
            second = other & ~np.concatenate(([False], other[:-1] & again))
            keep = np.concatenate(([True], ~again)) | second
            anchor, bucket = anchor[keep], bucket[keep]
            first, last = _runs(bucket)
            packed = pa.array([anchor[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array((bucket[first] // blocks).astype(np.int32)), pa.array((bucket[first] % blocks).astype(np.int32)), packed], names=["bucket", "block", "anchors"])

        for batch in batches:
            ids, block = _ids(batch.column(id_at)), batch.column(block_at).to_numpy()
            for p in wk.parts(batch.column(text_at)):
                c = Contexts(p, window, gram)
                row = p.row[c.low] + p.first if len(c.low) else np.zeros(0, np.int64)
                held.append((c.anchor, ids[row], block[row].astype(np.int64)))
                if sum(len(x[0]) for x in held) > _HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()
        held.clear()
        give_back()

    def shared(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in table["anchors"].to_pylist()]
        anchor = np.concatenate(lists)
        block = np.repeat(table["block"].to_numpy(), [len(x) for x in lists])
        o = np.argsort(anchor, kind="stable")
        same = anchor[o][1:] == anchor[o][:-1]
        some = o[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
        anchor, block = anchor[some], block[some]
        o = np.lexsort((anchor, block))
        o = o[np.concatenate(([True], (anchor[o][1:] != anchor[o][:-1]) | (block[o][1:] != block[o][:-1])))] if len(o) else o
        anchor, block = anchor[o], block[o]
        kinds, of, n = np.unique(anchor, return_inverse=True, return_counts=True)
        hot = (n > hot_blocks)[of].astype(np.uint8)
        first, last = _runs(block)
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())
        return pa.table({"block": pa.array(block[first], pa.int32()), "anchors": cut(anchor), "hot": cut(hot)})

    def contexts(key: tuple[pa.Scalar, ...], texts: pa.Table, found: pa.Table) -> pa.Table:
        names = {"group": pa.int32(), "block": pa.int32(), **{c: pa.binary() for c in ("keys", "shards", "docs", "sizes", "words")}}
        join = lambda c, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(x, kind) for x in found[c].to_pylist()]])
        wanted, at = np.unique(join("anchors", np.uint64), return_index=True)
        hot = join("hot", np.uint8)[at] > 0
        gathered: list[tuple[np.ndarray, ...]] = []
        for batch in texts.to_batches() if len(wanted) else []:
            ids = _ids(batch.column(id_at))
            for p in wk.parts(batch.column(text_at)):
                c = Contexts(p, window, gram)
                at = np.minimum(np.searchsorted(wanted, c.anchor), len(wanted) - 1)
                some = np.flatnonzero(wanted[at] == c.anchor)
                warm, heat = some[~hot[at[some]]], some[hot[at[some]]]
                place, of, single = c.single(heat)
                low, own = np.concatenate((c.low[warm], place)), np.concatenate((c.key[warm], single))
                size = np.concatenate((c.high[warm] - c.low[warm], np.zeros(len(place), np.int64))) + window
                # what says the shard: the anchor, of a hot one the window
                meet = np.concatenate((c.anchor[warm], single))
                doc = ids[p.row[low] + p.first]
                o = np.lexsort((doc, own))
                o = o[np.concatenate(([True], own[o][1:] != own[o][:-1]))] if len(o) else o
                low, size = low[o], size[o]
                place = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                gathered.append((own[o], meet[o], doc[o], size, (p.hash[place] >> U64(32)).astype(np.uint32)))
        if not gathered or not sum(len(x[0]) for x in gathered):
            return pa.table({c: pa.array([], k) for c, k in names.items()})
        keys, anchor, doc, size, words = (np.concatenate(x) for x in zip(*gathered, strict=True))
        del gathered
        start = np.cumsum(size) - size
        shard = (wk.mix64(anchor ^ U64(0x5DEECE66D)) % U64(groups * SHARDS)).astype(np.int32)
        o = np.lexsort((doc, keys, shard))
        o = o[np.concatenate(([True], (keys[o][1:] != keys[o][:-1]) | (shard[o][1:] != shard[o][:-1])))]
        place = np.repeat(start[o] - (np.cumsum(size[o]) - size[o]), size[o]) + np.arange(int(size[o].sum()))
        keys, doc, size, shard, words = keys[o], doc[o], size[o], shard[o], words[place]
        edges = np.concatenate(([0], np.cumsum(size)))
        first, last = _runs(shard // SHARDS)
        cut = lambda x: [x[a:b].tobytes() for a, b in zip(first, last, strict=True)]
        del texts, found
        give_back()
        columns = [(shard // SHARDS)[first], np.full(len(first), key[0].as_py(), np.int32), cut(keys), cut((shard % SHARDS).astype(np.uint8)), cut(doc), cut(size.astype(np.uint16)), [words[edges[a] : edges[b]].tobytes() for a, b in zip(first, last, strict=True)]]
        return pa.table({c: pa.array(x, k) for x, (c, k) in zip(columns, names.items(), strict=True)})

    def judge(table: pa.Table) -> pa.Table:
        column = lambda c, kind: [np.frombuffer(x, kind) for x in table[c].to_pylist()]
        lists = column("keys", np.uint64)
        kinds = (("shards", np.uint8), ("docs", np.int64), ("sizes", np.uint16), ("words", np.uint32))
        keys, (shard, docs_, size, words) = np.concatenate(lists), (np.concatenate(column(c, k)) for c, k in kinds)
        block = np.repeat(table["block"].to_numpy(), [len(x) for x in lists])
        edges = np.concatenate(([0], np.cumsum(size.astype(np.int64))))
        o = np.lexsort((docs_, keys))
        first, last = _runs(keys[o])
        distinct = o[first]
        least: list[list[int]] = [[]] * len(distinct)
        for one in np.unique(shard[distinct]).tolist():
            own = np.flatnonzero(shard[distinct] == one)
            sequences = {i: words[edges[distinct[i]] : edges[distinct[i] + 1]].tolist() for i in own.tolist()}
            automaton = Automaton()
            for i in own[np.argsort(docs_[distinct[own]], kind="stable")].tolist():
                automaton.add(sequences[i], int(docs_[distinct[i]]))
            automaton.finish()
            for i, sequence in sequences.items():
                least[i] = automaton.least_documents(sequence, window)
        # where all windows of a context have one answer, one number says it
        least = [x[:1] if min(x) == max(x) else x for x in least]
        counts = np.array([len(x) for x in least], np.uint16)
        flat = np.array([y for x in least for y in x], np.int64)
        at = np.cumsum(counts.astype(np.int64)) - counts
        of = np.empty(len(keys), np.int64)
        of[o] = np.repeat(np.arange(len(first)), last - first)
        o = np.argsort(block, kind="stable")
        starts, stops = _runs(block[o])
        del lists
        give_back()
        rows = {"block": [], "keys": [], "counts": [], "least": []}
        for a, b in zip(starts, stops, strict=True):
            own = of[o[a:b]]
            rows["block"].append(int(block[o[a]]))
            rows["keys"].append(keys[o[a:b]].tobytes())
            rows["counts"].append(counts[own].tobytes())
            rows["least"].append(np.concatenate([flat[at[i] : at[i] + counts[i]] for i in own.tolist()]).tobytes())
        return pa.table({"block": pa.array(rows["block"], pa.int32()), **{c: pa.array(rows[c], pa.binary()) for c in ("keys", "counts", "least")}})

    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, (T.LongType(), T.LongType(), T.StringType()), strict=True)]])

    def clean(key: tuple[pa.Scalar, ...], texts: pa.Table, known: pa.Table) -> pa.Table:
        join = lambda c, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(x, kind) for x in known[c].to_pylist()]])
        keys, counts, least = join("keys", np.uint64), join("counts", np.uint16).astype(np.int64), join("least", np.int64)
        at = np.cumsum(counts) - counts
        o = np.argsort(keys, kind="stable")
        keys, counts, at = keys[o], counts[o], at[o]
        n_words, n_removed, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for batch in texts.to_batches():
            ids = _ids(batch.column(id_at))
            for p in wk.parts(batch.column(text_at)):
                steps = np.zeros(len(p.hash) + 1, np.int32)
                if len(keys):
                    c = Contexts(p, window, gram)
                    here = np.minimum(np.searchsorted(keys, c.key), len(keys) - 1)
                    some = np.flatnonzero(keys[here] == c.key)
                    here, windows = here[some], (c.high - c.low + 1)[some]
                    inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
                    start = np.repeat(c.low[some], windows) + inner
                    answer = least[np.repeat(at[here], windows) + np.where(np.repeat(counts[here], windows) > 1, inner, 0)]
                    # the others may have been asked for window by window
                    rest = np.ones(len(c.key), bool)
                    rest[some] = False
                    place, _, single = c.single(np.flatnonzero(rest))
                    at_single = np.minimum(np.searchsorted(keys, single), len(keys) - 1)
                    hits = np.flatnonzero(keys[at_single] == single)
                    start, answer = np.concatenate((start, place[hits])), np.concatenate((answer, least[at[at_single[hits]]]))
                    start = start[answer < ids[p.row[start] + p.first]]
                    np.add.at(steps, start, 1)
                    np.add.at(steps, start + window, -1)
                gone = np.cumsum(steps[:-1]) > 0
                total = np.concatenate(([0], np.cumsum(gone)))
                lost = total[p.bounds[1:]] - total[p.bounds[:-1]]
                n_words.append(np.diff(p.bounds).astype(np.int64))
                n_removed.append(lost.astype(np.int64))
                for row in range(p.rows):
                    words = p.text_of(row).split()
                    if lost[row]:
                        a, b = p.bounds[row], p.bounds[row + 1]
                        words = [w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g]
                    kept.append(b" ".join(words))
        del known, keys, counts, least
        give_back()
        out = texts.select(columns)
        found = (pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_removed)), pa.array(kept, pa.binary()).cast(pa.string()))
        for name, values in zip(names, found, strict=True):
            out = out.append_column(name, values)
        return out

    sent = dealt.mapInArrow(anchors, "bucket int, block int, anchors binary")
    returned = sent.groupBy("bucket").applyInArrow(shared, "block int, anchors binary, hot binary")
    texts = dealt.groupBy(block_name)
    sent = texts.cogroup(returned.groupBy("block")).applyInArrow(contexts, "group int, block int, keys binary, shards binary, docs binary, sizes binary, words binary")
    answers = sent.groupBy("group").applyInArrow(judge, "block int, keys binary, counts binary, least binary")
    return texts.cogroup(answers.groupBy("block")).applyInArrow(clean, schema)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without repeated spans. A text that loses nothing stays as it is; one that loses all goes."""
    words, removed, kept = names = [unused(n, docs) for n in RESULT]
    found = remove_repeated_spans(docs, window, gram, names)
    found = found.where((F.col(removed) == 0) | (F.col(removed) < F.col(words)))
    return found.withColumn("text", F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col("text"))).select(*docs.columns)
