"""Language-model scores by prediction by partial matching over bytes, with a word unigram base beside it.

Training counts cover every training text, and every edge counts, however rare. Each task counts byte n-grams
(``ORDER`` bytes of context and the next byte) of its texts with sorted arrays; a shuffle by n-gram adds the tasks'
counts. The trie never stands in one place: a score needs the contexts that end in the same two bytes, so the n-grams
are dealt by those two bytes, each part builds its own branch of the trie and scores the n-grams that occur in any
text, trained or not. Only the two lowest levels, at most 256 x 257 edges at every size of the corpus, are broadcast.
Then each block of documents asks with its own distinct n-grams and gets back their scores.

A symbol's probability starts at the longest context that the trie has: an edge of count c among edges of sum n and
number d has c / (n + d), what is left, d / (n + d), is the escape to the context that is one byte shorter, in which
the symbols of the longer context are excluded. The last level is uniform over the symbols not yet excluded. Symbols
are the 256 bytes and an end of text; contexts at a text's start are filled with a byte that UTF-8 doesn't have.

Words: their counts never meet in one place either. Texts are dealt into blocks of bounded size by a hash of id and
text; a block asks with its own distinct words, as 64-bit hashes, and gets back those counts. What blocks send is packed
by block and part, so there are never more rows than asked words or n-grams.

The n-grams of one part are those of some two-byte endings, of which each has at most 257 x 65,536 at ``ORDER`` 4.

Defined cases: a null or empty text is its end alone; a null id is hashed as an empty string; repeated rows are
learned from and scored one by one; further columns are ignored; no training text leaves the uniform model and
N = V = 0; an empty table gives an empty result. A long text is scored in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordkernel as wk
from .common import bounded_batches, stored, text_blocks
from .wordkernel import buffers, mix64

ORDER = 4
SYMBOLS = 257
#: Not in UTF-8: the filling before a text, and the end behind it.
FILL, END = 0xFE, 0xFF
PIECE = 1 << 20
#: Counted n-grams that a task holds before it merges them.
_HELD = 1 << 21
_SHIFT = np.uint64(24)


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """data starts with ``order`` bytes of context; the n-gram that ends at each further byte."""
    n = len(data) - order
    gram = np.zeros(n, dtype=np.uint64)
    for j in range(order + 1):
        gram = (gram << np.uint64(8)) | data[j : j + n].astype(np.uint64)
    return gram


def _streams(texts: pa.Array, order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes with filling and ends, row of each n-gram) in pieces of about PIECE bytes."""
    data, offsets = buffers(texts)
    n, row = len(offsets) - 1, 0
    fill, end = np.full(order, FILL, np.uint8), np.array([END], np.uint8)
    while row < n:
        stop = min(n, max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1))
        if stop == row + 1:
            whole = np.concatenate((fill, data[offsets[row] : offsets[stop]], end))
            for at in range(0, len(whole) - order, PIECE):
                part = whole[at : at + PIECE + order]
                yield row, 1, part, np.zeros(len(part) - order, np.int64)
        else:
            # one filling and one end a row; the n-grams that end in a filling belong to none
            sizes = np.diff(offsets[row : stop + 1])
            each = sizes + order + 1
            starts = np.cumsum(each) - each
            joined = np.full(int(each.sum()), FILL, np.uint8)
            rows = np.repeat(np.arange(stop - row), each)
            inner = np.arange(len(joined)) - starts[rows]
            text = (inner >= order) & (inner < order + sizes[rows])
            joined[text] = data[offsets[row] : offsets[stop]]
            joined[starts + each - 1] = END
            yield row, stop - row, joined, np.where(inner >= order, rows, -1)[order:]
        row = stop


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """The different numbers of all parts, in order."""
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(text) -> (gram, n): how often each run of ``order`` bytes and the next symbol occurs.

    With a second, boolean column, n-grams of the texts where it is true are listed but add nothing to n.
    """
    marked = len(texts.columns) > 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        listed: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, more = np.sort(np.concatenate(waiting)) if waiting else np.zeros(0, np.uint64), _distinct(listed)
            edge = np.flatnonzero(np.concatenate(([True], new[1:] != new[:-1]))) if len(new) else np.zeros(0, np.int64)
            k = np.concatenate((keys, new[edge], more))
            c = np.concatenate((counts, np.diff(np.concatenate((edge, [len(new)]))), np.zeros(len(more), np.int64)))
            o = np.argsort(k, kind="stable")
            k, c = k[o], c[o]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
            return k[first], np.add.reduceat(c, first) if len(first) else c

        for batch in batches:
            texts = batch.column(0)
            kinds = [(waiting, texts)]
            if marked:
                kinds = [(waiting, texts.filter(pc.invert(batch.column(1)))), (listed, texts.filter(batch.column(1)))]
            for into, some in kinds:
                for _, _, stream, rows in _streams(some, order):
                    into.append(_grams(stream, order)[rows >= 0])
                    if sum(map(len, waiting)) + sum(map(len, listed)) >= _HELD:
                        keys, counts = merged()
                        waiting.clear()
                        listed.clear()
        keys, counts = merged()
        for at in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 16)].astype(np.int64)), pa.array(counts[at : at + (1 << 16)])], names=["gram", "n"])

    return texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class Trie:
    """The contexts of each length with their edges, and the log10 of every step that a score takes.

    Level k holds the edges of contexts of k bytes as sorted numbers (context bytes, symbol); ``lp_first`` is an
    edge's log10 probability where its context is the longest known, ``lp_after`` where a longer context was escaped
    from depends on that context: log10(count) minus ``lp_rest`` of the longer one.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(levels) - 1
        self.edges = [k for k, _ in levels]
        self.log_count = [np.log10(np.maximum(c, 1)).astype(np.float64) for _, c in levels]
        self.contexts, self.escape_first, self.log_whole, self.escape_next, self.log_rest = [], [], [], [], []
        sums, numbers = [], []
        for keys, counts in levels:
            context = keys >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(keys) else np.zeros(0, np.int64)
            n = np.add.reduceat(counts, first).astype(np.float64) if len(first) else np.zeros(0)
            d = np.diff(np.concatenate((first, [len(keys)]))).astype(np.float64) if len(first) else np.zeros(0)
            self.contexts.append(context[first])
            sums.append(n)
            numbers.append(d)
            self.log_whole.append(np.log10(n + d) if len(n) else n)
            self.escape_first.append(np.log10(d) - self.log_whole[-1] if len(n) else n)
        for k, (keys, _) in enumerate(levels):
            # escaping from a context of level k into its suffix, where the context's own symbols are excluded
            if k == 0:
                self.log_rest.append(np.array([math.log10(max(1, SYMBOLS - len(keys)))]))
                self.escape_next.append(np.zeros(1))
                continue
            context = keys >> np.uint64(8)
            mask = np.uint64((1 << (8 * (k - 1))) - 1)
            suffix_edge = ((context & mask) << np.uint64(8)) | (keys & np.uint64(255))
            counts = levels[k - 1][1][np.searchsorted(self.edges[k - 1], suffix_edge)].astype(np.float64)
            own = np.searchsorted(self.contexts[k], context)
            held = np.bincount(own, weights=counts, minlength=len(self.contexts[k]))
            parent = np.searchsorted(self.contexts[k - 1], self.contexts[k] & mask)
            left_n, left_d = sums[k - 1][parent] - held, numbers[k - 1][parent] - numbers[k]
            with np.errstate(divide="ignore", invalid="ignore"):
                self.log_rest.append(np.where(left_d > 0, np.log10(np.maximum(left_n + left_d, 1)), 0.0))
                self.escape_next.append(np.where(left_d > 0, np.log10(np.maximum(left_d, 1)) - self.log_rest[-1], 0.0))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each (distinct, best sorted) n-gram of ``order`` + 1 symbols."""
        out = np.zeros(len(grams))
        open_, known = np.arange(len(grams)), np.zeros(len(grams), dtype=bool)
        after = np.zeros(len(grams), dtype=np.int64)
        for k in range(self.order, -1, -1):
            g = grams[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            context = g >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), max(0, len(self.contexts[k]) - 1))
            has = self.contexts[k][at] == context if len(self.contexts[k]) else np.zeros(len(g), dtype=bool)
            edge = np.minimum(np.searchsorted(self.edges[k], g), max(0, len(self.edges[k]) - 1))
            hit = self.edges[k][edge] == g if len(self.edges[k]) else np.zeros(len(g), dtype=bool)
            first = ~known[open_]
            whole = np.zeros(len(g))
            step = np.zeros(len(g))
            if len(self.contexts[k]):
                whole, step = self.log_whole[k][at], self.escape_first[k][at]
                # a branch whose n-grams are all of texts that aren't learned from has no longer contexts to escape from
                if k < self.order and len(self.contexts[k + 1]):
                    whole = np.where(first, whole, self.log_rest[k + 1][after[open_]])
                    step = np.where(first, step, self.escape_next[k + 1][after[open_]])
                out[open_[hit]] += self.log_count[k][edge[hit]] - whole[hit]
            miss = has & ~hit
            out[open_[miss]] += step[miss]
            after[open_[has]] = at[has]
            known[open_[has]] = True
            open_ = open_[~hit]
        out[open_] -= self.log_rest[0][0]
        return out


def _level(grams: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of contexts of k bytes and their counts, from the counts of longer n-grams."""
    keys, own = np.unique(grams & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, own, counts)
    return keys, sums


def low_levels(counts: DataFrame, order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels 0 and 1, which every part of the trie escapes to: at most 256 x 257 edges."""
    top = min(1, order)
    mask = (1 << (8 * (top + 1))) - 1
    rows = counts.where(F.col("n") > 0).groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    keys, n = rows["gram"].to_numpy().astype(np.uint64), rows["n"].to_numpy().astype(np.int64)
    return [_level(keys, n, k) for k in range(top + 1)]


def branch(low: list[tuple[np.ndarray, np.ndarray]], grams: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Trie:
    """The trie of n-grams with whole sets of contexts that end in the same two bytes, above the low levels of all."""
    grams, counts = grams[counts > 0], counts[counts > 0]
    return Trie([*low, *(_level(grams, counts, k) for k in range(len(low), order + 1))])


def build_trie(counts: DataFrame, order: int = ORDER) -> Trie:
    """The whole trie of n-gram counts (gram, n) in one place, for a corpus that is small enough for that."""
    rows = counts.toArrow()
    return branch(low_levels(counts, order), rows["gram"].to_numpy().astype(np.uint64), rows["n"].to_numpy().astype(np.int64), order)


def _shares(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of each n-gram where its score meets the blocks that ask for it."""
    return ((mix64(grams) >> np.uint64(11)) % np.uint64(parts)).astype(np.int32)


def gram_scores(counts: DataFrame, order: int, parts: int) -> DataFrame:
    """(gram, n) -> (part, gram, log10): the log10 probability of the last symbol of each n-gram, by part of ``_shares``."""
    low = counts.sparkSession.sparkContext.broadcast(low_levels(counts, order))

    def judge(table: pa.Table) -> pa.Table:
        grams, n = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
        at = np.argsort(grams)
        grams, n = grams[at], n[at]
        found = branch(low.value, grams, n, order).log10(grams)
        return pa.table({"part": _shares(grams, parts), "gram": grams.astype(np.int64), "log10": found})

    end = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = counts.select(F.pmod(F.xxhash64(end), F.lit(max(4 * parts, counts.count() >> 20))).cast("int").alias("end"), "gram", "n")
    return dealt.groupBy("end").applyInArrow(judge, "part int, gram long, log10 double")


def asked_grams(by_block: DataFrame, order: int, parts: int) -> DataFrame:
    """by_block(text, block and more) -> (part, block, grams): the distinct n-grams of each block, as bytes of numbers."""
    text, block = by_block.columns.index("text"), by_block.columns.index("block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name, some in seen.items():
                grams = _distinct(some)
                part = _shares(grams, parts)
                order_ = np.argsort(part, kind="stable")
                grams, part = grams[order_], part[order_]
                first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                ends = np.append(first[1:], len(part))
                blobs = [grams[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(part[first]), pa.array(np.full(len(first), name, np.int32)), pa.array(blobs, pa.binary())], names=["part", "block", "grams"])

        for batch in batches:
            blocks = batch.column(block)
            for name in pc.unique(blocks).to_pylist():
                for _, _, stream, rows in _streams(batch.column(text).filter(pc.equal(blocks, name)), order):
                    grams = np.unique(_grams(stream, order)[rows >= 0])
                    seen.setdefault(name, []).append(grams)
                    held += len(grams)
            if held > 4 * _HELD:
                seen = {name: [_distinct(some)] for name, some in seen.items()}
                held = sum(len(some[0]) for some in seen.values())
                if held > 2 * _HELD:
                    yield from out()
                    seen, held = {}, 0
        yield from out()

    return by_block.mapInArrow(ask, "part int, block int, grams binary")


def answered_grams(asked: DataFrame, scores: DataFrame) -> DataFrame:
    """(part, block, grams) and (part, gram, log10) -> (block, grams, logs), both as bytes of numbers."""

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        grams, value = known["gram"].to_numpy().astype(np.uint64), known["log10"].to_numpy()
        at = np.argsort(grams)
        grams, value = grams[at], value[at]
        logs = [value[np.searchsorted(grams, np.frombuffer(x.as_py(), np.uint64))].tobytes() for x in asks["grams"]]
        return pa.table({"block": asks["block"], "grams": asks["grams"], "logs": pa.array(logs, pa.binary())})

    return asked.groupBy("part").cogroup(scores.groupBy("part")).applyInArrow(answer, "block int, grams binary, logs binary")


def asked_words(by_block: DataFrame, parts: int) -> DataFrame:
    """by_block(text, held, block and more) -> (part, block, words, counts): the distinct words of each block, as bytes
    of hashes, and how often its training texts have them."""
    text, test, block = (by_block.columns.index(c) for c in ("text", "held", "block"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def summed(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, own = np.unique(np.concatenate([x for x, _ in some]), return_inverse=True)
            return keys, np.bincount(own, weights=np.concatenate([n for _, n in some]), minlength=len(keys)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for name, some in seen.items():
                keys, n = summed(some)
                part = _shares(keys, parts)
                order = np.argsort(part, kind="stable")
                keys, n, part = keys[order], n[order], part[order]
                first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
                ends = np.append(first[1:], len(part))
                cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(part[first]), pa.array(np.full(len(first), name, np.int32)), cut(keys), cut(n)], names=["part", "block", "words", "counts"])

        for batch in batches:
            blocks = batch.column(block)
            for name in pc.unique(blocks).to_pylist():
                own = pc.equal(blocks, name)
                train = ~batch.column(test).filter(own).to_numpy(zero_copy_only=False)
                for p in wk.parts(batch.column(text).filter(own), lower=True):
                    part = summed([(p.hash, train[p.first + p.row].astype(np.int64))])
                    seen.setdefault(name, []).append(part)
                    held += len(part[0])
            if held > _HELD:
                seen = {name: [summed(some)] for name, some in seen.items()}
                held = sum(len(some[0][0]) for some in seen.values())
                if held > _HELD // 2:
                    yield from out()
                    seen, held = {}, 0
        yield from out()

    return by_block.mapInArrow(ask, "part int, block int, words binary, counts binary")


def answered_words(asked: DataFrame) -> DataFrame:
    """(part, block, words, counts) -> (block, words, counts): counts over all blocks, of the words that have any; and
    per part a row without words, whose ``tokens`` and ``kinds`` say how many there are."""

    def answer(asks: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in asks["words"].to_pylist()]
        counts = [np.frombuffer(x, np.int64) for x in asks["counts"].to_pylist()]
        keys, own = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, own, np.concatenate(counts))
        rows: dict[str, list] = {"block": [None], "words": [None], "counts": [None], "tokens": [int(total.sum())], "kinds": [int((total > 0).sum())]}
        at = 0
        for block, some in zip(asks["block"].to_pylist(), lists, strict=True):
            n = total[own[at : at + len(some)]]
            at += len(some)
            for name, x in (("block", block), ("words", some[n > 0].tobytes()), ("counts", n[n > 0].tobytes()), ("tokens", None), ("kinds", None)):
                rows[name].append(x)
        kinds = {"block": pa.int32(), "words": pa.binary(), "counts": pa.binary(), "tokens": pa.int64(), "kinds": pa.int64()}
        return pa.table({name: pa.array(rows[name], kind) for name, kind in kinds.items()})

    return asked.groupBy("part").applyInArrow(answer, "block int, words binary, counts binary, tokens long, kinds long")


def ppm_scores(docs: DataFrame, folds: int = 7, held_out: int = 2, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (fold == held_out).alias("held"))
    grams = stored(gram_counts(own.select("text", "held"), order), "ppm-grams")
    blocks = text_blocks(own)
    parts = max(1, blocks // 2)
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", F.crc32("text")), F.lit(blocks)).cast("int"))
    by_block = dealt.repartition(parts, "block")
    words = stored(answered_words(asked_words(by_block, parts)), "ppm-words")
    answers = answered_grams(asked_grams(by_block, order, parts), gram_scores(grams, order, parts))
    known_words = words.where(F.col("block").isNotNull()).select("block", "words", "counts")
    asked = known_words.unionByName(answers, allowMissingColumns=True)
    n_ends = own.where(~F.col("held")).count()
    n_tokens, n_kinds = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    all_tokens, kinds = n_tokens + n_ends, n_kinds + (n_ends > 0)
    each = math.log10(all_tokens + 1 * (kinds + 1))

    def lists(column: pa.ChunkedArray, kind: type) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in column.to_pylist() if x is not None)])

    def score(key: tuple[pa.Scalar, ...], texts: pa.Table, known: pa.Table) -> pa.Table:
        table, at = np.unique(lists(known["words"], np.uint64), return_index=True)
        word_logs = np.log10(lists(known["counts"], np.int64)[at] + 1.0)
        all_grams, all_logs = lists(known["grams"], np.uint64), lists(known["logs"], np.float64)
        at = np.argsort(all_grams)
        all_grams, all_logs = all_grams[at], all_logs[at]
        n, hits, base, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
        for batch in texts.to_batches():
            column = batch.column("text")
            for p in wk.parts(column, lower=True):
                own, times = np.diff(p.bounds).astype(np.int64) + 1, np.zeros(p.rows, np.int64)
                total = np.zeros(p.rows)
                if len(table):
                    at = np.minimum(np.searchsorted(table, p.hash), len(table) - 1)
                    hit = np.flatnonzero(table[at] == p.hash)
                    times = np.bincount(p.row[hit], minlength=p.rows)
                    total = np.bincount(p.row[hit], weights=word_logs[at[hit]], minlength=p.rows)
                # the end is a token that every training text has
                n.append(own)
                hits.append(times + (n_ends > 0))
                base.append(total + math.log10(n_ends + 1) - own * each)
            total = np.zeros(len(column))
            for first, count, stream, of in _streams(column, order):
                grams = _grams(stream, order)[of >= 0]
                row = of[of >= 0]
                bits = max(1, int(count - 1).bit_length())
                if 8 * (order + 1) + bits <= 64:
                    keyed = np.sort(grams << np.uint64(bits) | row.astype(np.uint64))
                    edge = np.flatnonzero(np.concatenate(([True], keyed[1:] != keyed[:-1])))
                    times = np.diff(np.concatenate((edge, [len(keyed)])))
                    g, row = keyed[edge] >> np.uint64(bits), (keyed[edge] & np.uint64((1 << bits) - 1)).astype(np.int64)
                    fresh = np.concatenate(([True], g[1:] != g[:-1]))
                    value = all_logs[np.searchsorted(all_grams, g[fresh])][np.cumsum(fresh) - 1]
                else:
                    times, value = np.ones(len(grams)), all_logs[np.searchsorted(all_grams, grams)]
                total[first : first + count] += np.bincount(row, weights=times * value, minlength=count)
            scores.append(total)
        n, hits, base, scores = (np.concatenate(x) for x in (n, hits, base, scores))
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held"], "n_tokens": n, "n_known": hits.astype(np.int64),
            "train_tokens": np.full(len(n), all_tokens, np.int64), "base_score": base, "score": scores,
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_block.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(score, schema)
