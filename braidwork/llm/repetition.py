"""Quality rules by repetition coverage.

Rolling word hashes give the n-grams of several lengths of each text; the measure is the share of a text's word
characters that lie inside n-grams (or lines) which the same text holds already further up, so that a line which
stands twice counts once. Row by row, no shuffle.

Defined cases: a null or empty text has no words, so all counts are 0 and the base rule (fewer than 50 words)
rejects it; repeated rows are judged one by one and alike; null ids pass through; extra columns, whatever their
names, are carried by ``keep_good`` and ignored by ``repetition_report``; an empty table gives an empty result.
A very long text is hashed in steps of about 0.5 MB, so memory follows its number of words only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import wordkernel as wk
from .common import bounded_batches, give_back

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, dup_gram_shares array<double>"
)
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; a text that exceeds one of them is rejected.

    gram_shares: n-gram length -> largest share of word characters inside n-grams that equal an earlier one.
    line_share: largest share of word characters inside lines equal to an earlier line.
    symbols_per_word: largest number of symbol characters per word.
    """

    min_words: int = 50
    repeat_percent: int = 50
    line_share: float = 0.30
    symbols_per_word: float = 0.10
    gram_shares: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})


def _repeated(rows: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For hashed items of rows: whether the row holds the item again, and whether it holds it earlier."""
    key = wk.mix64(value + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, earlier = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    earlier[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, earlier


def _covered(n_words: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Words that lie in one of the runs of ``k`` words from ``starts``."""
    steps = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:-1]) > 0


def _per_row(p: wk.Words, weights: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(weights, dtype=np.int64)))
    return total[p.bounds[1:]] - total[p.bounds[:-1]]


def _lines(p: wk.Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines with a word that equal an earlier one, and the word characters in them."""
    breaks = np.flatnonzero(p.data == 10)
    start = np.unique(np.concatenate((p.text_at[:-1], breaks + 1)))
    start = start[start < len(p.data)]
    if not len(start):
        return np.zeros(p.rows, np.int64), np.zeros(p.rows, np.int64)
    stop = np.concatenate((start[1:], [len(p.data)]))
    row = np.searchsorted(p.text_at, start, "right") - 1
    first = np.searchsorted(p.start, start, "left")
    last = np.searchsorted(p.start, stop, "left")
    own = first < last
    start, stop, row, first, last = (x[own] for x in (start, stop, row, first, last))
    # a line's hash: its bytes' polynomial over words and places of the words in the line
    place = np.repeat(start, last - first)
    inner = np.arange(len(place)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    at = np.repeat(first, last - first) + inner
    value = wk.mix64(p.hash[at] + (p.start[at] - place).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    edges = np.concatenate(([0], np.cumsum(last - first)))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    tail = stop - start - ((p.data[np.maximum(stop - 1, 0)] == 10) & (stop > start))
    # white space between and behind the words counts too, so it goes into the hash by kind and place
    blanks = np.flatnonzero(~wk._IS_WORD[p.data] & (p.data != 10))
    blank_value = wk.mix64(p.data[blanks].astype(np.uint64) + np.uint64(256) * (blanks - start[np.maximum(np.searchsorted(start, blanks, "right") - 1, 0)]).astype(np.uint64)) if len(start) else np.zeros(0, np.uint64)
    blank_total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(blank_value, dtype=np.uint64)))
    of_blanks = blank_total[np.searchsorted(blanks, stop)] - blank_total[np.searchsorted(blanks, start)]
    line = wk.mix64(total[edges[1:]] - total[edges[:-1]] + of_blanks * np.uint64(0xA24BAED4963EE407) + tail.astype(np.uint64))
    _, earlier = _repeated(row, line)
    in_line = np.concatenate(([0], np.cumsum(chars, dtype=np.int64)))
    found = np.bincount(row[earlier], minlength=p.rows).astype(np.int64)
    held = np.bincount(row[earlier], weights=(in_line[last] - in_line[first])[earlier], minlength=p.rows).astype(np.int64)
    return found, held


def measures(p: wk.Words, rules: Rules, verdict_only: bool = False) -> dict[str, np.ndarray]:
    """The columns of SCHEMA, without doc_id, for a part of a column; shares not needed for the verdict may be left at 0."""
    lead = (p.data & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))
    chars = points[p.end] - points[p.start]
    n_words = np.diff(p.bounds).astype(np.int64)
    word_chars = _per_row(p, chars)
    marks = np.concatenate(([0], np.cumsum(_IS_SYMBOL[p.data], dtype=np.int64)))
    n_symbols = marks[p.text_at[1:]] - marks[p.text_at[:-1]]
    n_dup_lines, line_chars = _lines(p, chars)
    g, at = wk.grams(p, 3)
    again, _ = _repeated(p.row[at], g)
    in_three = _covered(len(p.hash), at[again], 3)
    n_repeat = _per_row(p, in_three)
    base = (n_words < rules.min_words) | (100 * n_repeat > rules.repeat_percent * n_words)
    whole = np.maximum(word_chars, 1)
    line_share = line_chars / whole
    kept = ~base & (line_share <= rules.line_share) & (n_symbols <= rules.symbols_per_word * n_words)
    # A longer n-gram that is repeated consists of repeated 3-grams, so a text whose 3-gram share is within a
    # limit is within it for the longer n-grams also; where only the verdict counts, just the rest is measured.
    three = _per_row(p, np.where(in_three, chars, 0)) / whole
    shares = np.zeros((p.rows, len(rules.gram_shares)))
    for i, (k, most) in enumerate(sorted(rules.gram_shares.items())):
        if not verdict_only or k < 3 or (three > most).any():
            g, at = wk.grams(p, k)
            if verdict_only and k >= 3:
                some = (three > most)[p.row[at]]
                g, at = g[some], at[some]
            _, later = _repeated(p.row[at], g)
            shares[:, i] = _per_row(p, np.where(_covered(len(p.hash), at[later], k), chars, 0)) / whole
            kept &= shares[:, i] <= most
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "base_failed": base, "kept": kept, "dup_line_share": line_share, "dup_gram_shares": shares,
    }


def repetition_report(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its counts, coverage shares and verdict."""
    rules = rules or Rules()
    bounded_batches(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in wk.parts(batch.column(1)):
                found = measures(p, rules)
                shares = found.pop("dup_gram_shares")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(p.rows + 1, dtype=np.int32) * shares.shape[1]), pa.array(shares.ravel()))
                columns = [batch.column(0).slice(p.first, p.rows).cast(pa.int64()), *map(pa.array, found.values()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *found, "dup_gram_shares"])
        give_back()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(judge, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the rules keep."""
    rules, at = rules or Rules(), docs.columns.index("text")
    bounded_batches(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [measures(p, rules, verdict_only=True)["kept"] for p in wk.parts(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))
        give_back()

    return docs.mapInArrow(keep, docs.schema)
