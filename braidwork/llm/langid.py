r"""Language of a text by character language models, interpolated Kneser-Ney, one per language.

Words (runs of ``\p{L}`` and ``\p{M}``, lower-cased) are the models' sentences: an n-gram of characters reaches back at
most to the word's start, and the word's end is predicted like a character. All languages share one sorted array of
n-gram hashes per order; beside it stand every language's log probability and the weight it gives to the shorter context
behind that n-gram. A symbol's probability is that of its longest n-gram in the array, times the weights of the longer
contexts, exactly the interpolated model: what the array holds was interpolated when the model was made.

The models learn from a sample of training rows of at most ``sample_chars`` characters, a bound on their size too, at
any size of the table: each language gives an equal share, drawn by a hash of its rows; the rest of the sample
calibrates. Words are counted by Spark, so the driver sees the counts of the sample's words only. Scoring reads every
whole text, in one pass without a shuffle; in each batch distinct words are scored once.

The language of lowest cross-entropy per symbol is the prediction. ``score`` is the calibrated probability that it is
right: a logistic model over the total margin to the next best and over how far the cross-entropy lies above that
language's own, fitted on calibration snippets of several lengths, and on the same snippets with their own language
taken out, which no prediction can get right. Below a score of ``reject_below`` the prediction is ``rejected``.

Defined cases: a null text, or one without a letter: ``und``, score 0, rejected; no training rows at all: the same for
every text; training rows of one language only: the next best is a uniform model; a null id is hashed as an empty string;
equal cross-entropies: the first language by code point; repeated rows: each has its row; a very long text is scored
whole, in steps; empty table: empty result; further columns, whatever their names, are ignored. A language that gives
no words to the sample, or that stands behind ``most_languages`` others by characters, is not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordkernel as wk
from .common import bounded_batches, stored

ORDER = 5
LETTER = r"\p{L}"
#: The symbol at a word's start and end.
EDGE = 32
_rng = np.random.Generator(np.random.PCG64(20250311))
_PLACES = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plain_words(text: Column) -> Column:
    """Lower-case words of letters and marks, a space between two."""
    return F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}]+", " ")


def _symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of words with an edge before each and behind the last, each symbol's distance from its word's edge, and its word."""
    text = " " + b" ".join(words).decode("utf-8", "replace") + " "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(codes == EDGE)
    word = np.cumsum(codes == EDGE) - 1
    word[edges[1:]] -= 1  # an edge ends the word before it ...
    return codes, np.arange(len(codes)) - edges[word], word


def _hashes(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For n = 1, 2, ...: the hash of the n symbols that end at each place (too few symbols before it: of no meaning)."""
    raw = np.zeros(len(codes), np.uint64)
    own = codes.astype(np.uint64) + np.uint64(1)
    for n in range(1, longest + 1):
        raw[n - 1 :] += own[: len(own) - n + 1] * _PLACES[n - 1]
        yield wk.mix64(raw + np.uint64(n))


@dataclass
class Model:
    """Per order: sorted hashes, log probabilities and log weights (n-grams x languages); ``unknown``: of a symbol never seen."""

    languages: list[str]
    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    weights: list[np.ndarray]
    unknown: np.ndarray

    def log_probabilities(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithm of each word's probability by language, its end included, and its number of symbols."""
        codes, back, word = _symbols(words)
        found = np.full(len(codes), -1)
        value = np.repeat(self.unknown[None, :], len(codes), axis=0)
        for n, hashes in enumerate(_hashes(codes, len(self.hashes)), 1):
            table = self.hashes[n - 1]
            at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
            hit = table[at] == hashes
            if n == 1:
                value[hit] = self.logs[0][at[hit]]
            else:
                reach = back >= n - 1
                hit &= reach
                context = np.concatenate(([-1], found[:-1]))
                known = np.flatnonzero(reach & ~hit & (context >= 0))
                value[known] += self.weights[n - 2][context[known]]
                value[hit] = self.logs[n - 1][at[hit]]
            found = np.where(hit, at, -1)
        count = len(words)
        total = np.stack([np.bincount(word[1:], weights=value[1:, i], minlength=count) for i in range(len(self.languages))], axis=1)
        return total, np.bincount(word[1:], minlength=count)


def train(languages: list[str], words: list[bytes], language: np.ndarray, times: np.ndarray, order: int = ORDER) -> Model:
    """Interpolated Kneser-Ney over words (word, number of its language, count).

    The longest n-grams count as often as they occur; shorter ones by how many different symbols stand before them,
    save those at a word's start, before which nothing stands. The discount of an order and language is n1 / (n1 + 2 n2).
    """
    codes, back, word = _symbols(words)
    k = len(languages)
    lang, weight = language[word], times[word].astype(np.float64)
    alphabet = len(np.unique(codes)) + 1
    hashes, index, first, counts = [], [], [], []
    for n, h in enumerate(_hashes(codes, order), 1):
        valid = np.flatnonzero((back >= max(n - 1, 1)) & (np.arange(len(codes)) > 0))
        table, at, inverse = np.unique(h[valid], return_index=True, return_inverse=True)
        own = np.full(len(codes), -1)
        own[valid] = inverse
        if n == 1:  # the edge that starts a word is a context, though it is not predicted
            edge = np.searchsorted(table, h[0])
            own[(codes == EDGE) & (own < 0)] = edge if len(table) else -1
        hashes.append(table)
        index.append(own)
        first.append(valid[at])
        counts.append(np.bincount(inverse * k + lang[valid], weights=weight[valid], minlength=len(table) * k).reshape(-1, k))
    logs, weights = [], []
    lower = np.full((1, k), 1.0 / alphabet)
    for n in range(1, order + 1):
        place = first[n - 1]
        c = counts[n - 1]
        if n < order:  # how many n-grams one longer end in this one
            longer = first[n]
            before = np.zeros_like(c)
            np.add.at(before, index[n - 1][longer], counts[n] > 0)
            c = np.where((back[place] == n - 1)[:, None], c, before)
        ones, twos = (c == 1).sum(axis=0), (c == 2).sum(axis=0)
        discount = np.where(ones + twos > 0, np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95), 0.5)
        context = index[n - 2][place - 1] if n > 1 else np.zeros(len(place), int)
        size = len(hashes[n - 2]) if n > 1 else 1
        total, kinds = np.zeros((size, k)), np.zeros((size, k))
        np.add.at(total, context, c)
        np.add.at(kinds, context, c > 0)
        rest = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        shorter = lower[index[n - 2][place]] if n > 1 else np.repeat(lower, len(place), axis=0)
        p = np.maximum(c - discount, 0) / np.maximum(total[context], 1) + rest[context] * shorter
        if n > 1:
            weights.append(np.log(rest).astype(np.float32))
        else:
            unknown = np.log(rest[0] / alphabet)
        logs.append(np.log(p).astype(np.float32))
        lower = p
    return Model(languages, hashes, logs, weights, unknown)


@dataclass
class Calibration:
    """Mean and spread of a language's own cross-entropy, and the logistic model's weights."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def features(self, totals: np.ndarray, symbols: np.ndarray, uniform: float) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each row, and the logistic model's inputs."""
        n = np.maximum(symbols, 1).astype(np.float64)
        best = totals.argmax(axis=1)
        top = totals[np.arange(len(totals)), best]
        others = totals.copy()
        others[np.arange(len(totals)), best] = -np.inf
        margin = np.maximum(top - np.maximum(others.max(axis=1, initial=-np.inf), -n * uniform), 0)
        above = (-top / n - self.mean[best]) / self.spread[best] * np.sqrt(n)
        return best, np.stack([np.ones(len(n)), np.log1p(margin), np.clip(above, -10, 30) / 10, np.log(n)], axis=1)

    def scores(self, totals: np.ndarray, symbols: np.ndarray, uniform: float) -> tuple[np.ndarray, np.ndarray]:
        best, x = self.features(totals, symbols, uniform)
        return best, 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (rows * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (rows * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibrate(model: Model, totals: np.ndarray, symbols: np.ndarray, truth: np.ndarray, outside: float = 0.1) -> Calibration:
    """From snippets' totals and true languages; ``outside``: the share of texts that are in none of the languages."""
    k, n = len(model.languages), np.maximum(symbols, 1).astype(np.float64)
    own = -totals[np.arange(len(n)), truth] / n if len(n) else np.zeros(0)
    mean, spread = np.full(k, own.mean() if len(n) else 2.0), np.ones(k)
    for i in range(k):
        mine = truth == i
        if mine.sum() > 1:
            mean[i] = (own[mine] * n[mine]).sum() / n[mine].sum()
            spread[i] = max(0.05, np.sqrt((((own[mine] - mean[i]) ** 2) * n[mine]).mean()))
    found = Calibration(mean, spread, np.zeros(4))
    uniform = float(-model.unknown.max())
    best, x = found.features(totals, symbols, uniform)
    y, rows = (best == truth).astype(float), np.ones(len(n))
    if k > 1:
        without = totals.copy()
        without[np.arange(len(n)), truth] = -np.inf
        _, strange = found.features(without, symbols, uniform)
        x, y, rows = np.concatenate([x, strange]), np.concatenate([y, np.zeros(len(n))]), np.concatenate([rows, np.full(len(n), outside / (1 - outside))])
    found.weights = _logistic(x, y, rows)
    return found


def text_totals(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's log probability by language and its number of symbols; distinct words are scored once a step."""
    n, k = len(texts), len(model.languages)
    totals, symbols = np.zeros((n, k)), np.zeros(n, np.int64)
    for p in wk.parts(texts, most=1 << 21):
        _, at, inverse = np.unique(p.hash, return_index=True, return_inverse=True)
        if not len(at):
            continue
        data = p.data.tobytes()
        logs, size = model.log_probabilities([data[s:e] for s, e in zip(p.start[at].tolist(), p.end[at].tolist(), strict=True)])
        row = p.first + p.row
        for i in range(k):
            totals[:, i] += np.bincount(row, weights=logs[inverse, i], minlength=n)
        symbols += np.bincount(row, weights=size[inverse], minlength=n).astype(np.int64)
    return totals, symbols


def _sample(train_rows: DataFrame, sample_chars: int, most_languages: int) -> tuple[list[str], DataFrame | None]:
    """Languages, and stored rows (lang, words, calibrates, cut) of about ``sample_chars`` characters, an equal share a language."""
    per = train_rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"))
    known = sorted(per.orderBy(F.col("chars").desc(), "lang").limit(most_languages).collect(), key=lambda r: r["lang"])
    if not known:
        return [], None
    share, everything = sample_chars / len(known), sum(r["chars"] for r in known)
    drawn = F.pmod(F.xxhash64("text", "doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    portion = 1.0
    while True:
        # rows that are alike share a draw: where they pass the bound together, a smaller portion leaves them out together
        keep = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, share / r["chars"]) * portion)])
        rows = train_rows.where((drawn < keep[F.col("lang")]) & (F.length("text") <= int(share)))
        if everything <= sample_chars or (rows.agg(F.sum(F.length("text"))).first()[0] or 0) <= 1.5 * sample_chars:
            break
        portion /= 4
    part = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(5))
    cut = F.pmod(F.xxhash64("text", F.lit("cut")), F.lit(8))
    return [r["lang"] for r in known], stored(rows.select("lang", plain_words(F.col("text")).alias("words"), (part == 0).alias("calibrates"), cut.alias("cut")), "language-sample")


def fit(docs: DataFrame, sample_chars: int = 8_000_000, most_languages: int = 200, order: int = ORDER) -> tuple[Model, Calibration] | None:
    """Models and calibration from docs(doc_id, lang, text); None where nothing can be learned."""
    languages, rows = _sample(docs.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)), sample_chars, most_languages)
    if rows is None:
        return None
    parts = F.array_remove(F.split("words", " "), "")
    each = rows.select("lang", "calibrates", F.explode(parts).alias("word"))
    counts = each.where(~F.col("calibrates")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toArrow()
    if not counts.num_rows:  # a handful of rows: they train, and calibrate too
        rows = rows.withColumn("calibrates", F.lit(True))
        counts = each.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toArrow()
    if not counts.num_rows:
        return None
    counts = counts.sort_by([("lang", "ascending"), ("word", "ascending")])
    number = {x: i for i, x in enumerate(languages)}
    model = train(languages, [w.encode() for w in counts["word"].to_pylist()], np.array([number[x] for x in counts["lang"].to_pylist()]), counts["n"].to_numpy(), order)
    # snippets of 1, 2, 4, ... 64 words and whole texts
    cut = F.when(F.col("cut") == 7, F.col("words")).otherwise(F.array_join(F.slice(parts, F.lit(1), F.pow(F.lit(2), F.col("cut")).cast("int")), " "))
    held = rows.where("calibrates").select("lang", cut.alias("words")).orderBy("lang", "words").toArrow()
    totals, symbols = text_totals(model, held["words"].combine_chunks())
    return model, calibrate(model, totals, symbols, np.array([number[x] for x in held["lang"].to_pylist()], dtype=int))


def identify_languages(
    docs: DataFrame, folds: int = 4, held_out: int = 2, sample_chars: int = 8_000_000, most_languages: int = 200, reject_below: float = 0.5
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, cross_entropy (bits a symbol) for every row of ``docs`` (doc_id, text, lang)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == held_out
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), fold.alias("held_out"))
    fitted = fit(own.where(~F.col("held_out")), sample_chars, most_languages)
    shared = spark.sparkContext.broadcast(fitted)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            n = len(lettered)
            names, score, bits = np.full(n, "und", object), np.zeros(n), np.full(n, np.nan)
            if shared.value is not None and n:
                model, calibration = shared.value
                totals, symbols = text_totals(model, batch.column(2))
                best, p = calibration.scores(totals, symbols, float(-model.unknown.max()))
                names = np.where(lettered, np.array(model.languages, object)[best], "und")
                score = np.where(lettered, p, 0.0)
                bits = -totals[np.arange(n), best] / np.maximum(symbols, 1) / np.log(2)
            bits = pa.array(bits, mask=~lettered | np.isnan(bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(score < reject_below), bits],
                ["doc_id", "held_out", "lang_pred", "score", "rejected", "cross_entropy"],
            )

    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, cross_entropy double"
    lettered = F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    return own.select("doc_id", "held_out", plain_words(F.col("text")).alias("words"), lettered.alias("lettered")).mapInArrow(predict, schema)
