"""Importance resampling towards a target's distribution of hashed n-grams, with DataFrame functions only.

Words become arrays of n-grams, which are exploded; crc32 modulo names a feature's bucket. Buckets are counted over all
rows of the raw and of the target table (partial counts before the shuffle, one row a bucket after it). A bucket's gain,
the scaled logarithm of the ratio of its smoothed shares, comes back by a broadcast join: the gain table has exactly
``buckets`` rows at every size. A row's weight is the sum of its features' gains, and with a Gumbel number that is made
from its id, the highest weights are a weighted draw without replacement. Ranks come from one sort by ranges: each range
counts its rows, earlier ranges give the offset, and only a range is numbered by a window.

Features never meet by document in a shuffle before they are summed; a hot bucket or source plays no part, and equal
scores are split over ranges by a number of the row.

Defined cases: null or empty text: no features, weight 0, score from the Gumbel number alone, not eligible; a null id is
hashed as an empty string and stands behind other ids of its score; repeated rows: each takes part and may have a rank,
ties are split by a row number; a very long text is one row whose features are exploded in its task; empty target table:
gains from the smoothing alone; empty table: empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_parts, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that are in no word: all but letters and digits.
GAPS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def feature_words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of characters beyond ASCII, lower-cased in A-Z only.

    One pass maps letters and gaps, then a split at one character: as ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds
    them, but without a match object per word, which costs eight times as much.
    """
    spaced = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER + GAPS, LOWER + " " * len(GAPS))
    return F.array_remove(F.split(spaced, " "), "")


def exploded_buckets(rows: DataFrame, words: str, buckets: int, longest: int = 3) -> DataFrame:
    """A row per feature, with its ``bucket`` in place of ``words``; rows without words stay, their bucket is null."""
    keep = [c for c in rows.columns if c != words]
    shifted = [F.col(words)] + [F.slice(words, i + 1, F.greatest(F.size(words), F.lit(1))) for i in range(1, longest)]
    names = [f"w{i}" for i in range(longest)]
    zipped = F.arrays_zip(*[s.alias(n) for s, n in zip(shifted, names, strict=True)])
    each = rows.select(*keep, F.inline_outer(zipped).alias(*names))
    grams = [F.col("w0")]
    for name in names[1:]:
        grams.append(F.concat(grams[-1], F.lit(" "), F.col(name)))  # null behind the last word
    return each.select(*keep, F.explode(F.array(*grams)).alias("gram")).select(*keep, (F.crc32("gram") % buckets).cast("int").alias("bucket"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """raw(text), target(text) -> bucket, gain for every bucket from 0."""
    counted = []
    for df, name in ((raw, "s"), (target, "t")):
        each = exploded_buckets(df.select(feature_words(F.col("text")).alias("words")), "words", buckets)
        counted.append(each.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias(name)))
    every = raw.sparkSession.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(counted[0], "bucket", "left").join(counted[1], "bucket", "left").na.fill(0, ["s", "t"])
    whole = Window.partitionBy()  # over the rows of the buckets
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * (F.sum("s").over(whole).cast("double") + buckets) / ((s + 1) * (F.sum("t").over(whole).cast("double") + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long").alias("gain"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """A number of the id, floor of -1000 ln(-ln(u))."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """scored(row, doc_id, n_features, weight, score, eligible) with ``rank`` 1 to ``drawn`` of the highest scores."""
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    by_range = scored.repartitionByRange(shuffle_parts(scored.sparkSession), *order)
    ranges = stored(by_range.withColumn("part", F.spark_partition_id()), "resampling-ranges")
    sizes = ranges.groupBy("part").agg(F.count_if("eligible").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    place = F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = ranges.join(F.broadcast(offsets), "part").withColumn("place", place)
    return placed.withColumn("rank", F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place")).cast("long"))


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs`` (doc_id, text); target(text).

    ``rank`` numbers the ``percent`` per cent (rounded down) of the rows with ``least_words`` words that have the
    highest scores, and is null for the others.
    """
    gains = bucket_gains(docs, target, buckets)
    # numbers of one scan: they only tell rows apart while their features are summed
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), feature_words(F.col("text")).alias("words"))
    own = own.select("row", "doc_id", F.size("words").alias("n_words"), "words")
    valued = exploded_buckets(own, "words", buckets).join(F.broadcast(gains), "bucket", "left")
    summed = valued.groupBy("row", "doc_id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    score = (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score")
    scored = stored(summed.select("row", "doc_id", "n_features", "weight", score, (F.col("n_words") >= least_words).alias("eligible")), "resampling-scores")
    n = scored.where("eligible").count()
    return _ranked(scored, percent * n // 100).select("doc_id", "n_features", "weight", "score", "rank")
