import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from braidwork.llm import langid

ENDINGS = {"en": ["the", "ing", "and", "tion", "ly", "er", "wh"], "de": ["sch", "ung", "keit", "der", "ü", "ein", "pf"], "ru": ["ова", "ние", "при", "ост", "ать", "но"], "ja": ["日本", "語", "です", "ます", "東京"]}


def sentence(rnd, lang, n):
    return " ".join("".join(rnd.choice(ENDINGS[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        lang = rnd.choice(list(ENDINGS))
        rows.append((i, sentence(rnd, lang, rnd.choice([3, 10, 40])), lang, "x", i))
    rows += [(600, None, "en", "a", 1), (601, "", "en", "a", 1), (602, "1234 !! ...", "de", "a", 1), (603, sentence(rnd, "en", 40_000), "en", "a", 1), (604, sentence(rnd, "de", 9), None, "a", 1)]
    rows += [(None, sentence(rnd, "en", 9), "en", "a", 1)] * 2 + [(605, "λόγος καὶ ἀλήθεια ἐν ἀρχῇ ἦν ὁ λόγος " * 4, None, "a", 1), (606, "́", "en", "a", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, words string, lettered int").repartition(4)


def test_held_out_languages(labelled):
    got = langid.identify_languages(labelled).collect()
    assert len(got) == labelled.count()
    want = {r.doc_id: r.lang for r in labelled.collect()}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 100 and sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True) for i in (600, 601, 602, 606))
    assert by_id[603].lang_pred == "en" and by_id[604].lang_pred == "de" and by_id[None].lang_pred == "en"
    assert by_id[605].rejected and sum(r.rejected for r in held) < 0.05 * len(held)
    # labels, and the texts held out, play no part in a prediction
    blind = labelled.withColumn("lang", F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(str, langid.identify_languages(blind).collect())) == sorted(map(str, got))


def by_hand(words, order):
    """Interpolated Kneser-Ney with dictionaries: words is a list of (word, count)."""
    grams = defaultdict(Counter)
    for w, n in words:
        s = " " + w + " "
        for i in range(1, len(s)):
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    grams[k][s[i - k + 1 : i + 1]] += n
    counts = {order: grams[order]}
    for k in range(1, order):
        before = Counter(g[1:] for g in grams[k + 1])
        counts[k] = {g: (grams[k][g] if g[0] == " " and k > 1 else before[g]) for g in grams[k]}
    return counts


def probability(counts, order, alphabet, context, symbol):
    p = 1.0 / alphabet
    for k in range(1, order + 1):
        if k - 1 > len(context):
            break
        here = context[len(context) - k + 1 :]
        c = counts[k]
        values = list(c.values())
        one, two = values.count(1), values.count(2)
        d = min(0.95, max(0.1, one / max(1, one + 2 * two))) if one + two else 0.5
        followers = {g[-1]: n for g, n in c.items() if g[:-1] == here}
        total = sum(followers.values())
        if total:
            p = max(followers.get(symbol, 0) - d, 0) / total + d * len([n for n in followers.values() if n]) / total * p
    return p


def test_probabilities_are_interpolated_kneser_ney():
    rnd = random.Random(2)
    words = {lang: Counter(w for _ in range(60) for w in sentence(rnd, lang, 1).split()) for lang in ("en", "de")}
    flat = [(w, i, n) for i, lang in enumerate(words) for w, n in sorted(words[lang].items())]
    model = langid.train(list(words), [w.encode() for w, _, _ in flat], np.array([i for _, i, _ in flat]), np.array([n for _, _, n in flat]), 4)
    asked = ["the", "thesch", "ung", "xq", "ü", "einy", "whly"]
    got, size = model.log_probabilities([w.encode() for w in asked])
    alphabet = len({c for w, _, _ in flat for c in w} | {" "}) + 1
    for i, lang in enumerate(words):
        counts = by_hand(list(words[lang].items()), 4)
        for w, value, n in zip(asked, got[:, i], size, strict=True):
            s = " " + w + " "
            want = sum(math.log(probability(counts, 4, alphabet, s[max(0, j - 3) : j], s[j])) for j in range(1, len(s)))
            assert value == pytest.approx(want, rel=1e-5) and n == len(w) + 1
        # what follows a context sums to one, with the symbols never seen
        seen = sorted({c for w, _, _ in flat for c in w} | {" "})
        assert sum(probability(counts, 4, alphabet, " th", c) for c in seen) + probability(counts, 4, alphabet, " th", "€") == pytest.approx(1)


def test_totals_do_not_depend_on_batches():
    rnd = random.Random(4)
    texts = [sentence(rnd, "en", 30), "", None, sentence(rnd, "de", 500)]
    model = langid.train(["de", "en"], [b"the", b"sch"], np.array([1, 0]), np.array([3, 2]), 3)
    whole, n = langid.text_totals(model, pa.array(texts))
    for i, t in enumerate(texts):
        one, m = langid.text_totals(model, pa.array([t], pa.string()))
        assert np.allclose(one[0], whole[i]) and m[0] == n[i]


def test_one_language_none_and_empty(spark, empty):
    one = spark.createDataFrame([(i, "the thing and the king", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify_languages(one).collect()} == {"en"}
    none = one.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify_languages(none).collect()} == {("und", 0.0)}
    assert langid.identify_languages(empty).count() == 0


def test_a_sample_within_its_bound(spark, labelled):
    hot = labelled.where("doc_id = 3").crossJoin(spark.range(3000)).select(*labelled.columns).unionByName(labelled)
    rows = hot.where("lang is not null and text is not null and text != ''")
    _, sample = langid._sample(rows, 20_000, 200)
    assert 0 < sample.agg(F.sum(F.length("words"))).first()[0] <= 40_000
