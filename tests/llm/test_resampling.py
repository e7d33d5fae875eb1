import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from braidwork.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(resampling.UPPER, resampling.LOWER)


def features(text):
    ws = WORDS.findall((text or "").translate(LOWER))
    return ws, [zlib.crc32(" ".join(ws[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def brute(rows, target, percent=5, least=20):
    raw, goal = Counter(b for r in rows for b in features(r[1])[1]), Counter(b for t in target for b in features(t)[1])
    s_all, t_all = sum(raw.values()), sum(goal.values())
    gain = {b: math.floor(1000 * math.log((goal[b] + 1.0) * (s_all + 10000) / ((raw[b] + 1.0) * (t_all + 10000)))) for b in raw}
    out = []
    for r in rows:
        ws, fs = features(r[1])
        weight = sum(gain[b] for b in fs)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(ws) >= least])
    ranked = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    rank = {id(o): i + 1 for i, o in enumerate(ranked[: percent * len(ranked) // 100])}
    return [(*o[:4], rank.get(id(o))) for o in out]


@pytest.fixture(scope="module")
def target(spark, rows):
    return spark.createDataFrame([(rows[54][1], "x"), ("One TWO, thrée; four_five Ünd 1984", "y"), (None, None)], "text string, bucket string")


@pytest.mark.parametrize("percent", [5, 60])
def test_as_counted_by_hand(docs, rows, target, percent):
    got = [tuple(r) for r in resampling.importance_resample(docs, target, percent).collect()]
    want = brute(rows, [r.text for r in target.collect()], percent)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_words_and_ties(spark):
    odd = ["Ab_c-D9\x00é\x7fÉtat-MAJOR\n\t日本", "", None, "___"]
    got = spark.createDataFrame([(t,) for t in odd], "text string").select(resampling.feature_words(F.col("text")).alias("w")).collect()
    assert [r.w for r in got] == [features(t)[0] for t in odd]
    same = spark.createDataFrame([(7, " ".join(map(str, range(30))))] * 40 + [(None, "few words")], "doc_id long, text string")
    found = resampling.importance_resample(same, same.limit(0).select("text"), 50).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 21))  # equal rows: each its own rank
    assert {r.rank for r in found if r.doc_id is None} == {None}


def test_a_third_of_the_rows_without_an_id(spark, rows):
    many = [(None if i % 3 == 0 else i, rows[i % 40][1]) for i in range(120)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    got = [tuple(r) for r in resampling.importance_resample(df, df.select("text").limit(5), 30).collect()]
    want = brute([(a, b) for a, b in many], [b for _, b in many[:5]], 30)
    assert sorted(r[:4] for r in got if r[0] is not None) == sorted(r[:4] for r in want if r[0] is not None)
    assert Counter((r[3], r[4] is None) for r in got) == Counter((r[3], r[4] is None) for r in want)


def test_empty(empty, docs):
    assert resampling.importance_resample(empty, docs.select("text")).count() == 0
