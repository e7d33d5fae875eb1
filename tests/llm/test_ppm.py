import math
import zlib
from collections import Counter, defaultdict

import pytest

from braidwork.llm import ppm

from .conftest import words


def model(texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        b = [ppm.FILL] * order + list((t or "").encode()) + [ppm.END]
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[k][tuple(b[i - k : i])][b[i]] += 1
    return counts


def score(counts, text, order):
    b, total = [ppm.FILL] * order + list((text or "").encode()) + [ppm.END], 0.0
    for i in range(order, len(b)):
        excluded = set()
        for k in range(order, -1, -1):
            edges = counts[k].get(tuple(b[i - k : i]))
            if not edges:
                continue
            n, d = sum(c for s, c in edges.items() if s not in excluded), sum(s not in excluded for s in edges)
            if b[i] in edges:
                total += math.log10(edges[b[i]] / (n + d))
                break
            total += math.log10(d / (n + d)) if d else 0
            excluded |= set(edges)
        else:
            total -= math.log10(257 - len(excluded))
    return total


def test_scores(docs, rows, empty):
    got = ppm.ppm_scores(docs, order=3).collect()
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    train = [r[1] for r in rows if not held(r[0])]
    counts, c = model(train, 3), Counter(w for t in train for w in words(t, lower=True))
    n, v = sum(c.values()) + len(train), len(c) + 1
    want = Counter()
    for r in rows:
        w = words(r[1], lower=True)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        want[(r[0], held(r[0]), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6), round(score(counts, r[1], 3), 5))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5)) for r in got) == want
    assert ppm.ppm_scores(empty).count() == 0


def test_probabilities_sum_to_one(docs):
    import numpy as np

    trie = ppm.build_trie(ppm.gram_counts(docs.select("text"), 2), 2)
    for context in (b"an", b"zz", b"\xfe\xfe"):
        grams = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)], np.uint64)
        assert sum(10 ** trie.log10(grams)) == pytest.approx(256 / 257, abs=0.01) or sum(10 ** trie.log10(grams)) == pytest.approx(1, abs=0.01)


def test_no_training_text(spark):
    df = spark.createDataFrame([(i, "ab") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    got = ppm.ppm_scores(df).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.score == pytest.approx(-3 * math.log10(257)) for r in got)


def test_rare_edges_count_in_a_large_corpus(spark):
    # over 2^22 training bytes, of which one text's edges are seen once
    common, rare, copies = " ".join(f"word{i % 97} stands" for i in range(7000)), "Zyx qvjk, éwq!", 50
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2][: copies + 1]
    test = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, common) for i in ids[:-1]] + [(ids[-1], rare), (test, rare + " word5 zzqq")]
    assert copies * len(common) > 1 << 22
    counts = model([common], 4)
    for level in counts:
        for edges in level.values():
            for s in edges:
                edges[s] *= copies
    for level, more in zip(counts, model([rare], 4), strict=True):
        for context, edges in more.items():
            level[context].update(edges)
    got = {r.doc_id: r.score for r in ppm.ppm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[ids[-1]] == pytest.approx(score(counts, rare, 4)) and got[test] == pytest.approx(score(counts, rows[-1][1], 4))


def test_endings_that_only_held_out_texts_have(spark):
    # their parts of the trie have no learned n-grams, only the low levels
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    texts = {i: "".join(chr(65 + (i + j) % 26) * 3 for j in range(9)) if held(i) else "one two\nthree" for i in range(60)}
    counts = model([t for i, t in texts.items() if not held(i)], 4)
    got = {r.doc_id: r.score for r in ppm.ppm_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == pytest.approx({i: score(counts, t, 4) for i, t in texts.items()})
