from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidwork.llm import spans

from .conftest import words


def cleaned(rows, k=13):
    first = {}
    for r in rows:
        w, d = words(r[1]), float("inf") if r[0] is None else r[0]
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            first[g] = min(first.get(g, d), d)
    out = Counter()
    for r in rows:
        w, d = words(r[1]), float("inf") if r[0] is None else r[0]
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out[(r[0], len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))] += 1
    return out


def test_against_brute_force(docs, rows, empty):
    with pytest.raises(ValueError):
        spans.remove_repeated_spans(docs)
    docs = docs.drop("__n_words", "__kept")
    got = spans.remove_repeated_spans(docs)
    assert set(docs.columns) < set(got.columns)
    assert Counter((r.doc_id, r["__n_words"], r["__n_removed"], r["__kept"]) for r in got.collect()) == cleaned(rows)
    assert spans.remove_repeated_spans(empty).count() == 0


def test_deduplicated_rows(docs, rows):
    got = spans.deduplicated(docs).collect()
    expected = cleaned(rows)
    assert len(got) == sum(n for (_, total, gone, _), n in expected.items() if not gone or gone < total)
    texts = {r.doc_id: r.text for r in got}
    assert texts[0] == rows[0][1] and texts[60] is None and 51 not in texts  # a copy of 11


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=14), min_size=1, max_size=6))
def test_automaton_names_the_smallest_document(sequences):
    a = spans.Automaton()
    for d, s in enumerate(sequences):
        a.add(s, d)
    a.finish()
    for s in sequences:
        want = [min(d for d, t in enumerate(sequences) if any(t[j : j + 3] == s[i : i + 3] for j in range(len(t) - 2))) for i in range(len(s) - 2)]
        assert a.least_documents(s, 3) == want


def test_hot_anchors_are_split(spark, monkeypatch):
    # one line of seven words with other words around it: its windows meet one by one
    monkeypatch.setattr(spans, "HOT_BLOCKS", 2)
    rows = [(i, " ".join([*(f"a{i}x{j}" for j in range(9)), "this line stands in every single page", *(f"b{i % 30}y{j}" for j in range(14))])) for i in range(60)]
    got = spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r["__n_words"], r["__n_removed"], r["__kept"]) for r in got.collect()) == cleaned(rows)
