import random
from collections import defaultdict

import numpy as np
import pytest

from braidwork.llm import graph, sigtree

from .conftest import DDL, words


def shingles(text, k=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(rows, percent=75):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in group]
    return sorted(out, key=str)


def test_components(docs, rows):
    got = sigtree.jaccard_components(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == groups(rows)


def test_many_near_copies_in_chunks(spark, monkeypatch):
    """A large group of near copies, cut into chunks, is one component; others stay apart."""
    monkeypatch.setattr(sigtree, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(sigtree, "FEW", 4)
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 9)}"
        rows.append((i, " ".join(w), None, None, 0))
    rows += [(100 + i, " ".join(f"y{rnd.randint(0, 500)}" for _ in range(50)), None, None, 0) for i in range(10)]
    got = sigtree.jaccard_components(spark.createDataFrame(rows, DDL)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == groups(rows)


@pytest.mark.parametrize("seed", range(20))
def test_chains_connect_what_pairs_would(seed):
    rnd = np.random.default_rng(seed)
    m = int(rnd.integers(1, 40))
    group, n = rnd.integers(0, 3, m), rnd.integers(10, 40, m)
    reach = np.maximum(0, n + rnd.integers(-8, 9, m))
    o = np.lexsort((n, group))
    group, n, reach = group[o], n[o], reach[o]
    a, b = sigtree.chained(group, n, reach)
    assert len(a) <= m and (group[a] == group[b]).all()
    found = np.arange(m)
    for _ in range(m):
        for x, y in zip(a, b, strict=True):
            found[[x, y]] = min(found[x], found[y])
    for i in range(m):
        for j in range(i):
            if group[i] == group[j] and n[i] <= reach[j] and n[j] <= reach[i]:
                assert found[i] == found[j]


def test_pages_of_one_template_are_no_candidates(spark):
    """A shared passage that is too small a part of each page to link them makes no component of them."""
    template = " ".join(f"menu{i}" for i in range(32))
    rows = [(i, " ".join(f"p{i}x{j}" for j in range(8)) + " " + template + " " + " ".join(f"q{i}x{j}" for j in range(8)), None, None, 0) for i in range(3000)]
    rows.append((3000, rows[7][1], None, None, 0))
    df = spark.createDataFrame(rows, DDL)
    numbered = sigtree.with_row_numbers(df.select("doc_id", "text"), "row").select("row", "doc_id", "text")
    profile = sigtree.stored(sigtree._profile(numbered, 5, 20), "profile")
    rank = sigtree._rank(profile.where("slice IS NOT NULL"), 20)
    assert sigtree._meetings(sigtree._prefixes(numbered, rank, 20, 5, 75, 8), 75).count() < 30
    got = sigtree.jaccard_components(df).collect()
    assert {r.doc_id: r.component_id for r in got} == {**{i: i for i in range(3000)}, 3000: 7}


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_all_links(seed):
    rnd = np.random.default_rng(seed)
    sets = []
    for _ in range(12):
        base = rnd.integers(0, 2**63, rnd.integers(5, 80), dtype=np.uint64)
        for _ in range(rnd.integers(1, 12)):
            keep = base[rnd.random(len(base)) < rnd.choice([1.0, 0.9, 0.75])]
            sets.append(np.unique(np.concatenate((keep, rnd.integers(0, 2**63, rnd.integers(0, 3), dtype=np.uint64), base[:3]))))
    got = sigtree.tree_links(sets, np.arange(len(sets)), 75)
    want = np.arange(len(sets))
    for _ in sets:
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    want[[i, j]] = min(want[i], want[j])
    assert (got == want).all()


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[101] == 100 and len(found) == 43


def test_one_of_each_group(docs, rows, empty):
    kept = sigtree.one_of_each_group(docs)
    assert kept.columns == docs.columns
    by_id = {d: c for d, _, c in groups(rows) if d is not None and d != 66}
    ids = [r.doc_id for r in kept.collect()]
    assert all(by_id[i] == i for i in ids if i in by_id) and len(ids) == len(set(ids)) and 5 in ids
    assert sigtree.one_of_each_group(empty).count() == 0 and sigtree.jaccard_components(empty).count() == 0
    with pytest.raises(ValueError):
        sigtree.jaccard_components(docs, percent=60)
