from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from braidwork.llm import mixing, sigtree

from .conftest import words


def shares(sizes, weights, share, most):
    """Targets by sharing out again and again until no source is over its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        rest = left - sum(full.values())
        target = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s] + 1e-9]
        if not over:
            return full | target
        full |= {s: most * sizes[s] for s in over}


def test_targets_and_taken(docs, rows):
    got = mixing.mix_sources(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = shares(sizes, (5, 2, 1), 1.5, 2.0)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes)
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs.repartition(3)).collect()))


def test_mixed_documents_hold_the_taken_words(docs):
    plan = {r.source: r.t for r in mixing.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    held = defaultdict(int)
    for r in mixed.collect():
        held[r.source] += len(words(r.text))
    assert dict(held) == plan


def test_empty(empty):
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("operator", [mixing.mixed_documents, sigtree.one_of_each_group])
def test_rows_survive_another_split_of_the_table(spark, docs, operator):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    want = sorted(map(str, operator(docs).collect()))
    later = operator(docs)
    spark.conf.set(key, "2000b")  # the last scan gets other partitions than the ones before
    try:
        assert sorted(map(str, later.collect())) == want
    finally:
        spark.conf.set(key, before)
