import hashlib
import math
import random

import numpy as np
import pytest

from braidwork.llm import exponion


def brute(rows, k=16, rounds=3, dim=64):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is None, r[0] or 0, r[1]))[:k]
    at = [list(v) for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(at)), key=lambda c: (far(v, at[c]), c))
    for _ in range(rounds):
        mine = [nearest(v) for _, v in kept]
        for c in range(len(at)):
            own = [v for (_, v), m in zip(kept, mine, strict=True) if m == c]
            if own:
                at[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, nearest(v), v) for i, v in kept]
    found = [(i, c, far(v, at[c])) for i, c, v in found]
    total = sum(d for _, _, d in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, d, sum(e for _, x, e in found if x == c), total, sha[c]) for i, c, d in found), key=str)


def test_as_found_by_brute_force(spark):
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + rnd.gauss(0, 0.2) for x in rnd.choice(centres)]) for i in range(300)]
    rows += [(i, [float(rnd.randint(-1, 1)) for _ in range(64)]) for i in range(300, 400)]  # ties
    rows += [(500, list(rows[3][1])), (501, [0.0] * 64), (501, [0.0] * 64), (None, [1.0] * 64), (None, [1.0] * 64)]
    rows += [(600, None), (601, []), (602, [1.0] * 63), (603, [1.0] * 65), (604, [float("nan")] + [0.0] * 63), (605, [float("inf")] * 64), (606, [None] + [1.0] * 63)]
    rows += [(700 + i, [0.5] * 64) for i in range(200)]  # one cluster with a third of the rows
    df = spark.createDataFrame([(*r, "a", 1.5) for r in rows], "vec_id long, embedding array<double>, cluster string, upper double").repartition(5)
    got = sorted(map(tuple, exponion.cluster_vectors(df).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("n", [1, 5])
def test_fewer_rows_than_centroids(spark, n):
    rows = [(i, [float(i % 2)] * 64) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, exponion.cluster_vectors(df).collect()), key=str) == brute(rows)


def test_empty_and_far_out(spark):
    schema = "vec_id long, embedding array<double>"
    assert exponion.cluster_vectors(spark.createDataFrame([(1, [1.0])], schema)).count() == 0
    far = spark.createDataFrame([(i, [s * 1e300] * 64) for i, s in enumerate([1.0, -1.0, 1.0])], schema)
    got = exponion.cluster_vectors(far, k=2).collect()
    assert len(got) == 3 and all(r.distance >= 0 for r in got)


def test_the_ball_leaves_most_centroids_unread():
    rnd = np.random.default_rng(5)
    at = rnd.integers(-1000, 1000, (64, 8))
    x = (at[rnd.integers(0, 64, 5000)] + rnd.integers(-60, 60, (5000, 8))).astype(np.int32)
    start = (np.zeros(5000, np.int64), np.full(5000, np.inf), np.zeros(5000))
    known = exponion.Centroids(at, np.zeros(64))
    cluster, upper, lower, _ = exponion.assign(x, *start, known)
    for _ in range(3):
        moved = at + rnd.integers(-9, 10, at.shape)
        known = exponion.Centroids(moved, np.sqrt(((moved - at) ** 2).sum(axis=1).astype(float)))
        cluster, upper, lower, work = exponion.assign(x, cluster, upper, lower, known)
        every = np.stack([exponion.squares(x, c) for c in moved], axis=1)
        assert (cluster == every.argmin(axis=1)).all()
        order = np.sort(every, axis=1)
        assert (upper + 1e-5 >= np.sqrt(order[:, 0])).all() and (lower - 1e-5 <= np.sqrt(order[:, 1])).all()
        assert work < 0.2 * every.size
        at = moved
