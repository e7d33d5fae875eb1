"""Merging a hot key by ranges gives what merging row by row gives."""

import json
import random
from functools import reduce

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from braidwork.functions import jsontree as jt
from braidwork.functions import payload as P
from braidwork.functions.merging import Policy, Version, joint_shape, merge, shape_of

POLICY = Policy(frozenset({"lines", "tags"}), {"lines": "id"}, {"lines": "seen"}, {"whole": ("slot",)})
values = st.sampled_from(["a", "b", None, True, [1], [2, 1]])
item = st.builds(lambda i, v, s: {"id": i, "v": v} | ({"seen": 1} if s else {}), st.integers(0, 3), st.integers(0, 2), st.booleans())
tree = st.fixed_dictionaries({}, optional={
    "x": values, "y": values, "deep": st.fixed_dictionaries({}, optional={"p": values, "q": st.fixed_dictionaries({}, optional={"r": values})}),
    "lines": st.lists(item, max_size=3, unique_by=lambda x: x["id"]), "tags": st.lists(st.sampled_from(["t", {"u": 1}]), max_size=2), "whole": st.fixed_dictionaries({}, optional={"slot": values, "own": values}),
})
odd = st.one_of(*[tree] * 20, st.just({"deep": 3}), st.just({"lines": "none"}), st.just({"whole": [1]}), st.just({"lines": [{"id": 1}, {"id": 1}]}))


REGULAR = []


def noted(trees, which):
    return [jt.stamp(t, f"c{i % 3}", frozenset(POLICY.atomic)) if which == "all" or which == "some" and i % 2 else t for i, t in enumerate(trees)]


@settings(max_examples=400, deadline=None)
@given(st.lists(odd, min_size=2, max_size=6), st.sampled_from(["all", "none", "some"]), st.randoms())
def test_ranges_of_one_shape_merge_alike(trees, notes, rnd):
    versions = [Version(t, f"{i:03}") for i, t in enumerate(noted(trees, notes))]
    shape = reduce(joint_shape, [shape_of(v.tree, POLICY) for v in versions], {})
    if shape is None:
        return
    REGULAR.append(len(versions))
    whole = reduce(lambda a, b: merge(a, b, POLICY), versions)
    cuts = sorted({0, len(versions), *(rnd.randint(1, len(versions)) for _ in range(2))})
    ranges = [reduce(lambda a, b: merge(a, b, POLICY), versions[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
    again = reduce(lambda a, b: merge(a, b, POLICY), [Version(jt.parse(jt.dump(v.tree)), v.at) for v in ranges])
    assert (jt.dump(again.tree), again.at) == (jt.dump(whole.tree), whole.at)


def test_that_many_were_of_one_shape():
    assert len(REGULAR) > 100 and max(REGULAR) >= 4


def test_hot_keys_by_ranges(spark):
    rnd, rows = random.Random(6), []
    make = lambda i: {"x": rnd.choice("ab"), f"f{i % 7}": i, "lines": [{"id": k, "v": rnd.randint(0, 2)} for k in rnd.sample(range(5), 2)], "deep": {rnd.choice("pq"): 1.5}}
    for i in range(300):
        rows.append(("hot", json.dumps(jt.stamp(make(i), f"c{i % 4}")), f"{i:05}"))
        rows.append((None, json.dumps(make(i)), f"{i:05}"))
    rows += [("mixed", json.dumps({"deep": 1 if i == 70 else {"p": i}}), f"{i:05}") for i in range(90)]  # not of one shape
    rows += [("same time", json.dumps(make(i)), f"{i // 2:05}") for i in range(90)]
    rows += [("no object", f"text {i}", f"{i % 9:05}") for i in range(90)] + [("few", json.dumps(make(i)), f"{i:05}") for i in range(3)] + [("one", "{ }", None)]
    rows += [("one object", '{"a" : 1.00}' if i == 40 else "none", f"{i:05}") for i in range(80)]
    df = spark.createDataFrame([(k, "main", p, at, f"{k} {at}") for k, p, at in rows], "key string, segment string, payload string, at string, case string").orderBy(F.rand(1))
    order, policies = ["at", "payload"], {"main": POLICY}
    plain = {r.key: tuple(r) for r in P.folded(df, ["key"], order, policies, ["case"]).collect()}
    hot = P.folded(df, ["key"], order, policies, ["case"], hot_rows=50, ranges=7)
    assert {r.key: tuple(r) for r in hot.collect()} == plain and len(plain) == 8 and hot.columns == ["key", "case", "payload", "at"]
    assert P.folded(df.limit(0), ["key"], order, policies).count() == 0
