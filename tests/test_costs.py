"""What work is not done: costs that large tables show."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from braidwork.functions import jsontree as jt
from braidwork.functions import merging
from braidwork.functions import payload as P
from braidwork.functions.merging import Policy, Version, joint_shape, merge
from braidwork.operators import attribution, compare, pairing, routing
from braidwork.plans import queries, run_queries
from braidwork.plans.config import Segment
from braidwork.streaming import ageing


def test_versions_of_different_times_are_not_written_out(monkeypatch):
    """contents decide ties of time only."""
    monkeypatch.setattr(merging, "canonical", lambda tree: pytest.fail("written out"))
    whole = Version({f"f{i}": "0" for i in range(20)}, "1")
    assert merge(whole, Version({"f3": "1", "g": "2"}, "2"), Policy()).tree == {**whole.tree, "f3": "1", "g": "2"}
    assert merge(Version({"f3": "1"}, "2"), whole, Policy()).tree["f3"] == "1"
    assert merge(whole, Version({"f3": "1"}, None), Policy()).tree["f3"] == "0"
    shape = {f"f{i}": "leaf bare" for i in range(20)}
    assert joint_shape(shape, {"f3": "leaf bare"}) is shape  # no copy a row
    assert joint_shape(shape, {"f3": "object"}) is None and joint_shape({"f3": "object"}, shape) is None
    assert joint_shape({"a": "object"}, {"b": "object"}) == {"a": "object", "b": "object"}


def test_contents_in_one_pass(monkeypatch):
    """F8: items' contents, without a tree in between."""
    trees = ['{"b":[2,1,{"z":1.00,"a":null}],"_sourceCaseId":"c","a":{"_caseIdByField":{"x":"y"},"y":true}}', '{"é\\n":[[3],[1,2],[]],"n":-1e5}', "{}", "[]", "null", '"x"']
    for text in trees:
        tree = jt.parse(text)
        assert jt.content_text(tree) == jt.dump(jt.canonical(jt.without_provenance(tree)))
    monkeypatch.setattr(merging, "canonical", lambda tree: pytest.fail("a second tree"))
    a, b = Version({"items": [{"k": "x"}, {"k": "x"}]}, "1"), Version({"items": [{"k": "x"}]}, "2")
    assert len(merge(a, b, Policy(arrays=frozenset({"items"}), item_keys={"items": "k"})).tree["items"]) == 2


def test_equal_payloads_are_read_once(spark):
    """what depends on the text alone is worked out once for equal ones."""
    calls = spark.sparkContext.accumulator(0)

    def one(text):
        calls.add(1)
        return text and text.upper()

    rows = spark.range(1000, numPartitions=1).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))).alias("t"))
    got = {tuple(r) for r in rows.select("t", P._per_text("string", one)(F.col("t"))).collect()}
    assert got == {(None, None), ("t1", "T1"), ("t2", "T2")} and calls.value <= 30


def test_groups_that_need_no_joining(spark):
    """a group of one part passes no parts to Python."""
    rows = spark.createDataFrame([(None, "s")], "parts array<struct<name:string,payload:string>>, segment string")
    assert rows.select(P.parts_joined(F.col("parts"), F.col("segment"), {})).first()[0] is None


def test_partitions_follow_the_lines(spark, small, monkeypatch):
    """what a task sorts and aggregates is bounded by the number of partitions, not by the table."""
    assert compare.parts_for(spark.range(100), 25) is None and compare.parts_for(spark.range(101), 20) == 6
    lines = queries.table(spark, small, "lineitem").count()
    for module, name in ((queries, "soft_match"), (run_queries, "symmetric_measures")):
        want = {tuple(r) for r in queries.QUERIES[name](spark, small).collect()}
        monkeypatch.setattr(module, "LINES_A_TASK", lines // 23)
        frame = queries.QUERIES[name](spark, small)
        assert f", {-(-lines // (lines // 23))}" in "\n".join(x for x in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in x)
        assert {tuple(r) for r in frame.collect()} == want


def test_fields_unfold_behind_the_shuffle(spark, small):
    """a pair's arrays travel packed, in one shuffle by pair; its fields do not."""
    for name in ("field_compare", "segment_type", "match_rate"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(pair" in x and ", field#" in x]


def test_cases_by_one_shuffle_of_the_fields(spark, tmp_path):
    """what is compared is read once and shuffled once, by pair; a path finds its nearest note among many."""
    paths = [f"r{i}.a{j}" + ".b" * k for i in range(3) for j in range(7) for k in range(3)]
    ddl = "pair int, field_name string, array_key string, human_value string, human_case string"
    spark.createDataFrame([(p, f, None, "x", None) for p in (1, 2) for f in [*paths, "plain", None]], ddl).write.parquet(str(tmp_path / "fields"))
    fields = spark.read.parquet(str(tmp_path / "fields"))
    noted = {(1, p): f"c{i}" for i, p in enumerate(paths) if i % 3 == 0} | {(1, "r1"): "root", (1, ""): "never", (2, "r2.a"): "no ancestor"}
    notes = spark.createDataFrame([(*k, v) for k, v in noted.items()] + [(1, None, "x"), (None, "plain", "x")], "pair int, path string, case_id string")
    for parts in (None, 7):
        found = attribution.with_case(fields, notes, spark.createDataFrame([(1, "main"), (None, "y")], "pair int, canonical_case_id string"), parts)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and (parts is None or "hashpartitioning(pair" in plan and ", 7), REPARTITION_BY_NUM" in plan)

        def want(pair, field):
            above = [] if field is None else [".".join(field.split(".")[:n]) for n in range(field.count(".") + 1, 0, -1)]
            return next((noted[pair, x] for x in above if (pair, x) in noted), "main" if pair == 1 else None)

        got = [(r.pair, r.field_name, r.case_id) for r in found.collect()]
        assert len(got) == 2 * (len(paths) + 2) and all(case == want(pair, field) for pair, field, case in got)


def test_a_waiting_group_touches_its_timer_once():
    """a group's batch reads and writes its state once; its timer is set anew only where its first row changes."""
    calls = []

    class Handle:
        value = None

        def getValueState(self, name, schema):
            return self

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def registerTimer(self, at):
            calls.append(("set", at))

        def deleteTimer(self, at):
            calls.append(("delete", at))

    def rows(*seconds):
        calls.clear()
        assert list(waiting.handleInputRows(("k",), iter([Row(second=s, human=s % 2) for s in seconds]), None)) == []
        return calls

    waiting = ageing.Waiting(100)
    waiting.init(Handle())
    assert rows(20, 31, 20) == ["get", "update", ("set", 120_000)]
    assert rows(25, 130) == ["get", "update"]
    assert rows(15) == ["get", "update", ("delete", 120_000), ("set", 115_000)]
    calls.clear()

    class Now:
        getCurrentWatermarkInMs = staticmethod(lambda: 115_000)

    assert [tuple(r) for r in waiting.handleExpiredTimer(("k",), Now, None)] == [("k", 15, 2, 3)]
    assert calls == ["get", "update", ("set", 230_000)] and rows(114) == ["get", "update"] and Handle.value is None


def test_a_run_reads_its_payloads_in_few_passes(spark):
    """Python workers of a stage and shuffles of the payloads: one function opens a payload, one signs what a
    group has and gets, and a group's rows meet in one shuffle."""
    segments = (Segment("main", "ai", "submit"),)
    count = lambda df, what: df._jdf.queryExecution().executedPlan().toString().count(what)
    raw = spark.createDataFrame([("k", "submit", 'id=1,request={"img":" A ","x":1}', None), ("k", "ai", '{"img":"a","x":2}', None), ("k", "ai", "no JSON", None)], "key_id string, method string, payload string, created_at timestamp")
    keyed = routing.keyed(raw, segments, "img", "x", "1")
    assert count(keyed, "ArrowEvalPython [") == 1
    assert sorted(tuple(r) for r in keyed.select("image_id", "side", "payload").collect()) == [("a", "ai", '{"img":"a","x":2}'), ("a", "human", '{"img":" A ","x":1}')]
    at = lambda s: F.timestamp_seconds(F.lit(s))
    pool = spark.createDataFrame([("a", "main", '{"x":1}', "k", 100, 2)], "image_id string, segment string, payload string, key_id string, s long, retry_count long").withColumn("created_at", F.timestamp_seconds("s"))
    pool = pool.withColumn("first_seen_at", F.lit(None).cast("timestamp"))
    fresh = spark.createDataFrame([("a", '{"x": 1}', 1), ("a", '{"x":2}', 7), ("a", '{"x":3}', None), ("b", '{"x":2}', 9), ("b", '{"x":4}', 50)], "image_id string, payload string, s long")
    fresh = fresh.select("image_id", F.lit("main").alias("segment"), "payload", F.lit("k").alias("key_id"), F.timestamp_seconds("s").alias("created_at"), F.lit("ai").alias("side"))
    found = pairing.ai_state(fresh, pool, at(1000))
    assert count(found, "Exchange hashpartitioning") == 1 and count(found, "ArrowEvalPython [") <= 2
    got = sorted(tuple(r) for r in found.select("image_id", "payload", F.unix_seconds("created_at"), F.unix_seconds("first_seen_at"), "retry_count").collect())
    # behind the latest known time by discovery, the earliest first; a replay of known content brings nothing
    assert got == [("a", '{"x":1}', 100, 1000, 3), ("a", '{"x":2}', 102, 1000, 0), ("a", '{"x":3}', 101, 1000, 0), ("b", '{"x":2}', 9, 1000, 0), ("b", '{"x":4}', 10, 1000, 0)]


def test_plain_pairs_are_compared_within_their_row(spark):
    """pairs without keyed, repeated or renamed fields give the same rows as by pair, without a shuffle."""
    from datetime import datetime

    from braidwork.plans import run as runs

    segments = (Segment("main", "ai", "submit"), Segment("moved", "m.ai", "m", field_mappings=(("new", "old"),)))
    texts = [
        ('{"a":"X","b":{"c":1.0,"d":null},"_caseIdByField":{"a":"c1","b":"c2"},"only":"h"}', '{"b":{"d":"x","c":1},"a":"x","more":true}'), ('{"a":"1"}', ""), (None, '{"a":"1"}'), ("", "{}"), ("no JSON", '{"z":"1"}'),
        ('{"a":{"b":"x","_sourceCaseId":"own","_caseIdByField":{"b":"c3"}},"_caseIdByField":{"a":"c4"}}', '{"a":{"b":"X"},"a.b":"?"}'), ('{"a":[1,2],"b":"x"}', '{"a":[2,1],"b":"y"}'), ('{"a":"1","old":"2"}', '{"a":"1","old":"2"}'),
    ]
    rows = [(f"i{n}", s.name, "k", h, f"case{n}", 1, a) for n, (h, a) in enumerate(texts) for s in segments]
    matched = spark.createDataFrame(rows, "image_id string, segment string, key_id string, payload string, case_id string, comparison_version long, ai_payload string")
    matched = matched.withColumn("created_at", F.lit(datetime(2026, 5, 1)).cast("timestamp")).withColumn("ai_created_at", F.col("created_at"))
    kept = []
    found = runs.results_of(matched, segments, {}, {}, datetime(2026, 5, 2), lambda df, name: kept.append(df) or df)
    (fields,) = kept
    assert {(r.image_id, r.segment) for r in fields.where("plain").collect()} == {(f"i{n}", "main") for n in (0, 1, 2, 3, 4, 7)}
    plan = compare.plain_fields(fields.where("plain"), "lined")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # all pairs by pair: as flattened, without lines
    every = matched.select("*", F.inline(F.array(P.both_flattened(F.col("payload"), F.col("ai_payload"), {}))).alias("notes", "human_fields", "ai_fields"))
    every = every.withColumn("ai_iteration", F.col("comparison_version").cast("int")).withColumnRenamed("created_at", "human_created_at")
    want = runs._by_pair(every, segments, {}, {}).select(*found.drop("load_time").columns)
    assert sorted(map(str, found.drop("load_time").collect())) == sorted(map(str, want.collect()))


def test_a_fold_notes_and_signs(spark):
    """noting cases, merging and signing are one pass over a group's rows."""
    rows = [(k, i, c, p, f"2026-01-0{i + 1}") for k, some in {
        "one": [("c1", '{"a": 1.00}')], "bare": [(None, '{ "a": 1}')], "text": [("c1", "no JSON"), ("c2", "none")], "replay": [(None, '{"a":"1","_caseIdByField":{"a":"c1"}}'), ("c1", '{"a":"1"}')],
        "more": [("c1", '{"a":"1","b":{"x":1}}'), ("c2", '{"b":{"y":2}}'), (None, '{"z":0}')], None: [("c3", '{"n":null}'), ("c4", '{"n":1}')],
    }.items() for i, (c, p) in enumerate(some)]
    df = spark.createDataFrame(rows, "key string, n int, case string, payload string, at string").withColumn("segment", F.lit("main"))
    noted = df.withColumn("payload", P.stamped(F.col("payload"), F.col("case"), {"main": Policy()}, F.col("segment")))
    two = P.folded(noted, ["key"], ["n"], {"main": Policy()}, ["n"])
    tree = F.col("payload").startswith("{")
    want = {tuple(r) for r in two.select("*", F.when(tree, P.content_signature(F.col("payload")))).collect()}
    for more in ({}, {"hot_rows": 1, "ranges": 2}, {"at_most": df}):
        one = P.folded(df, ["key"], ["n"], {"main": Policy()}, ["n"], case="case", signed=True, **more)
        assert {tuple(r) for r in one.select("key", "n", "payload", "at", "content").collect()} == want and len(want) == 6
    placed = P.folded(df.repartition("key"), ["key"], ["n"], {"main": Policy()}, ["n"], case="case", signed=True, together=True)
    assert placed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and {tuple(r) for r in placed.collect()} == want
    # keys go on over batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert {tuple(r) for r in P.folded(df, ["key"], ["n"], {"main": Policy()}, ["n"], case="case", signed=True).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
