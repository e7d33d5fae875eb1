"""Clustered tables, migrations, measures by several keys, and groups that age in a stream."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from braidwork.operators.reporting import Measure, symmetric_measures
from braidwork.plans.migrations import Database, Migration, migrations
from braidwork.sources.clustered import ClusteredTable, Conflict, Refused
from braidwork.streaming import ageing

D = datetime(2026, 5, 1)


def scanned(df):
    """(files, rows) that the scan of an executed frame has read."""
    rows = df._jdf.queryExecution().executedPlan().collectLeaves()
    rows = [rows.apply(i) for i in range(rows.size())]
    metric = lambda leaf, name: leaf.metrics().apply(name).value() if leaf.metrics().contains(name) else 0
    return sum(metric(x, "numFiles") for x in rows), sum(metric(x, "numOutputRows") for x in rows)


def test_scans_read_what_they_ask_for(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ["k"])
    df = spark.range(0, 200_000, 1, 7).select(((F.col("id") * 7919) % 200_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("x").alias("range_no"))
    table.replace(df, D, ranges=8, row_group_bytes=1 << 18, expected_rows=200_000)
    assert table.read().columns == ["k", "text", "range_no"] and table.read().count() == 200_000
    zone = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        some = table.scan(90_000, 90_500)
        assert sorted(r.k for r in some.collect()) == list(range(90_000, 90_500))
        files, rows = scanned(some)
        assert files <= 2 and rows < 20_000  # one or two of 8 folders, and of their rows not all row groups
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", zone)
    assert table.scan(500_000).count() == 0 and table.scan(None, 10).count() == 10 and table.scan(199_990, None).count() == 10
    parts = table.parts(3)
    assert len(parts) == 3 and sum(p.rows for p in parts) == 200_000 and max(p.rows for p in parts) < 110_000
    seen = [{r.k for r in table.read_part(p).select("k").collect()} for p in parts]
    assert sum(map(len, seen)) == 200_000 and len(set().union(*seen)) == 200_000


def test_a_hot_key_and_nulls(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ["k"])
    rows = [(None, i) for i in range(300)] + [("b", i) for i in range(900)] + [(f"c{i:03}", i) for i in range(300)]
    table.replace(spark.createDataFrame(rows, "k string, v int"), D, ranges=6)
    assert max(r.rows for r in table.ranges().collect()) < 700  # the hot key lies in several ranges
    assert table.scan("b", "b\0").count() == 900 and table.scan().count() == 1200 and table.read().count() == 1500
    assert table.scan("c000", "c010").count() == 10
    empty = ClusteredTable(spark, str(tmp_path / "e"), ["k"])
    empty.replace(spark.createDataFrame([], "k string, v int"), D)
    assert empty.read().columns == ["k", "v"] and empty.scan("a", "b").count() == 0 and empty.parts(4) == []


def test_versions_checks_and_conflicts(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ["id"])
    with pytest.raises(LookupError):
        table.read()
    first = table.replace(spark.range(10), D)
    with pytest.raises(Refused, match="3 rows: odd ones"):
        table.replace(spark.range(6), D + timedelta(hours=1), must_be_none={"odd ones": F.col("id") % 2 == 1})
    with pytest.raises(Refused, match="6 rows instead of 7"):
        table.replace(spark.range(6), D + timedelta(hours=1), expected_rows=7)
    assert table.read().count() == 10
    table.replace(table.read().where("id < 4"), D + timedelta(hours=2))  # reads what it replaces
    with pytest.raises(Conflict):
        table.replace(spark.range(3), D + timedelta(hours=3), based_on=first)
    assert table.read().count() == 4 and table.read(D + timedelta(hours=1)).count() == 10 == table.scan(0, 99, D).count()
    folders = [p.name for p in (tmp_path / "t").iterdir()]
    assert len(folders) == 3  # the ledger and two versions: refused and late ones are gone
    assert table.forget(D + timedelta(hours=2)) == 1 and table.read().count() == 4


PENDING = "image_id string, key_id string, segment string, pending_type string, payload string, created_at timestamp, first_seen_at timestamp, last_retried_at timestamp, retry_count long, matched_ai_count int"


def test_migrations(spark, tmp_path):
    rows = [(f"i{n}", "k", "main", "ai" if n % 3 == 0 else "human", "{}", D, D + timedelta(days=n), D, n, 1) for n in range(9)]
    base = Database(spark, str(tmp_path / "db"), {"pending_comparisons": ["first_seen_at"], "ai_pending_comparisons": ["first_seen_at"], "comparison_results": ["image_id"]})
    base.load({"pending_comparisons": spark.createDataFrame(rows, PENDING), "comparison_results": spark.createDataFrame([("i1",)], "image_id string")}, D)
    broken = Migration("broken", lambda t: {"comparison_results": t["comparison_results"].limit(0), "pending_comparisons": t["pending_comparisons"]}, {"pending_comparisons": {"AI rows": F.col("pending_type") == "ai"}})
    with pytest.raises(Refused, match="3 rows: AI rows"):  # though its first table was written and fine
        base.migrate([broken], D)
    assert base.read("comparison_results").count() == 1 and base.applied() == ["load"]
    todo = migrations()
    assert base.migrate(todo[:2], D) == ["001_split_ai_pending", "002_next_ai_iteration"]
    pool, pending = base.read("ai_pending_comparisons"), base.read("pending_comparisons")
    assert sorted(r.image_id for r in pool.collect()) == ["i0", "i3", "i6"] and pool.columns == ["image_id", "key_id", "segment", "payload", "created_at", "first_seen_at", "last_retried_at", "retry_count"]
    assert pending.count() == 6 and "matched_ai_count" not in pending.columns and base.read("comparison_results").first().case_id is None
    # what later code has written meanwhile: cases, and keys of several iterations
    base.load({"pending_comparisons": pending.withColumn("case_id", F.when(F.col("image_id") == "i1", "c7")).withColumn("matched_ai_keys", F.when(F.col("image_id") == "i2", "a;b")).withColumn("next_ai_iteration", F.lit(None).cast("long"))}, D)
    again = [Migration("002 again", todo[1].change, todo[1].must_be_none, todo[1].rows), *todo]
    assert base.migrate(again, D) == ["002 again", "004_merged_case_ids", "005_comparison_signature"]
    got = {r.image_id: (r.next_ai_iteration, r.merged_case_ids, r.comparison_version, r.last_compared_signature) for r in base.read("pending_comparisons").collect()}
    assert got["i1"] == (0, "c7", 0, None) and got["i2"] == (2, None, 2, None) and len(got) == 6
    assert base.migrate(todo, D) == []


def test_measures_by_several_keys(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("xy"), rnd.choice([None, *range(20)]), rnd.choice([None, *"abcd"])) for _ in range(600)]
    df = spark.createDataFrame([(g, i, c, None if i is None else i * 1.5, None if c is None else ord(c)) for g, i, c in rows] + [(None, None, None, None, None)], "g string, image int, case_id string, seconds double, weight int")
    got = symmetric_measures(df, ["g"], {"images": Measure("image"), "cases": Measure("case_id"), "average": Measure("image", "average", "seconds"), "least": Measure("case_id", "min", "weight"), "all": Measure("case_id", "sum", "weight")}).collect()
    for r in got:
        images, cases = {i for g, i, _ in rows if g == r.g and i is not None}, {c for g, _, c in rows if g == r.g and c}
        assert (r.images, r.cases) == (len(images), len(cases))
        if images:
            assert r.average == pytest.approx(sum(i * 1.5 for i in images) / len(images)) and r.least == min(map(ord, cases)) and r["all"] == sum(map(ord, cases))
    assert {r.g for r in got} == {"x", "y", None}
    whole = symmetric_measures(df, [], {"images": Measure("image")}).collect()
    assert [r.images for r in whole] == [20]
    assert symmetric_measures(df.limit(0), ["g"], {"images": Measure("image")}).count() == 0


def waits(rows, age, watermark):
    """(key, first, ai, human) of waits that have ended, by hand."""
    out, by_key = [], defaultdict(list)
    for key, side, at in rows:
        if key is not None and at is not None:
            by_key[key].append((at, side))
    for key, own in by_key.items():
        own.sort()
        while own and own[0][0] + age <= watermark:
            first = own[0][0]
            mine = [s for t, s in own if t < first + age]
            out.append((key, first, mine.count("ai"), mine.count("human")))
            own = [(t, s) for t, s in own if t >= first + age]
    return sorted(out)


def test_aged_groups_of_a_stream(spark, tmp_path):
    rnd, day = random.Random(8), 86400
    base = int(datetime(2026, 1, 1).timestamp())
    rows = [(rnd.choice(["a", "b", "hot", "hot", "hot"]), rnd.choice(["ai", "human"]), base + rnd.randint(0, 30 * day)) for _ in range(400)]
    rows += [(None, "ai", base), ("a", "ai", None), ("once", "human", base + 3 * day), ("end", "ai", base + 40 * day)] + [("same", "ai", base + day)] * 5
    df = spark.createDataFrame(rows, "key string, side string, second long").select("key", "side", F.timestamp_seconds("second").alias("at"))
    schema = df.schema
    own = ageing.with_state_store(spark)
    # by time in three files, each shuffled inside: one batch a file, none later than the watermark allows
    for i, (low, high) in enumerate([(0, 11), (11, 22), (22, 99)]):
        part = df.where(F.coalesce(F.unix_seconds("at"), F.lit(base)).between(base + low * day, base + high * day - 1)).orderBy(F.rand(3))
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = ageing.aged_groups(stream, "key", "side", "at", 7, "1 day")
    q = got.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    found = spark.read.parquet(str(tmp_path / "o")).select("key", F.unix_seconds("first_seen_at").alias("first"), "n_ai", "n_human").collect()
    assert sorted(tuple(r) for r in found) == waits(rows, 7 * day, base + 39 * day)
