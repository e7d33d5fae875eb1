"""Columns and operators on small frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from braidwork.functions import crypto, text, times
from braidwork.operators import attribution, audit, compare, relational, reporting, views
from braidwork.plans import schemas
from braidwork.plans.config import Segment, SubType
from braidwork.operators.routing import keyed
from braidwork.sources import scans, state
from braidwork.sources.ledger import Ledger

D = datetime(2026, 4, 24, 10, 30)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [
    ("2026-04-24T10:30:00Z", "2026-04-24T10:30:00.000000Z"), ("2026-04-24T10:30:00.123456789Z", "2026-04-24T10:30:00.123456Z"), ("2026-04-24 10:30:00 UTC", "2026-04-24T10:30:00.000000Z"),
    ("2024-10-08 15:26:28:46200 UTC", "2024-10-08T15:26:28.046200Z"), ("2026-04-24T12:30:00+02:00", "2026-04-24T10:30:00.000000Z"), ("2026-04-24 10:30:00+0000", "2026-04-24T10:30:00.000000Z"),
    ("not-a-timestamp", "not-a-timestamp"), ("2026", "2026"), ("  ", None), (None, None),
])
def test_timestamps(spark, raw, want):
    assert one(spark, times.normalised(F.lit(raw).cast("string"))) == want


GROUPS = {"North": ("%north_wing%", "%nw%"), "South": ("%south%",)}


def test_whole_days_are_24_hours(spark):
    start, end = F.lit(D), F.lit(D + timedelta(days=7) - timedelta(seconds=1))
    assert one(spark, times.whole_days(start, end)) == 6 and one(spark, times.seconds_between(start, end)) == 7 * 86400 - 1


def test_text_columns(spark):
    assert one(spark, text.image_key(F.lit("\t IMG \n"))) == "img" and one(spark, text.image_key(F.lit("  "))) is None
    assert one(spark, text.same_text(F.lit("A"), F.lit("a"))) and not one(spark, text.same_text(F.lit("A"), F.lit(None).cast("string")))
    assert one(spark, text.same_text(F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert one(spark, text.joined_set(F.lit(["b", "a", "b"]))) == "a;b" and one(spark, text.joined_set(F.array().cast("array<string>"))) is None
    assert one(spark, text.set_of(F.lit("b;;a;b"))) == ["a", "b"] and one(spark, text.whole_number(F.lit("x7"))) == 0
    assert one(spark, text.renamed(F.lit("a.b.c"), [("n", "a.b"), ("m", "a")])) == "n.c" and one(spark, text.renamed(F.lit("ab.c"), [("n", "a")])) == "ab.c"
    assert one(spark, reporting.processing_group([F.lit("x"), F.lit("team NORTHxWING")], GROUPS)) == "North"


def test_aes_wrong_key(spark):
    good, bad = F.lit(bytes(range(32))), F.lit(bytes(32))
    cipher = crypto.encrypt(F.lit("secret"), good)
    assert one(spark, crypto.decrypt(cipher, good)) == "secret" and one(spark, crypto.try_decrypt(cipher, bad)) is None
    rows = spark.createDataFrame([("k", "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo=")], "key_id string, payload string")
    with pytest.raises(Exception, match="no key"):
        crypto.decrypted(rows, spark.createDataFrame([], "key_id string, dek binary")).collect()


def test_routing_parts_and_filters(spark):
    segments = (Segment("main", "ai", "h"), Segment("parts", "ai", "p", None, (SubType("one", "x", "y"), SubType("two", "y"))))
    rows = [("k", "ai", '{"img":" A "}', D), ("k", "h", '{"img":"b","f":"1"}', D), ("k", "h", '{"img":" "}', D), ("k", "p", '{"img":"c","x":null}', D), ("k", "p", '{"img":"c","x":1,"y":1}', D), ("k", "p", '{"img":"c"}', D), ("k", "zz", '{"img":"c"}', D)]
    df = spark.createDataFrame(rows, "key_id string, method string, payload string, created_at timestamp")
    got = {(r.image_id, r.segment, r.side, r.sub_type) for r in keyed(df, segments, "img").collect()}
    assert got == {("a", "main", "ai", None), ("a", "parts", "ai", None), ("b", "main", "human", "default"), ("c", "parts", "human", "one"), ("c", "parts", "human", "two")}
    kept = keyed(df, segments, "img", "f", "1").where("side = 'human'").collect()
    assert [r.image_id for r in kept] == ["b"]


FIELD = "pair int, field string, match_key string, place int, value string, case_id string"


def test_values_without_key_do_not_count_in_a_keyed_field(spark):
    h = spark.createDataFrame([(1, "a", None, 0, "x", None), (1, "a", "k", 1, "y", "c1"), (1, "b", None, 0, None, None)], FIELD)
    a = spark.createDataFrame([(1, "a", "k", 0, "Y", None), (1, "a", "k", 1, "z", None)], FIELD)
    got = {(r.field_name, r.array_key, r.ordinal): (r.human_value, r.ai_value, r.is_match) for r in compare.compared(h, a).collect()}
    assert got == {("a", "k", 1): ("y", "Y", True), ("a", "k", 2): (None, "z", False), ("b", None, 1): (None, None, True)}


def test_mappings_concatenate(spark):
    a = spark.createDataFrame([(1, "old.x", None, 0, "1", None), (1, "new.x", None, 0, "2", None), (1, "older", None, 0, "3", None)], FIELD)
    got = sorted((r.field, r.place, r.value) for r in compare.with_mappings(a, [("new", "old")]).collect())
    assert got == [("new.x", 0, "2"), ("new.x", 1, "1"), ("older", 0, "3")]


def test_case_of_ai_only_items(spark):
    ddl = "pair int, field_name string, array_key string, human_value string, ai_value string, human_case string, ai_case string"
    rows = [(1, "one.x", "k1", "v", "v", "c1", None), (1, "one.x", "k2", None, "v", None, None), (1, "two.x", "k1", "v", "v", "c1", None), (1, "two.x", "k2", "v", "v", "c2", None), (1, "two.x", "k3", None, "v", None, None), (1, "two.y", "k2", None, "v", None, None), (1, "deep.a.b", None, "v", "v", None, None), (1, "other", None, None, "v", None, None)]
    notes = spark.createDataFrame([(1, "deep", "c1"), (1, "deep.a", "c2")], "pair int, path string, case_id string")
    got = attribution.with_case(spark.createDataFrame(rows, ddl), notes, spark.createDataFrame([(1, "c9")], "pair int, canonical_case_id string"))
    assert {(r.field_name, r.array_key): r.case_id for r in got.collect()} == {
        ("one.x", "k1"): "c1", ("one.x", "k2"): "c1", ("two.x", "k1"): "c1", ("two.x", "k2"): "c2", ("two.x", "k3"): None, ("two.y", "k2"): "c2", ("deep.a.b", None): "c2", ("other", None): "c9",
    }


def test_as_of_is_strictly_before(spark):
    left = spark.createDataFrame([(1, "a", D), (2, "b", D)], "id int, k string, at timestamp")
    right = spark.createDataFrame([("a", D), ("a", D - timedelta(hours=1)), ("a", D - timedelta(hours=2))], "k string, seen timestamp")
    got = {r.id: r.out for r in relational.as_of_latest(left, right, ["k"], "at", "seen", "out").collect()}
    assert got == {1: D - timedelta(hours=1), 2: None}


def test_report_star(spark):
    make = spark.createDataFrame
    images = make([("f1", D, "q"), ("f1", D - timedelta(days=1), "q")], "file_name string, load_date timestamp, queue string")
    outcomes = make([("f1", "done"), ("f1", None)], "file_name string, final_action string")
    attached = make([("f1", "case1")], "name string, case_id string")
    cases = make([("case1", None)], "id string, parent_id string")
    events = make([("e1", "case1", "u1", "7;8", "Document Review", D), ("e2", "case1", "u1", None, "x", D)], "id string, what_id string, owner_id string, confirmation_number string, event_category string, end_at timestamp")
    history = make([("case1", "Owner", "u1", "2026-04-24T10:00:00.000+0000"), ("case1", "Owner", "u1", "2026-04-24T11:00:00.000+0000")], "case_id string, field string, new_value string, created_date string")
    users = make([("u1", "r1", "A", "B", "north wing", None, None, None)], "id string, user_role_id string, first_name string, last_name string, location string, company string, department string, division string")
    roles = make([("r1", "n", None, None)], "id string, name string, rollup string, developer_name string")
    (row,) = reporting.case_processing(images, outcomes, attached, cases, events, history, users, roles, GROUPS).collect()
    assert row.processing_seconds == 1800 and row.assignment_to_doc_review_seconds == 1800 and row.processing_group == "North" and row.user_name == "A B" and row.end_time.hour == 6


def test_audit_and_guardrails(spark):
    spark.createDataFrame([("2020-01-01T00:00:00Z", 1), ("bad", 2), (None, 3)], "created_at string, v int").createOrReplaceTempView("aud_a")
    spark.createDataFrame([(1,)], "v int").createOrReplaceTempView("aud_b")
    tables, columns = scans.tables_of(spark, {"d": ["aud_a", "aud_b"], "_hidden": ["aud_a"]})
    tables = tables.withColumn("table_type", F.lit("BASE TABLE"))
    storage = spark.createDataFrame([("d", "aud_a", 3, 1 << 30, False), ("d", "aud_a", 9, 9 << 30, True)], "dataset string, table_name string, total_rows long, total_bytes long, deleted boolean")
    plan = audit.audit_plan(tables, columns, storage, 0.5, 1.0, 10)
    found, unchecked, errors = audit.audit(spark, plan, F.lit(D))
    row = found.first()
    assert (row.n_dated, row.n_old, row.n_unreadable) == (1, 1, 1) and [(r.table_name, r.reason) for r in unchecked.collect()] == [("aud_b", "no date-like column")] and errors.isEmpty()
    report = audit.audit_report(found, storage).first()
    assert (report.pct_old, report.table_gb, report.est_old_gb) == (33.3, 1.0, 0.33)
    for args, reason in (((2.0, 1.0), "below min_table_gb"), ((0.5, 1e-9), "too large (~0.0 GB estimated scan)")):
        reasons = {r.table_name: r.reason for r in audit.audit(spark, audit.audit_plan(tables, columns, storage, *args, 10), F.lit(D))[1].collect()}
        assert reasons["aud_a"] == reason
    batch = spark.createDataFrame([("g/1", "g", D)], "path string, collection_group string, scanned timestamp")
    assert audit.guarded(batch, ["g"], 5, F.col("scanned"), F.lit(D - timedelta(days=1))) is batch
    for bad in ((batch.limit(0), ["g"], 5), (batch, ["h"], 5), (batch, ["g"], 0)):
        with pytest.raises(ValueError):
            audit.guarded(*bad, F.col("scanned"), F.lit(D - timedelta(days=1)))


def test_a_table_that_fails_when_read_ends_no_other_batch(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for folder in (good, bad):
        spark.createDataFrame([(D,)], "created_at timestamp").write.parquet(folder)
    spark.read.parquet(good).createOrReplaceTempView("audit_good"), spark.read.parquet(bad).createOrReplaceTempView("audit_bad")
    for file in (tmp_path / "bad").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    tables, columns = scans.tables_of(spark, {"d": ["audit_good", "audit_bad"]})
    storage = scans.storage_of(spark, {("d", "audit_good"): good})
    assert storage.first().total_rows == 1 and storage.first().total_bytes > 100
    plan = audit.audit_plan(tables.withColumn("table_type", F.lit("SNAPSHOT")), columns, storage, 0, 1, 1)
    assert [r.tables_in_batch for r in audit.audit_batches(plan).collect()] == ["d.audit_bad", "d.audit_good"]
    found, unchecked, errors = audit.audit(spark, plan, F.lit(D))
    assert [r.table_name for r in found.collect()] == ["audit_good"] and [r.tables_in_batch for r in errors.collect()] == ["d.audit_bad"]
    assert [(r.table_name, r.reason) for r in unchecked.collect()] == [("audit_bad", "batch failed")]


def test_tables_of_one_name(spark, tmp_path):
    """Two datasets with a table of one name are read apart."""
    try:
        for name, n in (("aud_one", 2), ("aud_two", 5)):
            spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
            spark.range(n).select(F.lit("2020-01-01T00:00:00Z").alias("created_at")).write.saveAsTable(f"{name}.same", path=f"{tmp_path}/{name}/same")
        tables, columns = scans.tables_of(spark, {"aud_one": ["same"], "aud_two": ["same"]})
        storage = scans.storage_of(spark, {(d, "same"): f"{tmp_path}/{d}/same" for d in ("aud_one", "aud_two")})
        found, unchecked, errors = audit.audit(spark, audit.audit_plan(tables, columns, storage, 0.0, 1.0, 1), F.lit(D))
        assert {r.dataset: r.n_dated for r in found.collect()} == {"aud_one": 2, "aud_two": 5} and unchecked.isEmpty() and errors.isEmpty()
        listed = {(r.database, r.table_name): r.location for r in scans.dataset_options(spark).collect()}
        assert listed["aud_one", "same"].endswith("/aud_one") and ("aud_two", "same") in listed
    finally:
        for name in ("aud_one", "aud_two"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_listed_documents(spark):
    body = '{"documents": [{"name": "a/x/b/1", "createTime": "2020-01-01T00:00:00Z", "updateTime": "2021-01-01T00:00:00Z"}, {"name": "a/x/b/2"}], "nextPageToken": "t2"}'
    pages = spark.createDataFrame([("", body), ("t3", '{"documents": [], "nextPageToken": ""}'), ("t4", "{}")], "page_token string, body string")
    rows = scans.listed_documents(pages)
    assert [r.page_token for r in scans.missing_pages(pages).collect()] == ["t2"] and rows.count() == 2
    row = rows.orderBy("path").select("create_time", *scans.path_parts()).first()
    assert (row.create_time, row.collection_group, row.parent, row.depth) == (datetime(2020, 1, 1), "b", "a/x", 2)
    seen = scans.scan_ranges(rows, "path", ["a/x/b/2", "a/x/b/0"], datetime(2022, 1, 1)).collect()
    assert [(r.path, r.range_no) for r in seen] == [("a/x/b/1", 1)] and scans.key_ranges([]) == [(0, None, None)]


def test_numbers_do_not_depend_on_the_borders(spark):
    df = spark.createDataFrame([(i * 7919 % 1000 // 3, None if i % 50 == 0 else f"k{i % 13}", i) for i in range(1000)], "a int, b string, c int").repartition(7)
    want = {r.c: i + 1 for i, r in enumerate(df.orderBy("b", "a", "c").collect())}
    for slots in (1, 5, 64):
        got = relational.numbered_batches(df, ["b", "a", "c"], 100, slots).collect()
        assert {r.c: r.n for r in got} == want and all(r.batch == (r.n - 1) // 100 for r in got)
    assert relational.numbered_batches(df.limit(0), ["a"], 10).count() == 0


def test_as_of_keeps_wall_times_apart(spark):
    """Two wall times that are one moment in a zone with summer time are still in order."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = "timestamp_ntz"
        left = spark.sql(f"SELECT 'a' AS k, {at}'2024-03-10 03:10:00' AS t")
        right = spark.sql(f"SELECT 'a' AS k, {at}'2024-03-10 02:30:00' AS seen")
        assert str(relational.as_of_latest(left, right, ["k"], "t", "seen", "out").first().out) == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_state_and_checkpoint(spark, tmp_path):
    c = state.Checkpoint(spark, str(tmp_path / "c"))
    with pytest.raises(LookupError):
        c.claim(D)
    c.seed(D)
    window = c.claim(D + timedelta(hours=3), "me")
    assert c.claim(D + timedelta(hours=9), "me").current_stop == window.current_stop == D + timedelta(hours=3)
    assert c.revert(c.read()).current_stop == D and c.claim(D + timedelta(hours=4), "me").current_stop == D + timedelta(hours=4)
    df = spark.createDataFrame([(1, D), (2, D + timedelta(days=1))], "x int, load_time timestamp")
    out, ddl = str(tmp_path / "out"), "x int, load_time timestamp"
    assert state.committed(c, "t", out, ddl).count() == 0
    state.append_run(df, out, "r1", "load_time")  # an attempt that is never committed
    assert c.advance(c.read(), "v1", {"t": state.append_run(df.where("x = 1"), out, "r2", "load_time")}).version == "v1"
    assert c.read().last_extracted == D + timedelta(hours=4) and c.read().start == D + timedelta(hours=3)
    first = c.read().step
    c.advance(c.claim(D + timedelta(hours=5)), "v2", {"t": state.append_run(df, out, "r3", "load_time")})
    assert sorted((r.x, r.run) for r in state.committed(c, "t", out, ddl).collect()) == [(1, "r2"), (1, "r3"), (2, "r3")]
    assert [r.run for r in state.committed(c, "t", out, ddl, first).collect()] == ["r2"]  # as of the first commit
    assert state.vacuum(c, out) == [] and state.vacuum(c, out, timedelta(0)) == ["run=r1"]
    parts = {r.partition_id: r.total_rows for r in scans.partitions_of(state.committed(c, "t", out, ddl), "day").collect()}
    assert sorted(parts.values()) == [1, 2]
    assert state.drop_before(spark, out, str((D + timedelta(days=1)).date())) == [f"run=r2/day={D.date()}", f"run=r3/day={D.date()}"]
    assert state.committed(c, "t", out, ddl).count() == 1
    state.remove(spark, f"{out}/run=r2")
    assert state.committed(c, "t", out, ddl).count() == 1
    with pytest.raises(Exception, match="null in key_id"):
        schemas.fitted(spark.createDataFrame([("x",)], "image_id string"), schemas.AI_PENDING).collect()


def test_one_driver_has_the_window(spark, tmp_path):
    path, now = str(tmp_path / "c"), [1000.0]
    first, second = (state.Checkpoint(spark, path, 60.0, lambda: now[0]) for _ in range(2))
    first.seed(D)
    mine = first.claim(D + timedelta(hours=1), "first")
    with pytest.raises(state.Held):
        second.claim(D + timedelta(hours=2), "second")
    now[0] += 50
    mine = first.renew(mine)
    now[0] += 50  # renewed, so the lease still holds
    with pytest.raises(state.Held):
        second.claim(D + timedelta(hours=2), "second")
    now[0] += 20  # the first driver is silent for longer than its lease: the window goes over, as it was
    taken = second.claim(D + timedelta(hours=2), "second")
    assert taken.current_stop == mine.current_stop and taken.step > mine.step
    for late in (lambda: first.renew(mine), lambda: first.advance(mine, "v1", {"t": "run=x"}), lambda: first.revert(mine)):
        with pytest.raises(state.Fenced):
            late()
    first.release(mine)
    with pytest.raises(state.Held):  # a release behind the loss changes nothing
        first.claim(D + timedelta(hours=3), "first")
    second.advance(taken, "v2", {"t": "run=y"})
    assert [c["outputs"] for c in first.commits()] == [{"t": "run=y"}] and first.read().version == "v2"


def test_many_drivers_claim_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "c")
    state.Checkpoint(spark, path).seed(D)

    def claim(n):
        try:
            return state.Checkpoint(spark, path).claim(D + timedelta(hours=n + 1), f"d{n}").owner
        except state.Held:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = [x for x in pool.map(claim, range(16)) if x]
    assert len(got) == 1 and state.Checkpoint(spark, path).read().owner == got[0]
    ledger = Ledger(spark, str(tmp_path / "l"))
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda n: ledger.append({"n": n}), range(24)))
    assert sorted(numbers) == list(range(24)) == ledger.numbers() and sorted(ledger.get(i)["n"] for i in range(24)) == list(range(24))


def test_tables_over_what_is_written(spark, tmp_path):
    row = ("i", "k", "main", None, 1, D, D, "f", None, None, "x", "y", False, D)
    results = spark.createDataFrame([row], schemas.RESULTS.replace(" not null", ""))
    state.append_run(results, str(tmp_path / "t"), "r1", "load_time")
    spark.sql(schemas.create_table("comparison_results", str(tmp_path / "t")))
    try:
        spark.sql("ALTER TABLE comparison_results RECOVER PARTITIONS")
        found = spark.table("comparison_results")
        assert found.count() == 1 and found.first().run == "r1" and {"run", "day"} < set(found.columns)
        pending = spark.createDataFrame([("human", D)], "pending_type string, first_seen_at timestamp")
        views.create_views(spark, found, pending)
        assert spark.table("comparison_results_clean").count() == spark.table("comparison_results_latest").count() == 1
        assert spark.table("pending_by_age").first().age_bucket == "7+ days"
    finally:
        spark.sql("DROP TABLE comparison_results")


def test_windowed_stream(spark, tmp_path):
    from braidwork.streaming.micro import windowed_counts

    rows = [(D, "a"), (D + timedelta(hours=1), "a"), (D + timedelta(days=9), "b"), (D + timedelta(days=20), "b")]
    spark.createDataFrame(rows, "ts timestamp, event_type string").write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "k")).outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(90)
    got = {(r.event_type, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert ("a", 2) in got


def test_queries_and_sql_agree_in_names():
    from braidwork.plans import queries

    assert set(queries.SQL) <= set(queries.QUERIES) and len(queries.QUERIES) > 50
