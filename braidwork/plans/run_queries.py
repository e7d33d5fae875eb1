"""Registered queries over what runs, migrations, clustered tables and streams leave behind, beside SQL over the sources.

Each writes to a new folder of the shared store and reads back what has been committed there.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions import payload as P
from braidwork.functions.merging import Policy
from braidwork.operators import attribution, audit, compare, reporting
from braidwork.operators.reporting import Measure
from braidwork.plans import run as runs
from braidwork.plans import schemas
from braidwork.plans.config import Options, Segment
from braidwork.plans.migrations import Database, migrations
from braidwork.plans.queries import LINES_A_TASK, query, table
from braidwork.sources import scans, state
from braidwork.sources.clustered import ClusteredTable
from braidwork.sources.ledger import shared_folder
from braidwork.streaming import ageing

START = datetime(2026, 5, 1, 9)


def _sources(spark: SparkSession, sf_dir: str, folder: str) -> Options:
    """Payloads of orders: three quarters have a human one, two thirds an AI one, and some get another AI one later."""
    orders = table(spark, sf_dir, "orders")
    at = lambda hours: F.lit(START + timedelta(hours=hours)).cast("timestamp")
    image = F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("img")
    human = F.to_json(F.struct(image, F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")))
    ai = lambda priority: F.to_json(F.struct(image, F.lower("o_orderstatus").alias("status"), priority.alias("priority")))
    rows = lambda where, method, payload, hours, *more: orders.where(where).select(F.lit("k").alias("key_id"), F.lit(method).alias("method"), payload.alias("payload"), *more, at(hours).alias("created_at"))
    case = F.concat(F.lit("c"), (F.col("o_orderkey") % 9).cast("string")).alias("case_id")
    rows("o_orderkey % 4 <> 0", "submit", human, -2, case).write.parquet(f"{folder}/human")
    first = rows("o_orderkey % 3 <> 0", "ai", ai(F.col("o_orderpriority")), -1)
    first.unionByName(rows("o_orderkey % 4 <> 0 and o_orderkey % 5 = 0", "ai", ai(F.lit("changed")), 1)).write.parquet(f"{folder}/ai")
    return Options(f"{folder}/ai", f"{folder}/human", f"{folder}/state", f"{folder}/results", f"{folder}/dead", f"{folder}/checkpoint", (Segment("main", "ai", "submit"),), image_path="img", human_lookback_days=1)


def _reconciled(spark: SparkSession, sf_dir: str, until: int = 2) -> tuple[Options, runs.Summary]:
    """Runs at the start, three hours later and after eight days. A driver dies before the second one, behind the write of
    rows that it never commits; its lease has ended when the second run takes the window over."""
    options = _sources(spark, sf_dir, shared_folder(spark))
    state.Checkpoint(spark, options.checkpoint).seed(START - timedelta(hours=3))
    done = runs.run(spark, options, START)
    dying = state.Checkpoint(spark, options.checkpoint, lease_seconds=0.0)
    lost = dying.claim(START + timedelta(hours=3), "dying")
    state.append_run(runs.results(spark, options).drop("run", "day"), options.results, f"{lost.step:06d}-lost", "load_time")
    done = runs.run(spark, options, START + timedelta(hours=9))
    if until > 2:
        done = runs.run(spark, options, START + timedelta(days=8, hours=9))
    try:  # the dead driver comes back, too late
        dying.advance(lost, "lost", {"results": f"run={lost.step:06d}-lost"})
    except state.Fenced:
        pass
    return options, done


_RUN_SQL = """
WITH o AS (SELECT *, 'o-' || o_orderkey AS image_id, o_orderkey % 4 <> 0 AS human, o_orderkey % 3 <> 0 AS first, o_orderkey % 4 <> 0 AND o_orderkey % 5 = 0 AS second FROM orders),
c AS (
  SELECT *, 1 AS n, o_orderpriority AS ai_priority FROM o WHERE human AND first
  UNION ALL SELECT *, 1 + first::INT, 'changed' FROM o WHERE second)
"""


@query(f"""{_RUN_SQL}
SELECT image_id, f.field_name, n::INT AS ai_iteration, 'c' || (o_orderkey % 9) AS case_id, CASE f.field_name WHEN 'img' THEN 'O-' || o_orderkey WHEN 'status' THEN o_orderstatus ELSE o_orderpriority END AS human_value,
       CASE f.field_name WHEN 'img' THEN 'O-' || o_orderkey WHEN 'status' THEN lower(o_orderstatus) ELSE ai_priority END AS ai_value, f.field_name <> 'priority' OR ai_priority <> 'changed' AS is_match
FROM c, (VALUES ('img'), ('status'), ('priority')) f(field_name)""")
def run_results(spark, sf_dir):
    """Committed results of two runs, with a lost attempt between them."""
    options, _ = _reconciled(spark, sf_dir)
    return runs.results(spark, options).select("image_id", "field_name", "ai_iteration", "case_id", "human_value", "ai_value", "is_match")


@query(f"""{_RUN_SQL}
SELECT image_id, 'human' AS pending_type, 'No matching AI iteration within 7 days' AS reason FROM o WHERE human
UNION ALL SELECT image_id, 'ai', 'No matching human payload within 7 days' FROM o WHERE first
UNION ALL SELECT image_id, 'ai', 'No matching human payload within 7 days' FROM o WHERE second""")
def run_dead_letters(spark, sf_dir):
    """What three runs have let go after a week."""
    options, _ = _reconciled(spark, sf_dir, 3)
    return runs.dead_letters(spark, options).select("image_id", "pending_type", "reason")


@query(f"""{_RUN_SQL}
SELECT image_id, 'human' AS kind, 1::BIGINT AS retry_count, (first::INT + second::INT)::BIGINT AS comparison_version FROM o WHERE human
UNION ALL SELECT image_id, 'ai', 1, NULL FROM o WHERE first UNION ALL SELECT image_id, 'ai', 0, NULL FROM o WHERE second""")
def run_state(spark, sf_dir):
    """The state that counts after two runs: waiting groups and the pool of AI payloads."""
    options, done = _reconciled(spark, sf_dir)
    pending = state.read_version(spark, f"{options.state}/pending", done.version, schemas.PENDING).select("image_id", F.lit("human").alias("kind"), "retry_count", "comparison_version")
    pool = state.read_version(spark, f"{options.state}/pool", done.version, schemas.AI_PENDING).select("image_id", F.lit("ai").alias("kind"), "retry_count")
    return pending.unionByName(pool, allowMissingColumns=True)


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1996-05-01'")
def clustered_scan(spark, sf_dir):
    """Lines clustered by their day: a scan reads the folders and row groups of two months."""
    lines = ClusteredTable(spark, shared_folder(spark), ["l_shipdate", "l_orderkey"])
    lines.replace(table(spark, sf_dir, "lineitem"), START, ranges=16, row_group_bytes=1 << 20)
    found = lines.scan(F.lit(datetime(1996, 3, 1)).cast("timestamp_ntz"), F.lit(datetime(1996, 5, 1)).cast("timestamp_ntz"))
    return found.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query("SELECT doc_id, source, n_chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents WHERE doc_id >= 50 AND doc_id < 90 OR doc_id >= 130 AND doc_id < 140")
def snapshot_key_ranges(spark, sf_dir):
    """Two key ranges of the documents as they were, read by parts while a later version has other texts and fewer rows."""
    docs, keys = table(spark, sf_dir, "documents"), ClusteredTable(spark, shared_folder(spark), ["doc_id"])
    keys.replace(docs, START, ranges=12, expected_rows=docs.count())
    keys.replace(keys.read().where("doc_id % 3 <> 0").withColumn("text", F.upper("text")), START + timedelta(hours=2))
    as_of = START + timedelta(hours=1)
    both = keys.scan(50, 90, as_of).unionByName(keys.scan(130, 140, as_of))
    return both.select("doc_id", "source", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("SELECT doc_id, n_chars FROM documents")
def scan_by_parts(spark, sf_dir):
    """All parts of a parallel scan together are the table, each row in one of them."""
    keys = ClusteredTable(spark, shared_folder(spark), ["doc_id"])
    keys.replace(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), START, ranges=12)
    found = None
    for part in keys.parts(5):
        rows = keys.read_part(part)
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else keys.read()


@query("""
SELECT o_orderkey::VARCHAR AS image_id, CASE WHEN o_orderkey % 3 = 0 THEN 'ai_pending_comparisons' ELSE 'pending_comparisons' END AS table_name,
       CASE WHEN o_orderkey % 3 <> 0 THEN 0 END::BIGINT AS next_ai_iteration, CASE WHEN o_orderkey % 3 <> 0 THEN 0 END::BIGINT AS comparison_version, NULL::VARCHAR AS merged_case_ids
FROM orders""")
def migrated_tables(spark, sf_dir):
    """The pending table of an earlier layout behind all migrations, and the pool that they split off."""
    orders = table(spark, sf_dir, "orders")
    pending = orders.select(
        F.col("o_orderkey").cast("string").alias("image_id"), F.lit("k").alias("key_id"), F.lit("main").alias("segment"), F.when(F.col("o_orderkey") % 3 == 0, "ai").otherwise("human").alias("pending_type"),
        F.col("o_comment" if "o_comment" in orders.columns else "o_orderpriority").alias("payload"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("first_seen_at"), F.col("o_orderdate").alias("last_retried_at"),
        F.lit(0).cast("long").alias("retry_count"), F.lit(2).alias("matched_ai_count"),
    )
    base = Database(spark, shared_folder(spark), {"pending_comparisons": ["first_seen_at"], "ai_pending_comparisons": ["first_seen_at"]})
    base.load({"pending_comparisons": pending}, START)
    base.migrate(migrations(), START + timedelta(hours=1))
    both = None
    for name in base.names():
        rows = base.read(name).withColumn("table_name", F.lit(name))
        both = rows if both is None else both.unionByName(rows, allowMissingColumns=True)
    return both.select("image_id", "table_name", "next_ai_iteration", "comparison_version", "merged_case_ids")


@query("""
WITH s AS (SELECT l_returnflag AS flag, l_orderkey, l_orderkey || '-' || l_linenumber AS line, l_suppkey, o_custkey, o_totalprice, c_acctbal FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
o AS (SELECT flag, count(*) AS n_orders, sum(p) AS order_total, max(p) AS largest_order FROM (SELECT flag, l_orderkey, min(o_totalprice)::DECIMAL(18,2) AS p FROM s GROUP BY ALL) GROUP BY flag),
c AS (SELECT flag, count(*) AS n_customers, round(avg(b), 4) AS average_balance FROM (SELECT flag, o_custkey, min(c_acctbal) AS b FROM s WHERE o_custkey IS NOT NULL GROUP BY ALL) GROUP BY flag),
l AS (SELECT flag, count(DISTINCT line) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers FROM s GROUP BY flag)
SELECT flag, n_lines, n_orders, n_customers, n_suppliers, order_total::DECIMAL(28,2) AS order_total, largest_order, average_balance FROM l LEFT JOIN o USING (flag) LEFT JOIN c USING (flag)""")
def symmetric_measures(spark, sf_dir):
    """Counts and sums by four primary keys of one star, each as if its table stood alone."""
    lines, orders, customers = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    parts = compare.parts_for(lines, LINES_A_TASK)
    rows = reporting.star(lines, [(orders, "l_orderkey", "o_orderkey"), (customers, "o_custkey", "c_custkey")], parts)
    rows = rows.select(F.col("l_returnflag").alias("flag"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "l_orderkey", "o_custkey", "l_suppkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "c_acctbal")
    found = reporting.symmetric_measures(rows, ["flag"], {
        "n_lines": Measure("line"), "n_orders": Measure("l_orderkey"), "n_customers": Measure("o_custkey"), "n_suppliers": Measure("l_suppkey"), "order_total": Measure("l_orderkey", "sum", "price"),
        "largest_order": Measure("l_orderkey", "max", "price"), "average_balance": Measure("o_custkey", "average", "c_acctbal"),
    }, parts)
    return found.withColumn("average_balance", F.round("average_balance", 4))


@query("""
WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS key, floor(epoch(ts))::BIGINT AS s, event_type = 'view' AS ai FROM events),
w AS (SELECT key, min(s) AS s FROM e GROUP BY key UNION ALL SELECT w.key, min(e.s) FROM w JOIN e ON e.key = w.key AND e.s >= w.s + 604800 GROUP BY w.key)
SELECT w.key, make_timestamp(w.s * 1000000) AS first_seen_at, count(*) FILTER (ai) AS n_ai, count(*) FILTER (NOT ai) AS n_human
FROM w JOIN e ON e.key = w.key AND e.s >= w.s AND e.s < w.s + 604800
WHERE (w.s + 604800) * 1000 <= (SELECT floor(epoch_ms(max(ts)))::BIGINT - 3600000 FROM events) GROUP BY w.key, w.s""")
def aged_groups_stream(spark, sf_dir):
    """Users' events as a stream: each group waits a week from its first event, then it is emitted."""
    own, folder = ageing.with_state_store(spark), shared_folder(spark)
    events = own.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/[e]vents.parquet")
    aged = ageing.aged_groups(events.withColumn("side", F.when(F.col("event_type") == "view", "ai").otherwise("human")), "user_id", "side", "ts")
    aged.writeStream.format("parquet").option("path", f"{folder}/aged").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string, first_seen_at timestamp, n_ai long, n_human long").parquet(f"{folder}/aged").withColumn("first_seen_at", F.col("first_seen_at").cast("timestamp_ntz"))


@query("""
WITH l AS (SELECT l_orderkey AS pair, 'k' || l_linenumber AS k, l_partkey, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 'c' || (l_suppkey % 2) END AS item_case FROM lineitem),
o AS (SELECT pair, k, min(item_case) AS lo FROM l GROUP BY pair, k),
a AS (SELECT pair, min(lo) AS alo, max(lo) AS ahi FROM o GROUP BY pair)
SELECT o.pair, 'lines.part' AS field_name, k AS array_key, CASE WHEN lo IS NOT NULL THEN lo WHEN alo IS NULL THEN 'noted' WHEN alo = ahi THEN alo END AS case_id FROM o JOIN a USING (pair)
UNION ALL SELECT o_orderkey, 'a.b', NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'inner' ELSE 'outer' END FROM orders UNION ALL SELECT o_orderkey, 'plain', NULL, 'main' FROM orders""")
def attributed_cases(spark, sf_dir):
    """A field's case: an item's own; of an item that only the AI has, its array's if that is of one case (none if of
    several); else the nearest note, else the pair's."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    case = F.when(F.col("l_linenumber") % 4 != 0, F.concat(F.lit("c"), (F.col("l_suppkey") % 2).cast("string")))
    items = lines.groupBy(F.col("l_orderkey").alias("pair"), F.concat(F.lit("k"), F.col("l_linenumber").cast("string")).alias("array_key")).agg(F.min(case).alias("human_case"), F.min("l_partkey").cast("string").alias("ai_value"))
    items = items.select("pair", F.lit("lines.part").alias("field_name"), "array_key", F.when(F.col("human_case").isNotNull(), F.col("ai_value")).alias("human_value"), "ai_value", "human_case")
    plain = orders.select(F.col("o_orderkey").alias("pair"), F.explode(F.array(F.lit("a.b"), F.lit("plain"))).alias("field_name"), F.lit(None).cast("string").alias("array_key"), F.lit("x").alias("human_value"), F.lit("x").alias("ai_value"), F.lit(None).cast("string").alias("human_case"))
    even = F.col("o_orderkey") % 2 == 0
    notes = orders.select(F.col("o_orderkey").alias("pair"), F.inline(F.array(F.struct(F.lit("a").alias("path"), F.lit("outer").alias("case_id")), F.struct(F.when(even, "a.b").otherwise("other").alias("path"), F.lit("inner").alias("case_id")), F.struct(F.lit("lines").alias("path"), F.lit("noted").alias("case_id")))))
    found = attribution.with_case(items.unionByName(plain), notes, orders.select(F.col("o_orderkey").alias("pair"), F.lit("main").alias("canonical_case_id")), compare.parts_for(lines, LINES_A_TASK))
    return found.select("pair", "field_name", "array_key", "case_id")


@query("""
SELECT o_orderkey AS pair, path, case_id FROM orders, (VALUES ('status', 'A'), ('extra.deep', 'A'), ('priority', 'B'), ('extra.more', 'B')) n(path, case_id) WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, path, 'A' FROM orders, (VALUES ('status'), ('priority'), ('extra'), ('extra.deep')) n(path) WHERE o_orderkey % 3 <> 0""")
def noted_cases(spark, sf_dir):
    """The case of every field, from the notes that payloads carry through a merge: a later case takes the field that
    both have and adds its own."""
    orders = table(spark, sf_dir, "orders")
    first = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.struct(F.lit(1).alias("deep")).alias("extra")))
    second = F.to_json(F.struct(F.lit("changed").alias("priority"), F.struct(F.lit(2).alias("more")).alias("extra")))
    version = lambda payload, case, at: F.struct(payload.alias("payload"), F.lit(case).alias("case_id"), F.lit(at).alias("at"))
    versions = F.when(F.col("o_orderkey") % 3 == 0, F.array(version(first, "A", "1"), version(second, "B", "2"))).otherwise(F.array(version(first, "A", "1")))
    rows = orders.select(F.col("o_orderkey").alias("pair"), F.lit("main").alias("segment"), F.inline(versions))
    rows = rows.withColumn("payload", P.stamped(F.col("payload"), F.col("case_id"), {"main": Policy()}, F.col("segment")))
    merged = P.folded(rows, ["pair"], ["at"], {"main": Policy()})
    return merged.select("pair", F.inline(P.cases_taken(F.col("payload")).getField("notes")))


@query("""
WITH i AS (SELECT o_orderkey::VARCHAR AS file_name, o_orderdate AS load_date FROM orders WHERE o_orderkey % 5 <> 0),
ev AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_orderkey, l_linenumber, l_suppkey % 3 AS u, l_shipdate AS end_at FROM lineitem WHERE l_linenumber <> 2),
h AS (SELECT o_orderkey, n AS u, o_orderdate + to_days(3 * n) AS seen FROM orders, (VALUES (0), (1), (2)) t(n)),
t AS (SELECT ev.*, (SELECT max(seen) FROM h WHERE h.o_orderkey = ev.l_orderkey AND h.u = ev.u AND h.seen < ev.end_at) AS assigned FROM ev)
SELECT file_name, id AS event_id, (epoch(end_at) - epoch(assigned))::BIGINT AS processing_seconds, CASE u WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE 'Other' END AS processing_group, 'U ' || u AS user_name
FROM t JOIN i ON i.file_name = t.l_orderkey::VARCHAR WHERE assigned IS NOT NULL AND l_orderkey % 7 <> 0""")
def processed_cases(spark, sf_dir):
    """The case-processing report over the orders as images, each a case of its own, and their lines as events."""
    orders, lines, text = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), lambda c: F.col(c).cast("string")
    key, own = text("o_orderkey"), F.concat(F.lit("case"), F.col("o_orderkey").cast("string"))
    loads = F.explode(F.array(F.col("o_orderdate"), F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")))
    images = orders.select(key.alias("file_name"), loads.alias("load_date"))
    outcomes = orders.where("o_orderkey % 5 <> 0").select(key.alias("file_name"), F.lit("done").alias("final_action"))
    attached = orders.select(key.alias("name"), own.alias("case_id"))
    cases = orders.select(own.alias("id"), F.when(F.col("o_orderkey") % 7 == 0, "parent").alias("parent_id"))
    events = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.concat(F.lit("case"), text("l_orderkey")).alias("what_id"), (F.col("l_suppkey") % 3).cast("string").alias("owner_id"),
        F.when(F.col("l_linenumber") != 2, text("l_partkey")).alias("confirmation_number"), F.lit("Document Review").alias("event_category"), F.col("l_shipdate").cast("timestamp").alias("end_at"),
    )
    numbers = F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("u")
    history = orders.select(own.alias("case_id"), "o_orderdate", numbers)
    history = history.select("case_id", F.lit("Owner").alias("field"), text("u").alias("new_value"), F.date_format(F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(3 * F.col("u")), "yyyy-MM-dd'T'HH:mm:ss.SSS+0000").alias("created_date"))
    none = F.lit(None).cast("string")
    wings = F.create_map(*[F.lit(x) for x in ("0", "the north wing", "1", "the south wing")])
    who = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 3).cast("string").alias("id")).distinct()
    users = who.select("id", F.lit("r").alias("user_role_id"), F.lit("U").alias("first_name"), F.col("id").alias("last_name"), wings[F.col("id")].alias("location"), none.alias("company"), none.alias("department"), none.alias("division"))
    roles = spark.createDataFrame([("r", "n", None, None)], "id string, name string, rollup string, developer_name string")
    found = reporting.case_processing(images, outcomes, attached, cases, events, history, users, roles, {"North": ["%north%"], "South": ["%south%"]})
    return found.select("file_name", "event_id", F.col("processing_seconds").cast("long"), "processing_group", "user_name")


@query("""
WITH l AS (SELECT DISTINCT l_returnflag AS flag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
v AS (SELECT flag, 'f' || (l_partkey % 20) AS field, l_suppkey::VARCHAR AS value, lpad(l_orderkey::VARCHAR, 12, '0') || '-' || lpad(l_linenumber::VARCHAR, 4, '0') || '-' || lpad(l_partkey::VARCHAR, 9, '0') || '-' || lpad(l_suppkey::VARCHAR, 9, '0') AS at_ FROM l)
SELECT flag, field, arg_max(value, at_) AS value FROM v GROUP BY flag, field""")
def merge_hot_keys(spark, sf_dir):
    """All lines' payloads merged into one record a flag: a third of all rows and more to a key, merged by ranges."""
    part = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    field = F.to_json(F.create_map(F.concat(F.lit("f"), (F.col("l_partkey") % 20).cast("string")), F.col("l_suppkey")))
    rows = lines.select("flag", F.lit("main").alias("segment"), field.alias("payload"), F.concat_ws("-", part("l_orderkey", 12), part("l_linenumber", 4), part("l_partkey", 9), part("l_suppkey", 9)).alias("at"))
    merged = P.folded(rows, ["flag"], ["at"], {"main": Policy()}, hot_rows=500)
    return merged.select("flag", F.inline(P.flattened(F.col("payload"), {}))).select("flag", "field", "value")


@query("""
SELECT 'orders' AS table_name, count(*) AS total_rows, true AS has_bytes, NULL::VARCHAR AS reason FROM orders
UNION ALL SELECT 'labels', count(*), true, 'no date-like column' FROM labels""")
def planned_by_storage(spark, sf_dir):
    """An audit plan by the sizes that the stored files themselves have."""
    folder, names = shared_folder(spark), ("orders", "labels")
    for name in names:
        table(spark, sf_dir, name).write.parquet(f"{folder}/{name}")
        spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(f"sized_{name}")
    tables, columns = scans.tables_of(spark, {"main": [f"sized_{n}" for n in names]})
    storage = scans.storage_of(spark, {("main", f"sized_{n}"): f"{folder}/{n}" for n in names})
    plan = audit.audit_plan(tables.withColumn("table_type", F.lit("BASE TABLE")), columns, storage, 0.0, 1000.0, 50)
    return plan.select(F.substring("table_name", 7, 99).alias("table_name"), "total_rows", (F.col("table_gb") > 0).alias("has_bytes"), "reason")
