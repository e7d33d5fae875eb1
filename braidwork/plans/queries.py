"""Registered queries: each applies operators of this library to whole tables, beside SQL that computes the same.

The SQL is relational: payloads are made from columns, so the expected fields can be written from the columns too.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidwork.functions import payload as P
from braidwork.functions import crypto, text, times
from braidwork.functions.merging import Policy
from braidwork.operators import attribution, audit, compare, pairing, relational, reporting, routing, views
from braidwork.plans import schemas
from braidwork.plans.config import Segment, SubType
from braidwork.sources import scans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = datetime(2001, 8, 2)
#: Lines that a task sorts or aggregates at once, where a query says how many partitions it takes.
LINES_A_TASK = 150_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str):
    return F.col(c).cast("string")


# scans, routing, sets


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-12-05' AND o_orderdate < TIMESTAMP '2001-06-03'")
def scan_lookback(spark, sf_dir):
    return scans.lookback(table(spark, sf_dir, "orders"), datetime(2001, 6, 3), "180 DAYS", "o_orderdate").select("o_orderkey", "o_orderdate")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 06:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'")
def scan_lookback_hours(spark, sf_dir):
    return scans.lookback(table(spark, sf_dir, "events"), datetime(2024, 1, 15, 12), "6 HOURS", "ts").select("event_id", "ts")


_SEGMENTS = (Segment("web", "view", "click"), Segment("shop", "view", "purchase"))


@query("SELECT e.event_id, e.event_type, m.side, m.segment FROM events e JOIN (VALUES ('view','ai','web'),('click','human','web'),('view','ai','shop'),('purchase','human','shop')) m(method, side, segment) ON e.event_type = m.method")
def method_fanout(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("method", F.col("event_type"))
    return routing.routed(rows, _SEGMENTS).select("event_id", "event_type", "side", "segment")


@query("SELECT 'orders' AS tag, o_orderkey AS key, o_totalprice AS amount FROM orders UNION ALL SELECT 'lines', l_orderkey, l_extendedprice FROM lineitem")
def union_tagged(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount"))
    return relational.tagged_union({"orders": orders, "lines": lines}).select("tag", "key", "amount")


@query("""
WITH k AS (SELECT o_custkey AS key, 1 AS a, 0 AS b, 0 AS c FROM orders UNION ALL SELECT l_suppkey, 0, 1, 0 FROM lineitem UNION ALL SELECT c_custkey, 0, 0, 1 FROM customer)
SELECT key, sum(a)::BIGINT AS n_orders, sum(b)::BIGINT AS n_lines, sum(c)::BIGINT AS n_customers FROM k GROUP BY key""")
def cogroup_presence(spark, sf_dir):
    frames = {"orders": ("orders", "o_custkey"), "lines": ("lineitem", "l_suppkey"), "customers": ("customer", "c_custkey")}
    return relational.presence({n: table(spark, sf_dir, t).select(F.col(c).alias("key")) for n, (t, c) in frames.items()}, ["key"])


# windows and aggregates of the pairing


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS n FROM orders) WHERE n = 1")
def keep_latest(spark, sf_dir):
    return relational.latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT doc_id, content_key FROM (SELECT doc_id, sha256(text) AS content_key, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def first_wins_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", crypto.sha256(F.col("text")).alias("content_key"))
    return relational.first_by(rows, ["content_key"], [F.col("doc_id")])


def _no_rows(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl.replace(" not null", ""))


def _pending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending rows, several for each order: one for each of its lines."""
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("image_id"), F.lit("main").alias("segment"), F.col("l_shipdate").alias("first_seen_at"), F.col("l_linenumber").cast("long").alias("retry_count"),
        F.col("l_returnflag").alias("last_compared_signature"), F.col("l_linenumber").cast("long").alias("comparison_version"), F.concat(F.lit("c"), (F.col("l_suppkey") % 3).cast("string")).alias("merged_case_ids"),
        F.concat(F.lit("c"), F.lpad(_text("l_partkey"), 9, "0")).alias("case_id"), F.col("l_shipdate").alias("created_at"),
    )


@query("""
SELECT user_id::VARCHAR AS image_id, event_type AS segment, min(ts) AS created_at, min(ts) + INTERVAL 1 HOUR AS first_seen_at, max(ts) AS last_retried_at, max(event_id % 5)::BIGINT AS retry_count
FROM events GROUP BY user_id, event_type, props""")
def pool_reconcile(spark, sf_dir):
    pool = table(spark, sf_dir, "events").select(
        _text("user_id").alias("image_id"), F.col("event_type").alias("segment"), F.col("props").alias("payload"), F.lit("k").alias("key_id"), F.col("ts").alias("created_at"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("first_seen_at"), F.col("ts").alias("last_retried_at"), (F.col("event_id") % 5).cast("long").alias("retry_count"),
    )
    return pairing.pool_reconciled(pool).select("image_id", "segment", "created_at", "first_seen_at", "last_retried_at", "retry_count")


@query("""
SELECT l_orderkey::VARCHAR AS image_id, min(l_shipdate) AS first_seen_at, max(l_linenumber)::BIGINT AS retry_count, max(l_linenumber)::BIGINT AS version, arg_max(l_returnflag, l_linenumber::BIGINT * 1000 + ascii(l_returnflag)) AS signature, max(l_shipdate) AS old_at,
       string_agg(DISTINCT 'c' || (l_suppkey % 3), ';' ORDER BY 'c' || (l_suppkey % 3)) AS cases
FROM lineitem GROUP BY l_orderkey""")
def pair_by_version(spark, sf_dir):
    found = pairing.pending_reconciled(_pending_lines(spark, sf_dir))
    return found.select("image_id", "first_seen_at", "retry_count", "version", "signature", "old_at", text.joined_set(F.col("cases")).alias("cases"))


@query("SELECT image_id, old_case FROM (SELECT l_orderkey::VARCHAR AS image_id, 'c' || lpad(l_partkey::VARCHAR, 9, '0') AS old_case, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) AS n FROM lineitem) WHERE n = 1")
def canonical_argmax(spark, sf_dir):
    return pairing.pending_reconciled(_pending_lines(spark, sf_dir)).select("image_id", "old_case")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS merged_case_ids FROM orders GROUP BY o_custkey")
def lineage_set(spark, sf_dir):
    return attribution.lineage(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


@query("SELECT conv_id::VARCHAR AS image_id FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id HAVING count(DISTINCT role) = 2")
def complete_all_of(spark, sf_dir):
    """Groups that have all parts of their segment."""
    segment = Segment("talk", "a", "h", None, (SubType("assistant", "said"), SubType("user", "asked", is_base=True)))
    said = F.to_json(F.struct(F.when(F.col("role") == "user", F.col("turn")).alias("asked"), F.when(F.col("role") != "user", F.col("turn")).alias("said")))
    fresh = table(spark, sf_dir, "conversations").where("role in ('user', 'assistant')").select(
        F.lit("human").alias("side"), _text("conv_id").alias("image_id"), F.lit("talk").alias("segment"), F.col("role").alias("sub_type"), said.alias("payload"), F.lit(None).cast("string").alias("case_id"),
        F.lit("k").alias("key_id"), F.timestamp_add("SECOND", F.col("turn"), F.lit(AS_OF)).alias("created_at"),
    )
    return pairing.human_state(fresh, _no_rows(spark, schemas.PENDING), (segment,)).where("complete").select("image_id")


@query("""
WITH p AS (SELECT user_id, max(ts) AS m FROM events WHERE event_type = 'view' AND user_id % 2 = 0 GROUP BY user_id),
n AS (SELECT event_id, e.user_id, ts, m, row_number() OVER w AS i, first_value(ts) OVER w AS f FROM events e LEFT JOIN p USING (user_id) WHERE event_type <> 'view'
      WINDOW w AS (PARTITION BY e.user_id ORDER BY ts, event_id))
SELECT event_id, CASE WHEN m IS NULL THEN f + to_seconds(i - 1) ELSE m + to_seconds(i) END AS created_at FROM n""")
def ts_bump(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").alias("created_at"), F.lpad(_text("event_id"), 12, "0").alias("payload"))
    new, known = rows.where("event_type <> 'view'"), rows.where("event_type = 'view' and user_id % 2 = 0")
    return pairing.stepped_times(new, known, F.lit(AS_OF).cast("timestamp_ntz"), ["user_id"]).select("event_id", "created_at")


@query("SELECT image_id, payload, created_at FROM (SELECT o_custkey::VARCHAR AS image_id, o_orderkey::VARCHAR AS payload, o_orderdate AS created_at, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_only(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("image_id"), F.lit("main").alias("segment"), _text("o_orderkey").alias("payload"), F.lit("k").alias("key_id"), F.col("o_orderdate").alias("created_at"), F.lpad(_text("o_orderkey"), 12, "0").alias("content_key"),
    )
    return pairing.latest_ai(rows).select("image_id", "ai.payload", "ai.created_at")


_MAIN = (Segment("main", "ai", "h"),)


@query("""
SELECT o_orderkey::VARCHAR AS image_id, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 4 END::BIGINT AS comparison_version, o_orderstatus AS human_status, lower(o_orderstatus) AS ai_status
FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def changed_only(spark, sf_dir):
    """Pairs are compared only if their contents are not those of the last comparison: orders without one (multiples of
    7) and orders whose last one was of other contents (of 11)."""
    orders = table(spark, sf_dir, "orders")
    human, ai = F.to_json(F.struct(F.col("o_orderstatus").alias("s"))), F.to_json(F.struct(F.lower("o_orderstatus").alias("s")))
    now, earlier = F.lit(AS_OF).cast("timestamp"), F.timestamp_add("DAY", F.lit(-2), F.lit(AS_OF).cast("timestamp"))
    key = [_text("o_orderkey").alias("image_id"), F.lit("main").alias("segment"), F.lit("k").alias("key_id")]
    sides = F.array(F.struct(F.lit("human").alias("side"), F.lit("default").alias("sub_type"), human.alias("payload")), F.struct(F.lit("ai").alias("side"), F.lit(None).cast("string").alias("sub_type"), ai.alias("payload")))
    fresh = orders.select(*key, F.lit(None).cast("string").alias("case_id"), now.alias("created_at"), F.inline(sides))
    last = F.when(F.col("o_orderkey") % 11 == 0, "other").otherwise(F.concat_ws("|", P.content_signature(human), P.content_signature(ai)))
    pending = orders.where("o_orderkey % 7 <> 0").select(
        *key, F.lit(None).cast("string").alias("case_id"), F.lit("human").alias("pending_type"), human.alias("payload"), earlier.alias("created_at"), earlier.alias("first_seen_at"), earlier.alias("last_retried_at"),
        F.lit(0).cast("long").alias("retry_count"), F.lit(None).cast("string").alias("merged_case_ids"), last.alias("last_compared_signature"), F.lit(3).cast("long").alias("comparison_version"),
    )
    found = pairing.pair(fresh, pending, _no_rows(spark, schemas.AI_PENDING), _MAIN, AS_OF).matched
    return found.select("image_id", "comparison_version", F.get_json_object("payload", "$.s").alias("human_status"), F.get_json_object("ai_payload", "$.s").alias("ai_status"))


@query("SELECT event_id::VARCHAR AS image_id, CASE WHEN epoch_us(TIMESTAMP '2024-01-20') - epoch_us(ts) >= 7 * 86400000000 THEN 'AGED_OUT' ELSE 'PENDING' END AS route, 1 + event_id % 4 AS retry_count FROM events")
def age_route(spark, sf_dir):
    """AI payloads that still wait for a human one, and those that have waited for a week."""
    seen = F.col("ts").cast("timestamp")
    pool = table(spark, sf_dir, "events").select(
        _text("event_id").alias("image_id"), F.lit("k").alias("key_id"), F.lit("main").alias("segment"), F.col("props").alias("payload"), seen.alias("created_at"), seen.alias("first_seen_at"),
        seen.alias("last_retried_at"), (F.col("event_id") % 4).cast("long").alias("retry_count"),
    )
    fresh = _no_rows(spark, "image_id string, segment string, side string, sub_type string, payload string, case_id string, key_id string, created_at timestamp")
    routes = pairing.pair(fresh, _no_rows(spark, schemas.PENDING), pool, _MAIN, datetime(2024, 1, 20))
    return relational.tagged_union({"PENDING": routes.ai_pending, "AGED_OUT": routes.ai_aged}, "route").select("image_id", "route", "retry_count")


@query("""
SELECT o_orderkey::VARCHAR AS image_id, CASE WHEN o_orderkey % 3 = 0 THEN 'human:merged' WHEN o_orderkey % 3 = 1 THEN 'human:asked' ELSE 'human:said' END AS pending_type, (o_orderkey % 5 = 0) AS aged FROM orders""")
def part_routes(spark, sf_dir):
    """Groups with all parts wait as one merged row, others as a row a part; old ones leave the state."""
    segment = (Segment("talk", "a", "h", None, (SubType("said", "said"), SubType("asked", "asked", is_base=True))),)
    orders = table(spark, sf_dir, "orders")
    part = lambda name: F.struct(F.lit(f"human:{name}").alias("pending_type"), F.to_json(F.struct(F.col("o_orderpriority").alias(name))).alias("payload"))
    parts = F.when(F.col("o_orderkey") % 3 == 0, F.array(part("asked"), part("said"))).when(F.col("o_orderkey") % 3 == 1, F.array(part("asked"))).otherwise(F.array(part("said")))
    seen = F.timestamp_add("DAY", F.when(F.col("o_orderkey") % 5 == 0, -8).otherwise(-6), F.lit(AS_OF).cast("timestamp"))
    pending = orders.select(
        _text("o_orderkey").alias("image_id"), F.lit("k").alias("key_id"), F.lit("talk").alias("segment"), F.lit(None).cast("string").alias("case_id"), seen.alias("created_at"), seen.alias("first_seen_at"),
        seen.alias("last_retried_at"), F.lit(0).cast("long").alias("retry_count"), F.lit(None).cast("string").alias("merged_case_ids"), F.lit(None).cast("string").alias("last_compared_signature"),
        F.lit(0).cast("long").alias("comparison_version"), F.inline(parts),
    )
    fresh = _no_rows(spark, "image_id string, segment string, side string, sub_type string, payload string, case_id string, key_id string, created_at timestamp")
    routes = pairing.pair(fresh, pending, _no_rows(spark, schemas.AI_PENDING), segment, AS_OF)
    return routes.case_pending.select("image_id", "pending_type", F.lit(False).alias("aged")).union(routes.case_aged.select("image_id", "pending_type", F.lit(True)))


@query("""
SELECT lower(o_orderstatus || '-' || o_orderkey) AS image_id, 'main' AS segment, CASE WHEN o_orderstatus = 'F' THEN 'ai' ELSE 'human' END AS side,
       CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderkey % 2 = 0 THEN 'one' ELSE 'two' END AS sub_type
FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'O' AND (o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 OR o_orderkey % 2 = 1 AND o_orderkey % 3 = 0)""")
def payload_routing(spark, sf_dir):
    """Parts are told apart by which fields a payload has and has not; payloads of no part go."""
    even, third = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3 == 0
    image = F.concat(F.lit(" "), "o_orderstatus", F.lit("-"), _text("o_orderkey"))
    payload = F.to_json(F.struct(F.array(F.struct(image.alias("file"))).alias("images"), F.when(even, 1).alias("x"), F.when(third, 1).alias("y")))
    rows = table(spark, sf_dir, "orders").select(F.lit("k").alias("key_id"), F.lower("o_orderstatus").alias("method"), payload.alias("payload"), F.lit(AS_OF).alias("created_at"))
    # with an even key and a multiple of three there are both fields, so the first part's negative one rules it out
    segment = Segment("main", "f", "o", None, (SubType("one", "x", "y"), SubType("two", "y", "x")))
    return routing.keyed(rows, (segment,), "images[0].file").select("image_id", "segment", "side", "sub_type")


@query("SELECT d.doc_id FROM documents d WHERE d.source <> 'src0' AND NOT EXISTS (SELECT 1 FROM documents k WHERE k.source = 'src0' AND sha256(k.text) = sha256(d.text))")
def anti_replay(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", crypto.sha256(F.col("text")).alias("content_key"))
    return relational.not_in(rows.where("source <> 'src0'"), rows.where("source = 'src0'"), ["content_key"]).select("doc_id")


# flattening and comparing payloads


@query("SELECT event_id, 'k' AS field, json_extract_string(props, '$.k') AS value FROM events")
def flatten_scalars(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.inline(P.flattened(F.col("props"), {})))
    return rows.select("event_id", "field", "value")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order a human and an AI payload: the order's scalars and its lines, ordered by all their columns."""
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(item)).alias("lines"))
    rows = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    changed = F.transform("lines", lambda x: F.struct(x["line"].alias("line"), x["part"].alias("part"), F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(x["flag"]).alias("flag")))
    human = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "lines"))
    ai = F.to_json(F.struct(F.lower("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 5 == 0, "none").otherwise(F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 11 != 0, changed).alias("lines")))
    return rows.select(F.col("o_orderkey").alias("pair"), human.alias("human"), ai.alias("ai"))


_HUMAN_SQL = """
human AS (
  SELECT o_orderkey AS pair, 'status' AS f, NULL::VARCHAR AS k, 1 AS n, o_orderstatus AS v FROM orders
  UNION ALL SELECT o_orderkey, 'priority', NULL, 1, o_orderpriority FROM orders
  UNION ALL SELECT pair, 'lines.line', line::VARCHAR, n, line::VARCHAR FROM l UNION ALL SELECT pair, 'lines.part', line::VARCHAR, n, part::VARCHAR FROM l UNION ALL SELECT pair, 'lines.flag', line::VARCHAR, n, flag FROM l)"""
_LINES_SQL = """
l AS (SELECT l_orderkey AS pair, l_linenumber AS line, l_partkey AS part, l_returnflag AS flag, (row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_returnflag))::INT AS n
      FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""
_COMPARE_SQL = f"""
WITH {_LINES_SQL}, {_HUMAN_SQL},
ai AS (
  SELECT o_orderkey AS pair, 'status' AS f, NULL::VARCHAR AS k, 1 AS n, lower(o_orderstatus) AS v FROM orders
  UNION ALL SELECT o_orderkey, 'priority', NULL, 1, CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE o_orderpriority END FROM orders
  UNION ALL SELECT pair, 'lines.line', line::VARCHAR, n, line::VARCHAR FROM l WHERE pair % 11 <> 0 UNION ALL SELECT pair, 'lines.part', line::VARCHAR, n, part::VARCHAR FROM l WHERE pair % 11 <> 0
  UNION ALL SELECT pair, 'lines.flag', line::VARCHAR, n, CASE WHEN pair % 7 = 0 THEN 'X' ELSE flag END FROM l WHERE pair % 11 <> 0),
c AS (
  SELECT coalesce(h.pair, a.pair) AS pair, coalesce(h.f, a.f) AS field_name, coalesce(h.k, a.k) AS array_key, coalesce(h.n, a.n) AS ordinal, h.v AS human_value, a.v AS ai_value,
         coalesce(lower(h.v) = lower(a.v), h.v IS NULL AND a.v IS NULL) AS is_match
  FROM human h FULL JOIN ai a ON h.pair = a.pair AND h.f = a.f AND h.k IS NOT DISTINCT FROM a.k AND h.n = a.n)
"""


@query(f"WITH {_LINES_SQL}, {_HUMAN_SQL} SELECT pair, f AS field, k AS match_key, v AS value FROM human")
def flatten_keyed(spark, sf_dir):
    rows = _payloads(spark, sf_dir)
    return rows.select("pair", F.inline(P.flattened(F.col("human"), {"lines": "line"}))).select("pair", "field", "match_key", "value")


@query("SELECT l_orderkey AS pair, 'tags' AS field, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipmode))::INT - 1 AS place, l_shipmode AS value FROM (SELECT l_orderkey, l_returnflag || l_linestatus || l_linenumber AS l_shipmode FROM lineitem)")
def flatten_positional(spark, sf_dir):
    tag = F.concat("l_returnflag", "l_linestatus", _text("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pair")).agg(F.to_json(F.struct(F.collect_list(tag).alias("tags"))).alias("payload"))
    return rows.select("pair", F.inline(P.flattened(F.col("payload"), {}))).select("pair", "field", "place", "value")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _payloads(spark, sf_dir)
    keys = {"lines": "line"}
    flat = rows.select("pair", P.flattened(F.col("human"), keys).alias("human"), P.flattened(F.col("ai"), keys).alias("ai"))
    return compare.matched_fields(compare.both_sides(flat, "human", "ai", compare.parts_for(table(spark, sf_dir, "orders"), LINES_A_TASK // 6)), {"lines": "positions"})


@query(f"{_COMPARE_SQL} SELECT * FROM c")
def field_compare(spark, sf_dir):
    return _compared(spark, sf_dir).select("pair", "field_name", "array_key", "ordinal", "human_value", "ai_value", "is_match")


@query(f"{_COMPARE_SQL} SELECT field_name, CASE WHEN field_name LIKE 'lines.%' THEN 'positions' END AS segment_type, count(*) AS n FROM c GROUP BY 1, 2")
def segment_type(spark, sf_dir):
    return _compared(spark, sf_dir).groupBy("field_name", "segment_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_COMPARE_SQL}
SELECT field_name, count(*) FILTER (is_match) AS matched, count(*) FILTER (NOT is_match) AS mismatched,
       round(CAST(count(*) FILTER (is_match) AS DECIMAL(20,4)) * 100 / count(*), 2)::DECIMAL(8,2) AS match_pct FROM c GROUP BY field_name""")
def match_rate(spark, sf_dir):
    return views.match_rate(_compared(spark, sf_dir))


@query("""
WITH u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE role = 'assistant')
SELECT coalesce(u.conv_id, a.conv_id) AS pair, coalesce(u.n, a.n)::INT AS ordinal, u.text AS human_value, a.text AS ai_value, coalesce(lower(u.text) = lower(a.text), u.text IS NULL AND a.text IS NULL) AS is_match
FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.n = a.n""")
def turn_compare(spark, sf_dir):
    side = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "ai").alias("side")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pair"), side, F.lit("text").alias("field"), F.lit(None).cast("string").alias("match_key"), F.col("turn").alias("place"), F.col("text").alias("value"), F.lit(None).cast("string").alias("case_id"))
    found = compare.matched_fields(rows.where("side is not null"))
    return found.select("pair", "ordinal", "human_value", "ai_value", "is_match")


@query("""
WITH h AS (SELECT DISTINCT l_orderkey AS pair, l_linenumber::VARCHAR AS p, (l_partkey % 10)::VARCHAR AS c FROM lineitem),
a AS (SELECT DISTINCT l_orderkey AS pair, l_linenumber::VARCHAR AS p, (l_suppkey % 10)::VARCHAR AS c FROM lineitem),
e AS (SELECT h.pair, h.p, h.c AS hc, a.c AS ac FROM h JOIN a USING (pair, p, c)),
hl AS (SELECT pair, p, c, row_number() OVER (PARTITION BY pair, p ORDER BY c) AS n FROM h ANTI JOIN a USING (pair, p, c)),
al AS (SELECT pair, p, c, row_number() OVER (PARTITION BY pair, p ORDER BY c) AS n FROM a ANTI JOIN h USING (pair, p, c)),
r AS (SELECT * FROM e UNION ALL SELECT coalesce(hl.pair, al.pair), coalesce(hl.p, al.p), hl.c, al.c FROM hl FULL JOIN al ON hl.pair = al.pair AND hl.p = al.p AND hl.n = al.n)
SELECT pair, 'human' AS side, p || '-' || hc AS match_key, p || '-' || coalesce(ac, 'XXX') || '-' || hc AS new_key FROM r WHERE hc IS NOT NULL
UNION ALL SELECT pair, 'ai', p || '-' || ac, p || '-' || ac || '-' || coalesce(hc, 'XXX') FROM r WHERE ac IS NOT NULL""")
def soft_match(spark, sf_dir):
    line = _text("l_linenumber")
    value = lambda side, field, key: F.struct(F.lit(side).alias("side"), F.lit(field).alias("field"), key.alias("match_key"))
    sides = [(side, F.concat_ws("-", line, (F.col(code) % 10).cast("string"))) for side, code in (("human", "l_partkey"), ("ai", "l_suppkey"))]
    values = [v for side, key in sides for v in (value(side, "lines.codes.code", key), value(side, "lines.line", line))]
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(F.col("l_orderkey").alias("pair"), F.inline(F.array(*values)))
    return compare.soft_keys(rows, {"lines.codes": "lines"}, compare.parts_for(lines, LINES_A_TASK)).where("new_key is not null").select("pair", "side", "match_key", "new_key").distinct()


@query("""
SELECT event_id, CASE WHEN f = 'click' OR starts_with(f, 'click.') THEN 'action' || substr(f, 6) WHEN f = 'view.page' OR starts_with(f, 'view.page.') THEN 'page' || substr(f, 10) ELSE f END AS field
FROM (SELECT event_id, CASE user_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type || '.page' ELSE event_type || 'er.page.x' END AS f FROM events)""")
def field_mapping(spark, sf_dir):
    f = F.when(F.col("user_id") % 3 == 0, F.col("event_type")).when(F.col("user_id") % 3 == 1, F.concat("event_type", F.lit(".page"))).otherwise(F.concat("event_type", F.lit("er.page.x")))
    return table(spark, sf_dir, "events").select("event_id", text.renamed(f, [("action", "click"), ("page", "view.page")]).alias("field"))


@query("""
WITH f AS (SELECT DISTINCT l_orderkey AS pair, 'lines.l' || l_linenumber || '.flag' AS field_name FROM lineitem),
n AS (SELECT o_orderkey AS pair, 'lines' AS path, 'c' || (o_custkey % 5) AS case_id FROM orders UNION ALL SELECT o_orderkey, 'lines.l3', 'd' || (o_custkey % 3) FROM orders WHERE o_orderkey % 2 = 0)
SELECT f.pair, f.field_name, arg_max(n.case_id, length(n.path)) AS noted FROM f LEFT JOIN n ON f.pair = n.pair AND (f.field_name = n.path OR starts_with(f.field_name, n.path || '.')) GROUP BY 1, 2""")
def case_resolve(spark, sf_dir):
    fields = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pair"), F.concat(F.lit("lines.l"), _text("l_linenumber"), F.lit(".flag")).alias("field_name")).distinct()
    orders = table(spark, sf_dir, "orders")
    top = orders.select(F.col("o_orderkey").alias("pair"), F.lit("lines").alias("path"), F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string")).alias("case_id"))
    some = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("lines.l3"), F.concat(F.lit("d"), (F.col("o_custkey") % 3).cast("string")))
    return attribution.nearest_note(fields, top.union(some))


# views and monitoring

_RESULTS_SQL = """
SELECT l_orderkey::VARCHAR AS image_id, 'main' AS segment, 'c' || (l_partkey % 3) AS case_id, (l_suppkey % 2)::INT AS ai_iteration, TIMESTAMP '2001-01-01' AS ai_created_at,
       CASE l_linenumber % 2 WHEN 0 THEN 'credit.dob.disputeCodes.code' ELSE 'lines.flag' END AS field_name,
       CASE WHEN l_linenumber % 2 = 0 THEN (l_suppkey % 3) || '-a-b' WHEN l_linenumber > 1 THEN (l_suppkey % 3)::VARCHAR END AS array_key,
       CASE WHEN l_linenumber <> 5 THEN 'lines' END AS segment_type, CASE WHEN (l_partkey + l_linenumber) % 3 > 0 THEN l_returnflag END AS human_value, l_linestatus AS ai_value,
       l_returnflag = 'A' AS is_match, l_partkey, l_linenumber
FROM lineitem"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = (F.col("l_suppkey") % 3).cast("string")
    even = F.col("l_linenumber") % 2 == 0
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("image_id"), F.lit("main").alias("segment"), F.concat(F.lit("c"), (F.col("l_partkey") % 3).cast("string")).alias("case_id"),
        (F.col("l_suppkey") % 2).cast("int").alias("ai_iteration"), F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz").alias("ai_created_at"),
        F.when(even, "credit.dob.disputeCodes.code").otherwise("lines.flag").alias("field_name"),
        F.when(even, F.concat(entity, F.lit("-a-b"))).when(F.col("l_linenumber") > 1, entity).alias("array_key"),
        F.when(F.col("l_linenumber") != 5, "lines").alias("segment_type"), F.when((F.col("l_partkey") + F.col("l_linenumber")) % 3 > 0, F.col("l_returnflag")).alias("human_value"),
        F.col("l_linestatus").alias("ai_value"), (F.col("l_returnflag") == "A").alias("is_match"), "l_partkey", "l_linenumber",
    )


@query(f"""
WITH r AS ({_RESULTS_SQL}), s AS (SELECT *, field_name LIKE 'credit.dob.disputeCodes%' AS soft FROM r),
n AS (SELECT *, CASE WHEN array_key IS NOT NULL AND soft THEN 'soft_array_parent' WHEN array_key IS NOT NULL THEN 'array_entity' ELSE 'segment_type' END AS lvl,
             CASE WHEN array_key IS NOT NULL AND soft THEN regexp_replace(array_key, '-[^-]+-[^-]+$', '') WHEN array_key IS NOT NULL THEN array_key ELSE 'only' END AS sk FROM s),
c AS (SELECT DISTINCT image_id, segment, ai_created_at, segment_type, lvl, sk, case_id FROM n WHERE human_value IS NOT NULL AND segment_type IS NOT NULL)
SELECT * EXCLUDE (soft, lvl, sk) FROM n WHERE NOT (NOT is_match AND human_value IS NULL AND ai_value IS NOT NULL AND segment_type IS NOT NULL
  AND EXISTS (SELECT 1 FROM c WHERE c.image_id = n.image_id AND c.segment = n.segment AND c.ai_created_at = n.ai_created_at AND c.segment_type = n.segment_type AND c.lvl = n.lvl AND c.sk = n.sk)
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.image_id = n.image_id AND c.segment = n.segment AND c.ai_created_at = n.ai_created_at AND c.segment_type = n.segment_type AND c.lvl = n.lvl AND c.sk = n.sk AND coalesce(c.case_id, '') = coalesce(n.case_id, '')))""")
def clean_view(spark, sf_dir):
    return views.clean_view(_results(spark, sf_dir))


@query(f"WITH r AS ({_RESULTS_SQL}) SELECT * EXCLUDE (m) FROM (SELECT *, max(ai_iteration) OVER (PARTITION BY image_id, segment) AS m FROM r) WHERE ai_iteration = m")
def latest_version(spark, sf_dir):
    return views.latest_view(_results(spark, sf_dir))


@query("""
SELECT pending_type, CASE WHEN d < 1 THEN 'same day' WHEN d < 3 THEN '1-2 days' WHEN d < 7 THEN '3-6 days' ELSE '7+ days' END AS age_bucket, count(*) AS cnt
FROM (SELECT event_type AS pending_type, floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 86400000000) AS d FROM events) GROUP BY 1, 2""")
def pending_age_buckets(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("pending_type"), F.col("ts").alias("first_seen_at"))
    return views.pending_ages(rows, F.lit(datetime(2024, 1, 31)))


# reporting


@query("""
SELECT o.o_orderkey, c.c_name, n.n_name, l.l_linenumber, p.p_brand, s.s_name, date_trunc('month', o.o_orderdate)::DATE AS order_month
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE c.c_mktsegment IS NOT NULL AND l.l_orderkey IS NOT NULL""")
def bi_explore(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "lineitem", "part", "supplier")}
    rows = reporting.star(t["orders"], [(t["customer"], "o_custkey", "c_custkey"), (t["nation"], "c_nationkey", "n_nationkey"), (t["lineitem"], "o_orderkey", "l_orderkey"), (t["part"], "l_partkey", "p_partkey"), (t["supplier"], "l_suppkey", "s_suppkey")])
    rows = rows.where("c_mktsegment is not null and l_orderkey is not null")
    return rows.select("o_orderkey", "c_name", "n_name", "l_linenumber", "p_brand", "s_name", times.month_of(F.col("o_orderdate")).alias("order_month"))


@query("""
SELECT n_name, count(DISTINCT o_orderkey) AS n_orders, sum(cents)::BIGINT AS total_cents FROM (
  SELECT DISTINCT n.n_name, o.o_orderkey, round(o.o_totalprice * 100)::BIGINT AS cents FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey) GROUP BY n_name""")
def bi_measures(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "lineitem")}
    rows = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.select("n_name", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return reporting.fan_out_safe(rows, ["n_name"], "o_orderkey", {"n_orders": F.count("o_orderkey"), "total_cents": F.sum("cents")})


@query("SELECT e.event_id, (SELECT max(h.ts) FROM events h WHERE h.event_type = 'signup' AND h.user_id = e.user_id AND h.ts < e.ts) AS assigned_at FROM events e WHERE e.event_type = 'purchase'")
def asof_assignment(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    marks = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("seen_ts"))
    return relational.as_of_latest(events.where("event_type = 'purchase'"), marks, ["user_id"], "ts", "seen_ts", "assigned_at").select("event_id", "assigned_at")


@query("SELECT user_id, max(ts) FILTER (event_type = 'view') AS doc_review_at, max(ts) FILTER (event_type = 'click') AS auth_at, floor((epoch_us(max(ts) FILTER (event_type = 'click')) - epoch_us(max(ts) FILTER (event_type = 'view'))) / 1000000)::BIGINT AS seconds FROM events GROUP BY user_id")
def category_times(spark, sf_dir):
    rows = reporting.last_event_of(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", {"doc_review_at": "view", "auth_at": "click"})
    return rows.withColumn("seconds", times.seconds_between(F.col("doc_review_at"), F.col("auth_at")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r FROM lineitem) WHERE r = 1")
def latest_load_ties(spark, sf_dir):
    return relational.latest_with_ties(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("SELECT o.o_orderkey, (SELECT min(l_returnflag) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag <> 'N') AS outcome FROM orders o")
def scalar_any(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    known = reporting.any_outcome(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), flag), "o_orderkey", "flag")
    return table(spark, sf_dir, "orders").select("o_orderkey").join(known, "o_orderkey", "left")


@query("""
SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%red%' OR lower(p_type) LIKE '%ring%' OR lower(p_type) LIKE '%red%' THEN 'A'
  WHEN lower(p_name) LIKE '%small_widget%' OR lower(p_type) LIKE '%small_widget%' THEN 'B' WHEN lower(p_name) LIKE '%econ%' OR lower(p_type) LIKE '%econ%' THEN 'C' ELSE 'Other' END AS label FROM part""")
def label_case(spark, sf_dir):
    labels = {"A": ("%ring%", "%red%"), "B": ("%small_widget%",), "C": ("%econ%",)}
    return table(spark, sf_dir, "part").select("p_partkey", text.first_label([F.col("p_name"), F.col("p_type")], labels, "Other").alias("label"))


@query("SELECT o_orderkey, o_orderdate::DATE AS day, date_trunc('month', o_orderdate)::DATE AS month FROM orders")
def month_buckets(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), times.month_of(F.col("o_orderdate")).alias("month"))


@query("SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_ts FROM events")
def tz_convert(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.local_time(F.col("ts")).alias("local_ts"))


@query("SELECT event_id, v.part AS value FROM events, LATERAL (SELECT unnest(string_split(event_type || ';' || user_id || ';' || event_type, ';')) AS part) v")
def split_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("numbers", F.concat_ws(";", "event_type", _text("user_id"), "event_type"))
    return reporting.exploded_numbers(rows, "numbers").select("event_id", "value")


# audit


@query("""
SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, min(o_orderdate) AS oldest, max(o_orderdate) AS newest, count(o_orderdate) AS n_dated, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS n_old, 0::BIGINT AS n_unreadable FROM orders
UNION ALL SELECT 'lineitem', 'l_shipdate', min(l_shipdate), max(l_shipdate), count(l_shipdate), count(*) FILTER (l_shipdate < TIMESTAMP '1998-01-01'), 0 FROM lineitem
UNION ALL SELECT 'events', 'ts', min(ts), max(ts), count(ts), count(*) FILTER (ts < TIMESTAMP '1998-01-01'), 0 FROM events""")
def audit_age(spark, sf_dir):
    parts = [audit.ages(table(spark, sf_dir, t), t, [c], F.lit(datetime(1998, 1, 1))) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    found = parts[0].union(parts[1]).union(parts[2])
    return found.withColumn("oldest", F.col("oldest").cast("timestamp_ntz")).withColumn("newest", F.col("newest").cast("timestamp_ntz"))


_AUDITED = ["customer", "documents", "embeddings", "labels", "nation", "part", "region", "supplier", "orders", "lineitem", "events"]
_SIZES_SQL = "s AS (" + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS total_rows, {int(n in ('orders', 'lineitem', 'events'))} AS date_columns FROM {n}" for n in _AUDITED) + ")"
_PLAN_SQL = f"""
WITH {_SIZES_SQL},
p AS (SELECT table_name, date_columns, total_rows, total_rows * 100 / 1073741824.0::DOUBLE AS table_gb, total_rows * date_columns * 16 / 1073741824.0::DOUBLE AS est_gb FROM s),
r AS (SELECT *, CASE WHEN date_columns = 0 THEN 'no date-like column' WHEN table_gb < 0.00001::DOUBLE THEN 'below min_table_gb' WHEN est_gb > 0.0005::DOUBLE THEN 'too large (~' || printf('%.1f', est_gb) || ' GB estimated scan)' END AS reason FROM p),
b AS (SELECT *, CASE WHEN reason IS NULL THEN (row_number() OVER (PARTITION BY reason IS NULL ORDER BY table_name) - 1) // 1 END::INT AS batch_no FROM r)
"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit plan over the tables, with 100 bytes a row for their size."""
    for n in _AUDITED:
        table(spark, sf_dir, n).createOrReplaceTempView(f"audit_{n}")
    tables, columns = scans.tables_of(spark, {"main": [f"audit_{n}" for n in _AUDITED]})
    sizes = [table(spark, sf_dir, n).agg(F.lit("main").alias("dataset"), F.lit(f"audit_{n}").alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for n in _AUDITED]
    storage = reduce(DataFrame.union, sizes).select("*", (F.col("total_rows") * 100).alias("total_bytes"), F.lit(False).alias("deleted"))
    return audit.audit_plan(tables.withColumn("table_type", F.lit("BASE TABLE")), columns, storage, 0.00001, 0.0005, 1)


@query(f"{_PLAN_SQL} SELECT table_name, nullif(date_columns, 0)::BIGINT AS date_columns, total_rows, table_gb, reason, batch_no FROM b")
def audit_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select(F.substring("table_name", 7, 100).alias("table_name"), "date_columns", "total_rows", "table_gb", "reason", "batch_no")


@query(f"{_PLAN_SQL} SELECT batch_no, string_agg('main.audit_' || table_name, ', ' ORDER BY table_name) AS tables_in_batch FROM b WHERE reason IS NULL GROUP BY batch_no")
def audit_batches(spark, sf_dir):
    return audit.audit_batches(_plan(spark, sf_dir)).select("batch_no", "tables_in_batch")


@query(f"{_PLAN_SQL} SELECT table_name, reason FROM b WHERE reason IS NOT NULL")
def audit_unchecked(spark, sf_dir):
    _, unchecked, _ = audit.audit(spark, _plan(spark, sf_dir), F.lit(datetime(1998, 1, 1)))
    return unchecked.select(F.substring("table_name", 7, 100).alias("table_name"), "reason")


@query("""
WITH a AS (SELECT 'orders' AS table_name, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS n_old, count(*) AS total_rows FROM orders UNION ALL SELECT 'events', count(*) FILTER (ts < TIMESTAMP '1998-01-01'), count(*) FROM events)
SELECT table_name, n_old, total_rows, round(n_old::DOUBLE / total_rows * 100, 1) AS pct_old, round(total_rows * 1048576 / 1073741824.0::DOUBLE, 2) AS table_gb, round(n_old::DOUBLE / total_rows * (total_rows * 1048576 / 1073741824.0::DOUBLE), 2) AS est_old_gb FROM a""")
def audit_report(spark, sf_dir):
    """Ages beside sizes, here of 1 MB a row."""
    parts = [audit.ages(table(spark, sf_dir, t), t, [c], F.lit(datetime(1998, 1, 1))) for t, c in (("orders", "o_orderdate"), ("events", "ts"))]
    found = parts[0].union(parts[1]).withColumn("dataset", F.lit("main"))
    sizes = [table(spark, sf_dir, t).agg(F.lit("main").alias("dataset"), F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for t in ("orders", "events")]
    storage = sizes[0].union(sizes[1]).select("*", (F.col("total_rows") * (1 << 20)).alias("total_bytes"), F.lit(False).alias("deleted"))
    return audit.audit_report(found, storage).select("table_name", "n_old", "total_rows", "pct_old", "table_gb", "est_old_gb")


@query("""
SELECT event_type AS collection_path, count(*) AS docs, min(ts) AS oldest, count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS docs_old, round(sum(CASE WHEN ts < TIMESTAMP '2024-01-10' THEN event_id * 1000 ELSE 0 END)::DOUBLE / 1073741824, 2) AS old_gb
FROM events GROUP BY event_type""")
def conditional_sums(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("collection_path"), "ts", (F.col("event_id") * 1000).alias("size"))
    cutoff = audit.years_before(F.lit(datetime(2031, 1, 10)), 7).cast("timestamp_ntz")
    return audit.collection_summary(rows, "collection_path", "ts", "size", cutoff)


@query("""
WITH d AS (SELECT event_type AS collection_path, 'd/' || event_id AS path, ts, CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN ts - INTERVAL 30 DAY END AS business FROM events)
SELECT collection_path, path, coalesce(business, ts) AS age_ts, CASE WHEN business IS NULL THEN 'createTime' ELSE 'date field' END AS age_source, ts >= TIMESTAMP '2024-01-10' AS updated_since
FROM d WHERE coalesce(business, ts) < TIMESTAMP '2024-01-10'""")
def document_ages(spark, sf_dir):
    """Half of the views have a date of their own, 30 days before; other collections have the field but no mapping."""
    own = F.date_format(F.col("ts") - F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = F.to_json(F.struct(F.when(F.col("event_id") % 2 == 0, own).otherwise("unknown").alias("due")))
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("collection_path"), F.concat(F.lit("d/"), _text("event_id")).alias("path"), F.col("ts").alias("create_time"), F.col("ts").alias("update_time"), fields.alias("date_fields"))
    return audit.document_ages(rows, {"view": "due", "nowhere": "x"}, F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"))


@query("""
WITH p AS (SELECT strftime(o_orderdate, '%Y%m') AS partition_id, count(*) AS total_rows, count(*) * 64 AS total_bytes FROM orders GROUP BY 1)
SELECT sum(total_rows)::BIGINT AS total_rows, sum(CASE WHEN partition_id < '199801' THEN total_rows ELSE 0 END)::BIGINT AS old_rows, sum(total_bytes)::BIGINT AS total_bytes, sum(CASE WHEN partition_id < '199801' THEN total_bytes ELSE 0 END)::BIGINT AS old_bytes FROM p""")
def partition_sums(spark, sf_dir):
    parts = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("partition_id")).agg(F.count(F.lit(1)).alias("total_rows"))
    return audit.old_partitions(parts.withColumn("total_bytes", F.col("total_rows") * 64), "199801")


@query("""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)
SELECT event_type AS collection_path, 'at' AS field, count(*) AS n FROM s WHERE n <= 20 AND event_id % 3 = 0 GROUP BY 1, 2""")
def sampled_fields(spark, sf_dir):
    """Fields with dates in 20 documents of each collection; a sample is what the report is for."""
    at = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("none")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("collection_path"), "event_id", F.to_json(F.struct(at.alias("at"), F.col("user_id").alias("u"))).alias("payload"))
    return audit.sampled_fields(rows, "collection_path", "event_id", "payload", 20)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of the documents: pages of 300, each with the token of the next; page 2 is lost."""
    page = F.floor(F.col("doc_id") / 300)
    item = F.struct(F.concat(F.lit("corpus/"), F.lpad(_text("doc_id"), 9, "0")).alias("name"), F.lit("2020-01-01T00:00:00Z").alias("createTime"), F.when(F.col("doc_id") % 2 == 0, "2021-01-01T00:00:00Z").otherwise("2023-01-01T00:00:00Z").alias("updateTime"))
    rows = table(spark, sf_dir, "documents").groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(item)).alias("documents"))
    last = rows.agg(F.max("page").alias("last"))
    body = F.to_json(F.struct("documents", F.when(F.col("page") < F.col("last"), F.concat(F.lit("t"), (F.col("page") + 1).cast("string"))).otherwise("").alias("nextPageToken")))
    rows = rows.join(F.broadcast(last))  # one row
    return rows.select(F.concat(F.lit("t"), _text("page")).alias("page_token"), body.alias("body")).where("page_token <> 't2'")


@query("SELECT 'corpus/' || lpad(doc_id::VARCHAR, 9, '0') AS path, 't' || doc_id // 300 AS page_token FROM documents WHERE doc_id // 300 <> 2")
def listed_documents(spark, sf_dir):
    return scans.listed_documents(_pages(spark, sf_dir)).select("path", "page_token")


@query("SELECT DISTINCT 't2' AS page_token FROM documents WHERE doc_id // 300 >= 2")
def missing_pages(spark, sf_dir):
    return scans.missing_pages(_pages(spark, sf_dir))


@query("""
SELECT CASE WHEN doc_id < 100 THEN 0 WHEN doc_id < 250 THEN 1 ELSE 2 END AS range_no, count(*) AS n FROM documents WHERE doc_id % 2 = 0 AND doc_id // 300 <> 2 GROUP BY 1""")
def key_range_scan(spark, sf_dir):
    """Documents by key range, as of a time after which every other one was changed."""
    found = scans.scan_ranges(scans.listed_documents(_pages(spark, sf_dir)), "path", ["corpus/000000250", "corpus/000000100"], datetime(2022, 1, 1))
    return found.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_COMPARE_SQL}
SELECT field_name, count(*) FILTER (is_match) AS matched, count(*) FILTER (NOT is_match) AS mismatched,
       round(CAST(count(*) FILTER (is_match) AS DECIMAL(20,4)) * 100 / count(*), 2)::DECIMAL(8,2) AS match_pct FROM c GROUP BY field_name ORDER BY mismatched DESC, field_name""")
def worst_fields(spark, sf_dir):
    return views.worst_fields(_compared(spark, sf_dir))


@query("SELECT day, event_type, n FROM (SELECT *, avg(n) OVER (PARTITION BY event_type) AS a FROM (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE n > 1.2 * a")
def spike_days(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return relational.above_average(days, ["event_type"], "n", 1.2).select("day", "event_type", "n")


@query("SELECT c_custkey, n, ((n - 1) // 50)::BIGINT AS batch FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey, c_custkey) AS n FROM customer)")
def batch_numbers(spark, sf_dir):
    return relational.numbered_batches(table(spark, sf_dir, "customer"), ["c_nationkey", "c_custkey"], 50).select("c_custkey", "n", "batch")


@query("SELECT count(*) AS total, count(ts) AS with_field, count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS older, min(ts) AS oldest, round(CAST(count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS DECIMAL(20,4)) * 100 / count(*), 1)::DECIMAL(6,1) AS old_pct FROM events")
def age_check(spark, sf_dir):
    return audit.age_check(table(spark, sf_dir, "events"), "ts", F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"))


@query("SELECT 'documents/' || doc_id AS path, CASE WHEN doc_id % 10 = 0 THEN 'FAILED' WHEN doc_id % 7 = 0 THEN 'SKIPPED' ELSE 'DELETED' END AS outcome FROM documents")
def purge_outcome(spark, sf_dir):
    batch = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("documents/"), _text("doc_id")).alias("path"))
    return audit.purge_outcome(batch, batch.where("doc_id % 10 = 0"), batch.where("doc_id % 7 = 0")).select("path", "outcome")


@query("SELECT o_orderkey, share * 760 AS monthly_saving, CASE WHEN share = 0 THEN NULL ELSE 5000 / (share * 760) END AS payback_months FROM (SELECT o_orderkey, (o_orderkey % 4)::DOUBLE / 4 AS share FROM orders)")
def savings(spark, sf_dir):
    share = (F.col("o_orderkey") % 4).cast("double") / 4
    return table(spark, sf_dir, "orders").select("o_orderkey", *audit.savings(share, F.lit(380.0), F.lit(380.0), F.lit(5000.0)))


@query("SELECT 'p/' || doc_id AS path, source AS collection_group FROM documents WHERE lang = 'en'")
def approved_batch(spark, sf_dir):
    approved = table(spark, sf_dir, "documents").select(F.concat(F.lit("p/"), _text("doc_id")).alias("path"), F.col("source").alias("collection_group"), F.col("lang").alias("batch_id"))
    return audit.approved_batch(spark, approved, "en")


@query("SELECT count(*) AS sampled, count(*) FILTER (ts < TIMESTAMP '2024-01-01 12:00:00') AS older, count(*) FILTER (ts < TIMESTAMP '2024-01-01 12:00:00')::DOUBLE / count(*) AS share FROM (SELECT * FROM events ORDER BY event_id LIMIT 300)")
def sampled_old_share(spark, sf_dir):
    return audit.sampled_old_share(table(spark, sf_dir, "events"), "event_id", "ts", F.lit(datetime(2024, 1, 1, 12)).cast("timestamp_ntz"))


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")
def oldest_row(spark, sf_dir):
    return audit.oldest(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate")


@query("SELECT 'seen' AS field, count(*) AS n_dated, min(ts) AS oldest, max(ts) AS newest FROM events UNION ALL SELECT 'in.due', count(*), min(ts), max(ts) FROM events WHERE event_id % 2 = 0")
def date_fields(spark, sf_dir):
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    tree = F.to_json(F.struct(F.col("event_type").alias("kind"), at.alias("seen"), F.struct(F.when(F.col("event_id") % 2 == 0, at).otherwise("none").alias("due")).alias("in")))
    found = audit.date_fields(table(spark, sf_dir, "events").select("event_id", tree.alias("payload")), "event_id", "payload")
    return found.withColumn("oldest", F.col("oldest").cast("timestamp_ntz")).withColumn("newest", F.col("newest").cast("timestamp_ntz"))


@query("SELECT doc_id, (16 + strlen('corpus') + 1 + strlen(doc_id::VARCHAR) + 1 + 32 + 5 + strlen(text) + 1 + 5 + strlen(lang) + 1)::INT AS bytes FROM documents")
def document_bytes(spark, sf_dir):
    fields = F.array(F.struct(F.lit("text").alias("name"), F.col("text").alias("value")), F.struct(F.lit("lang").alias("name"), F.col("lang").alias("value")))
    return table(spark, sf_dir, "documents").select("doc_id", audit.document_bytes(F.concat(F.lit("corpus/"), _text("doc_id")), fields).alias("bytes"))


@query("SELECT n_nationkey, n_nationkey::BIGINT * 3 AS wanted, count(c_custkey) AS scanned, count(c_custkey) >= n_nationkey::BIGINT * 3 AS complete FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")
def scan_completeness(spark, sf_dir):
    expected = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey").cast("long") * 3).alias("wanted"))
    return audit.completeness(expected, table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")), "n_nationkey", "wanted")


@query("SELECT 'd/' || doc_id AS path FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 AND doc_id % 5 <> 0")
def unreconciled(spark, sf_dir):
    """Documents that a purge log has twice (multiples of 5) or not at all (other multiples of 7)."""
    batch = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("d/"), _text("doc_id")).alias("path"))
    log = batch.where("doc_id % 7 <> 0 or doc_id % 5 = 0").unionByName(batch.where("doc_id % 5 = 0"))
    return audit.reconciled(batch, log)


# scalar functions


@query("SELECT c_custkey, lower(trim('  ' || c_name || ' ')) AS image_id, lower(regexp_replace('Seg ' || c_mktsegment || ' 1', '\\s+', '', 'g')) || '-' || coalesce(CASE WHEN c_nationkey > 3 THEN c_nationkey::VARCHAR END, 'null') AS match_key FROM customer")
def key_normalise(spark, sf_dir):
    spaced = F.concat(F.lit(" \t"), F.col("c_name"), F.lit(" "))
    key = text.composite_key(F.concat(F.lit("Seg "), F.col("c_mktsegment"), F.lit(" 1")), F.when(F.col("c_nationkey") > 3, _text("c_nationkey")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.image_key(spaced).alias("image_id"), key.alias("match_key"))


@query("SELECT event_id, 'u' || user_id AS id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE props END AS request FROM events WHERE event_id % 3 < 2 UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 3 = 2")
def parse_id_request(spark, sf_dir):
    user = F.concat(F.lit("u"), _text("user_id"))
    quoted = F.concat(F.lit('id="'), user, F.lit('",request="'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"'))
    bare = F.concat(F.lit("id="), user, F.lit(",request="), F.col("props"))
    wrapped = F.when(F.col("event_id") % 3 == 0, quoted).when(F.col("event_id") % 3 == 1, bare).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", wrapped.alias("payload"))
    return rows.select("event_id", text.request_id(F.col("payload")).alias("id"), text.request_body(F.col("payload")).alias("request"))


@query("SELECT event_id, CASE event_id % 5 WHEN 3 THEN 'not-a-timestamp' WHEN 4 THEN NULL ELSE strftime(date_trunc(CASE event_id % 5 WHEN 0 THEN 'second' ELSE 'microsecond' END, ts), '%Y-%m-%dT%H:%M:%S.%fZ') END AS normal FROM events")
def ts_normalise(spark, sf_dir):
    at, kind = F.col("ts"), F.col("event_id") % 5
    micros = F.regexp_replace(F.date_format(at, "SSSSSS"), "^0+(?=.)", "")
    forms = F.when(kind == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss' UTC'")).when(kind == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).when(kind == 2, F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss:"), micros, F.lit(" UTC")))
    forms = forms.when(kind == 3, F.lit("not-a-timestamp")).otherwise(F.lit("  "))
    return table(spark, sf_dir, "events").select("event_id", times.normalised(forms).alias("normal"))


@query("SELECT doc_id, sha256('{\"a\":[\"' || lang || '\"],\"b\":\"' || source || '\"}') AS signature FROM documents")
def content_signature(spark, sf_dir):
    tree = F.concat(F.lit('{ "b" : "'), F.col("source"), F.lit('", "_sourceCaseId":"x", "a":["'), F.col("lang"), F.lit('"]}'))
    return table(spark, sf_dir, "documents").select("doc_id", P.content_signature(tree).alias("signature"))


@query("SELECT conv_id, string_agg(DISTINCT role, ';' ORDER BY role) AS roles, count(DISTINCT role) AS n FROM conversations GROUP BY conv_id")
def set_text(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.concat_ws(";", F.collect_list("role"), F.lit("")).alias("text"))
    members = text.set_of(F.col("text"))
    return rows.select("conv_id", text.joined_set(members).alias("roles"), F.size(members).cast("long").alias("n"))


@query("SELECT o_orderkey, o_orderpriority AS plain FROM orders")
def aes_round_trip(spark, sf_dir):
    keys = spark.createDataFrame([("k0", bytes(range(32))), ("k1", bytes(range(1, 33)))], "key_id string, dek binary")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("k"), (F.col("o_orderkey") % 2).cast("string")).alias("key_id"), F.col("o_orderpriority").alias("plain"))
    return crypto.decrypted(crypto.encrypted(rows, keys, "plain"), keys, "plain").select("o_orderkey", "plain")


@query("""
SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, count(*)::BIGINT AS n_own FROM orders GROUP BY o_custkey""")
def merge_cases(spark, sf_dir):
    tree = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.map_from_arrays(F.array(F.concat(F.lit("k"), _text("o_orderkey"))), F.array("o_orderpriority")).alias("of")).alias("own")))
    merged = _folded(table(spark, sf_dir, "orders").select("o_custkey", tree.alias("payload"), F.lpad(_text("o_orderkey"), 12, "0").alias("at")), Policy(), "o_custkey")
    return merged.select("o_custkey", F.get_json_object("m.payload", "$.status").alias("status"), F.size(F.json_object_keys(F.get_json_object("m.payload", "$.own.of"))).cast("long").alias("n_own"))


def _folded(rows: DataFrame, policy: Policy, *keys: str) -> DataFrame:
    """rows(keys, payload, at) -> keys and m, the merged payload of each key."""
    found = P.folded(rows.withColumn("segment", F.lit("own")), keys, ["at", "payload"], {"own": policy})
    return found.select(*keys, F.struct("payload", "at").alias("m"))


@query("SELECT l_orderkey, arg_max(l_returnflag || l_linestatus || l_shipmode, (l_linenumber % 2)::VARCHAR || l_returnflag || l_linestatus || l_shipmode) AS winner FROM (SELECT *, (l_partkey % 7)::VARCHAR AS l_shipmode FROM lineitem) GROUP BY l_orderkey")
def merge_collisions(spark, sf_dir):
    """A field that versions disagree on: the later time wins, of equal times the greater content."""
    value = F.concat("l_returnflag", "l_linestatus", (F.col("l_partkey") % 7).cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.to_json(F.struct(value.alias("v"))).alias("payload"), (F.col("l_linenumber") % 2).cast("string").alias("at"))
    return _folded(rows, Policy(), "l_orderkey").select("l_orderkey", F.get_json_object("m.payload", "$.v").alias("winner"))


@query("""
WITH a AS (SELECT l_orderkey, l_returnflag AS k, l_linestatus AS v, count(*) FILTER (l_linenumber <= 4) AS x, count(*) FILTER (l_linenumber % 2 = 1) AS y FROM lineitem GROUP BY ALL),
k AS (SELECT l_orderkey, k, sum(least(x, y)) AS same, sum(x - least(x, y)) AS x_rest, sum(y - least(x, y)) AS y_rest FROM a GROUP BY ALL)
SELECT l_orderkey, sum(same + greatest(x_rest, y_rest))::BIGINT AS n_items FROM k GROUP BY l_orderkey""")
def merge_multisets(spark, sf_dir):
    """Arrays of keyed items: equal items of both versions cancel one to one, different ones of a key collide in pairs,
    what is left is added."""
    item = F.struct(F.col("l_returnflag").alias("k"), F.col("l_linestatus").alias("v"))
    lines = table(spark, sf_dir, "lineitem")
    sides = [lines.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(F.when(own, item)).alias("items"))).alias("payload")).withColumn("at", F.lit(at)) for own, at in ((F.col("l_linenumber") <= 4, "1"), (F.col("l_linenumber") % 2 == 1, "2"))]
    policy = Policy(arrays=frozenset({"items"}), item_keys={"items": "k"})
    merged = _folded(sides[0].union(sides[1]), policy, "l_orderkey")
    return merged.select("l_orderkey", F.size(F.from_json(F.get_json_object("m.payload", "$.items"), "array<struct<k:string>>")).cast("long").alias("n_items"))


@query("""
SELECT o_orderkey, lower(o_orderstatus) AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderpriority END AS slot, NULL::VARCHAR AS old_field FROM orders""")
def merge_atomic(spark, sf_dir):
    """An object that is taken whole from the later version, but for a slot that only the earlier one has."""
    orders = table(spark, sf_dir, "orders")
    head = lambda *fields: F.to_json(F.struct(F.struct(*fields).alias("head")))
    first = head(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("slot"), F.lit("x").alias("old"))
    second = head(F.lower("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 3 == 0, "new").alias("slot"))
    rows = orders.select("o_orderkey", F.inline(F.array(F.struct(first.alias("payload"), F.lit("1").alias("at")), F.struct(second.alias("payload"), F.lit("2").alias("at")))))
    merged = _folded(rows, Policy(atomic={"head": ("slot",)}), "o_orderkey")
    return merged.select("o_orderkey", *[F.get_json_object("m.payload", f"$.head.{f}").alias(n) for f, n in (("status", "status"), ("slot", "slot"), ("old", "old_field"))])


@query("SELECT o_orderkey, o_orderstatus AS checked, 'Document_Review;Authentication' AS labels FROM orders")
def parts_joined(spark, sf_dir):
    """The parts of a contribution as one record, each part's proofs marked with its label, the base's first."""
    parts_of = (SubType("auth", "checked", proofs_field="documentProofs", proofs_label="Authentication"), SubType("review", "documentProofs", is_base=True, proofs_field="documentProofs", proofs_label="Document_Review"))
    segment = Segment("authanddocreview", "a", "h", None, parts_of)
    proof = F.array(F.struct(F.lit("d").alias("document")))
    parts = F.array(F.struct(F.lit("auth").alias("name"), F.to_json(F.struct(F.col("o_orderstatus").alias("checked"), proof.alias("documentProofs"))).alias("payload")), F.struct(F.lit("review").alias("name"), F.to_json(F.struct(proof.alias("documentProofs"))).alias("payload")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", P.parts_joined(parts, F.lit(segment.name), {segment.name: segment}).alias("m"))
    labels = F.from_json(F.get_json_object("m", "$.documentProofs"), "array<struct<authenticationType:string>>")
    return rows.select("o_orderkey", F.get_json_object("m", "$.checked").alias("checked"), F.array_join(F.transform(labels, lambda x: x["authenticationType"]), ";").alias("labels"))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS side, o_orderdate FROM orders)
SELECT o_custkey::VARCHAR AS image_id, count(*) FILTER (side = 'f') AS n_ai, count(*) FILTER (side = 'o') AS n_human FROM o WHERE side IN ('f', 'o') GROUP BY o_custkey HAVING count(*) FILTER (side = 'f') > 0 AND count(*) FILTER (side = 'o') > 0""")
def pair_groups(spark, sf_dir):
    """Groups whose both sides are there, by the routing and presence operators."""
    rows = table(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("method"), _text("o_custkey").alias("image_id"))
    sides = routing.routed(rows, (Segment("main", "f", "o"),))
    found = relational.presence({"ai": sides.where("side = 'ai'"), "human": sides.where("side = 'human'")}, ["image_id"])
    return found.where("n_ai > 0 and n_human > 0")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, sf_dir):
    from braidwork.streaming.micro import windowed_counts as counts

    found = counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields disagree between the two payloads of an order."""
    w = Window.partitionBy("pair")
    found = _compared(spark, sf_dir)
    return found.withColumn("n_mismatched", F.count_if(~F.col("is_match")).over(w)).where(~F.col("is_match"))
