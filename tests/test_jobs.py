import json
import subprocess
import sys

import duckdb

from braidwork.sources import jobs

SQL = """
WITH e AS (SELECT *, regexp_extract(filename, '(local-[0-9]+)', 1) AS application FROM read_json('{}', format = 'newline_delimited', filename = true, columns = {{
  Event: 'VARCHAR', "Job ID": 'BIGINT', "Submission Time": 'BIGINT', "Completion Time": 'BIGINT', "Stage IDs": 'BIGINT[]', "Stage ID": 'BIGINT', "Job Result": 'JSON', "Task Metrics": 'JSON', "Task Info": 'JSON'}})),
j AS (SELECT application, "Job ID" AS job_id, max("Submission Time") FILTER (Event = 'SparkListenerJobStart') AS s, max("Completion Time") AS c, max("Job Result"->>'Result') AS r FROM e WHERE "Job ID" IS NOT NULL GROUP BY ALL),
ran AS (SELECT application, stage, min(job) AS job_id FROM (SELECT application, "Job ID" AS job, unnest("Stage IDs") AS stage FROM e WHERE Event = 'SparkListenerJobStart') GROUP BY ALL),
t AS (SELECT e.application, job_id, count(*) AS tasks, sum(("Task Metrics"->'Input Metrics'->>'Bytes Read')::BIGINT) AS bytes_read, sum(("Task Metrics"->'Input Metrics'->>'Records Read')::BIGINT) AS rows_read,
             sum(("Task Metrics"->'Shuffle Write Metrics'->>'Shuffle Bytes Written')::BIGINT) AS shuffle_bytes
      FROM e JOIN ran ON ran.application = e.application AND ran.stage = e."Stage ID" WHERE Event = 'SparkListenerTaskEnd' GROUP BY ALL)
SELECT j.application, j.job_id, (c - s) / 1000 AS seconds, CASE WHEN c IS NULL THEN 'RUNNING' WHEN r = 'JobSucceeded' THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, coalesce(tasks, 0)::BIGINT AS tasks, coalesce(bytes_read, 0)::BIGINT AS bytes_read,
       coalesce(rows_read, 0)::BIGINT AS rows_read, coalesce(shuffle_bytes, 0)::BIGINT AS shuffle_bytes
FROM j LEFT JOIN t USING (application, job_id)
"""

#: An application with a log: a scan with a shuffle, a job that reuses the shuffle, one that fails.
APP = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
     .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.adaptive.enabled", "false").getOrCreate())
df = s.read.parquet("/root/testdata/sf0.001/orders.parquet").groupBy("o_orderstatus").count()
df.collect()
df.rdd.count(), df.rdd.count()
try:
    s.range(4).select(F.raise_error(F.lit("no"))).collect()
except Exception:
    pass
s.stop()
"""


def test_jobs_of_an_application(spark, tmp_path):
    subprocess.run([sys.executable, "-c", APP, str(tmp_path)], check=True, capture_output=True, timeout=240)
    (log,) = list(tmp_path.iterdir())
    with open(log) as f:
        lines = f.read().splitlines()
    with open(tmp_path / "local-77", "w") as f:  # another application, still at its first job
        f.write(next(x for x in lines if json.loads(x)["Event"] == "SparkListenerJobStart") + "\n")
    found = jobs.job_history(spark, str(tmp_path)).cache()
    columns = ["application", "job_id", "seconds", "state", "tasks", "bytes_read", "rows_read", "shuffle_bytes"]
    want = duckdb.sql(SQL.format(f"{tmp_path}/local-*")).fetchall()
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(want) and len(want) >= 4
    assert {r.state for r in found.collect()} == {"SUCCEEDED", "FAILED", "RUNNING"} and found.agg({"rows_read": "max"}).first()[0] >= 1500
    top = jobs.slowest(found, 2).collect()
    assert len(top) == 2 and top[0].seconds >= top[1].seconds
