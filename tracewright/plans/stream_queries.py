"""Queries that run as streams, or read back files that Spark wrote, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import shared_dir, table
from tracewright.sources import jsonl
from tracewright.streaming import monitor

#: Users of a batch: no breaker joins them, and batches must not grow with the table.
RUNS = 64
LIMITS = monitor.Limits(calls=12, errors=3, batch_errors=10**9, idle=10**9, keep=2 * 10**9)


def live_run_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream: where each user's log passes a limit of calls or of distinct errors, told once."""
    name, provider = monitor.PROVIDER
    before, folder = spark.conf.get(name), f"{shared_dir(spark).rstrip('/')}/monitor-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    kinds = F.when(F.col("event_type") == "error", "error").when(F.col("event_type").isin("click", "purchase"), "call").otherwise("note")
    rows = events.select(F.concat(F.lit("b"), F.expr(f"user_id div {RUNS}")).alias("b"), F.col("user_id").cast("string").alias("r"), F.col("ts").cast("timestamp").alias("t"), (F.col("event_id") % 7).alias("l"), kinds.alias("k"))
    spark.conf.set(name, provider)
    try:
        stops = monitor.live_stops(rows, "b", "r", "t", "l", "k", "1 hour", LIMITS)
        query = stops.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check").option("path", f"{folder}/stops").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    found = spark.read.schema(monitor.STOPS).parquet(f"{folder}/stops")
    return found.select(F.col("run").cast("long").alias("user_id"), F.col("line").alias("line"), "reason", "calls", "errors")


def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as JSON lines and read again by number: every file's lines are numbered from 1 without gaps."""
    folder = f"{shared_dir(spark).rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").select(F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("value")).write.option("lineSep", "\n").text(folder)
    rows = jsonl.strict_objects(jsonl.numbered_lines(spark, folder, "*.txt"), "o_orderkey long, o_orderstatus string")
    files = rows.groupBy("path").agg((F.max("line") == F.count("*")).alias("whole"), F.count_distinct("line").alias("n"), F.count("*").alias("rows"))
    whole = files.agg(F.bool_and(F.col("whole") & (F.col("n") == F.col("rows"))).alias("gapless"))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).join(F.broadcast(whole))


QUERIES = {f.__name__: f for f in (live_run_stops, jsonl_lines)}

ORACLE_SQL = {
    "live_run_stops": """
        WITH e AS (SELECT user_id, event_id % 7 AS line, CASE WHEN event_type = 'error' THEN 'error' WHEN event_type IN ('click', 'purchase') THEN 'call' ELSE 'note' END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id % 7, event_type) AS k FROM events),
        f AS (SELECT *, kind = 'error' AND k = min(k) FILTER (kind = 'error') OVER (PARTITION BY user_id, line) AS fresh FROM e),
        c AS (SELECT *, count(*) FILTER (kind = 'call') OVER w AS calls, count(*) FILTER (fresh) OVER w AS errors FROM f WINDOW w AS (PARTITION BY user_id ORDER BY k))
        SELECT user_id, line, CASE WHEN calls > 12 THEN 'calls' ELSE 'errors' END AS reason, calls, errors FROM c WHERE calls > 12 OR errors >= 3 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY k) = 1""",
    "jsonl_lines": "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS gapless FROM orders GROUP BY o_orderstatus",
}
