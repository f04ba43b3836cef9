"""Tool calls and batches of work over events, orders and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import calls
from tracewright.operators import batches
from tracewright.session import table

_OUTPUT = "CASE event_id % 5 WHEN 0 THEN '<output>' || props || '</output>' WHEN 1 THEN '<output>not json</output>' WHEN 2 THEN props WHEN 3 THEN 'plain ' || event_type ELSE '' END"
_MESSAGE = "CASE event_id % 7 WHEN 0 THEN 'Connection REFUSED by host' WHEN 1 THEN 'the call timed out' WHEN 2 THEN 'Traceback: boom' ELSE 'fine' END"
_USAGE = "CASE WHEN event_id % 2 = 0 THEN '{\"input_tokens\": ' || event_id || ', \"output_tokens\": ' || user_id || ', \"input_tokens_details\": {\"cached_tokens\": 3}}' ELSE '{\"prompt_tokens\": ' || event_id || ', \"completion_tokens\": 1}' END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def tool_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = calls.kind_of(F.col("event_type"), {"native": ["view", "click"], "environment": ["purchase"]}, "other")
    return _events(spark, sf_dir).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


def tool_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(_OUTPUT)
    return _events(spark, sf_dir).select("event_id", calls.output_encoding(raw).alias("encoding"), calls.output_payload(raw).alias("payload"), calls.payload_error(raw).alias("bad"))


def execution_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    message, code = F.expr(_MESSAGE), F.expr("event_id % 100")
    found = _events(spark, sf_dir).select("event_id", calls.is_failure(code, message, [5, 6], ["refused", "traceback"]).alias("failed"), calls.is_timeout(message).alias("retryable"))
    return found.where("failed OR retryable")


def usage_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = calls.usage(F.expr(_USAGE))
    rows = _events(spark, sf_dir).select("user_id", *(c.alias(n) for c, n in zip(used, ("input", "cached", "output"), strict=True)))
    return rows.groupBy("user_id").agg(F.sum("input").alias("input"), F.sum("cached").alias("cached"), F.sum("output").alias("output"), F.bool_and(F.col("cached").isNotNull()).alias("complete"))


def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = calls.request_key(F.col("event_type"), F.expr("CAST(user_id AS STRING)"), F.col("props"))
    return _events(spark, sf_dir).groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    training_id = F.expr("concat('run', user_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('::compaction_', event_id % 3) END)")
    return _events(spark, sf_dir).groupBy(calls.source_id(training_id).alias("source_id")).agg(F.count_distinct(training_id).alias("windows"), F.count("*").alias("n"))


def close_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    near = calls.close(F.col("p_retailprice"), F.lit(1000.0), 5.0, 0.25)
    return part.groupBy("p_brand").agg(F.count_if(near).alias("near"), F.count("*").alias("n"))


def batch_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "orders").select(F.expr("CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey % 9000 END").alias("c_custkey"), "o_totalprice")
    return batches.preflight(requests, table(spark, sf_dir, "customer"), "c_custkey", F.col("o_totalprice") > 50000)


def pending_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.pending(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


def accepted_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = batches.until_target(_events(spark, sf_dir), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", 3)
    return found.select("user_id", "event_id", "accepted_so_far")


def repeat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return batches.attempts(runs, ["user_id", "event_type"], ["ts", "event_id"], "cents")


def merged_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumns({"size": F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_size END"), "brand": F.expr("CASE WHEN p_partkey % 5 = 0 THEN p_brand END")})
    return batches.first_known(part, F.lower("p_name"), "p_partkey", ["size", "brand"])


def local_remote_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = table(spark, sf_dir, "customer")
    remote = local.withColumns({"c_name": F.expr("CASE WHEN c_custkey % 8 = 1 THEN upper(c_name) ELSE c_name END"), "c_nationkey": F.expr("CASE WHEN c_custkey % 12 = 1 THEN NULL ELSE c_nationkey END")})
    return batches.differing_fields(local, remote, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"]).withColumn("fields", F.array_join("fields", ","))


def declared_and_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.one_sided(table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def word_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(x,) for x in ("the", "license", "der", "que", "mit")], "name string")
    return batches.mentions(table(spark, sf_dir, "documents"), "doc_id", "text", names, "name")


QUERIES = {f.__name__: f for f in (tool_kinds, tool_outputs, execution_failures, usage_by_user, request_keys, source_ids, close_numbers, batch_preflight, pending_targets, accepted_until, repeat_runs, merged_catalogue, local_remote_fields, declared_and_actual, word_mentions)}

_TIMEOUT = f"contains(lower({_MESSAGE}), 'timed out')"
_FAILED = f"((event_id % 100 IN (5, 6)) OR contains(lower({_MESSAGE}), 'refused') OR contains(lower({_MESSAGE}), 'traceback')) AND NOT {_TIMEOUT}"

ORACLE_SQL = {
    "tool_kinds": "SELECT CASE WHEN event_type IN ('view', 'click') THEN 'native' WHEN event_type = 'purchase' THEN 'environment' ELSE 'other' END AS kind, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "tool_outputs": "SELECT event_id, ['wrapped', 'wrapped', 'json', 'text', 'empty'][event_id % 5 + 1] AS encoding, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN 'not json' WHEN 2 THEN props WHEN 3 THEN 'plain ' || event_type ELSE '' END AS payload, event_id % 5 = 1 AS bad FROM events",
    "execution_failures": f"SELECT event_id, {_FAILED} AS failed, {_TIMEOUT} AS retryable FROM events WHERE ({_FAILED}) OR {_TIMEOUT}",
    "usage_by_user": "SELECT user_id, CAST(sum(event_id) AS BIGINT) AS input, CAST(sum(CASE WHEN event_id % 2 = 0 THEN 3 END) AS BIGINT) AS cached, CAST(sum(CASE WHEN event_id % 2 = 0 THEN user_id ELSE 1 END) AS BIGINT) AS output, bool_and(event_id % 2 = 0) AS complete FROM events GROUP BY user_id",
    "request_keys": "SELECT sha256(event_type || chr(0) || user_id || chr(0) || props) AS key, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1",
    "source_ids": "SELECT 'run' || user_id AS source_id, count(DISTINCT event_id % 3) AS windows, count(*) AS n FROM events GROUP BY 1",
    "close_numbers": "SELECT p_brand, count(*) FILTER (abs(p_retailprice - 1000) <= greatest(5.0, 0.25 * greatest(abs(p_retailprice), 1000.0))) AS near, count(*) AS n FROM part GROUP BY p_brand",
    "batch_preflight": "WITH r AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey % 9000 END AS c_custkey, count(*) AS n, bool_and(o_totalprice > 50000) AS ok FROM orders GROUP BY 1) SELECT r.c_custkey, n, CASE WHEN r.c_custkey IS NULL THEN 'missing_id' WHEN n > 1 THEN 'duplicate' WHEN c.c_custkey IS NULL THEN 'unknown' WHEN NOT ok THEN 'invalid' ELSE 'ready' END AS status FROM r LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c USING (c_custkey)",
    "pending_targets": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "accepted_until": "WITH c AS (SELECT user_id, event_id, event_type, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS accepted_so_far FROM events) SELECT user_id, event_id, accepted_so_far FROM c WHERE accepted_so_far - CAST(event_type = 'purchase' AS INT) < 3",
    "repeat_runs": "SELECT user_id, event_type, count(*) AS attempts, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total, arg_max(event_id, (ts, event_id)) AS latest FROM events GROUP BY user_id, event_type",
    "merged_catalogue": "SELECT lower(p_name) AS key, arg_min(p_size, p_partkey) FILTER (p_partkey % 3 = 0) AS size, arg_min(p_brand, p_partkey) FILTER (p_partkey % 5 = 0) AS brand, count(*) AS n FROM part GROUP BY 1",
    "local_remote_fields": "SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 8 = 1 AND upper(c_name) <> c_name THEN 'c_name' END, CASE WHEN c_custkey % 12 = 1 THEN 'c_nationkey' END) AS fields FROM customer WHERE (c_custkey % 8 = 1 AND upper(c_name) <> c_name) OR c_custkey % 12 = 1",
    "declared_and_actual": "WITH a AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders) SELECT c_custkey, CASE WHEN a.c_custkey IS NULL THEN 'right' ELSE 'left' END AS side FROM a FULL JOIN b USING (c_custkey) WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL",
    "word_mentions": "SELECT doc_id, name, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS name FROM documents) WHERE name IN ('the', 'license', 'der', 'que', 'mit') GROUP BY doc_id, name",
}
