"""Outcome, coverage, usage and corpus reports, and tool graphs from event sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.operators import graphs, reports
from tracewright.session import table


_STATUS = "CASE WHEN event_type = 'signup' THEN 'cancelled' WHEN event_id % 7 = 1 THEN 'failed' WHEN event_id % 4 <> 0 THEN 'completed' ELSE 'running' END"


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind == "purchase", "pass").when(kind == "click", "fail")
    category = reports.outcome_category((kind == "error") & (F.col("event_id") % 3 == 0), F.expr(_STATUS), outcome, F.col("event_id") % 19 == 0)
    return table(spark, sf_dir, "events").withColumn("category", category)


def outcome_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_over(_results(spark, sf_dir), "category", [*reports.CATEGORIES, "never"])


def outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, decided = F.col("category") == "verifier_pass", F.col("category").isin("verifier_pass", "verifier_fail")
    return reports.pass_rates(_results(spark, sf_dir), passed, decided, 128, ["user_id"])


def evidence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    found = reports.coverage(docs, F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("n_chars") > 200, ["source"])
    return found.withColumn("full", F.col("supported") == F.col("evaluated"))


def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n_files"), F.sum(F.octet_length("text")).alias("bytes"), F.sort_array(F.collect_set("lang")).alias("langs"))
    return grouped.withColumn("langs", F.array_join("langs", "|"))


def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(cents).alias("cents"), F.count_distinct("user_id").alias("users"), F.bool_and(F.col("value").isNotNull()).alias("complete"))


def weighted_rubric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").withColumn("weight", F.expr("doc_id % 3 + 1"))
    grouped = rows.groupBy(F.expr("doc_id % 20").alias("rubric_set")).agg(F.sum(F.col("weight") * F.col("quality")).alias("points"), F.sum("weight").alias("weight"))
    return grouped.withColumn("score", F.col("points") / F.col("weight"))


def timing_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("total"), F.percentile("l_quantity", F.lit(0.5)).alias("median"))


def effective_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.effective_calls(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_linestatus") == "O", ["l_partkey", "l_suppkey"])


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "documents").createOrReplaceTempView("_corpus_documents")
    return spark.sql("SELECT lang, source, grouping_id() AS level, count(*) AS n, sum(n_chars) AS n_chars FROM _corpus_documents GROUP BY GROUPING SETS ((lang, source), (lang), ())")


def environment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    per_nation = customer.groupBy("c_nationkey").agg(F.count("*").alias("_n"), F.max("c_acctbal").alias("_most"))
    joined = per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.rollup("n_regionkey", "n_nationkey").agg(F.sum("_n").alias("customers"), F.max("_most").alias("most"))


def decision_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.share_of_all(table(spark, sf_dir, "orders"), "o_orderpriority")


def revenue_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'").groupBy("l_returnflag", "l_linestatus").agg(F.sum(cents).alias("cents"), F.count("*").alias("n"))


# ---- tool graphs: the event types of a user in order are a chain


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    pairs = table(spark, sf_dir, "events").select(F.concat_ws("_", "event_type", F.expr("user_id % 4").cast("string")).alias("from_tool"), F.lead(F.concat_ws("_", "event_type", F.expr("user_id % 4").cast("string"))).over(order).alias("to_tool"))
    return pairs.where("to_tool IS NOT NULL AND from_tool <> to_tool").groupBy("from_tool", "to_tool").agg(F.count("*").alias("n"), (F.count("*") % 3 + 1).alias("weight"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


def graph_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    return graphs.roots(edges.select(F.col("from_tool").alias("tool")), edges.where("from_tool < to_tool"), 3)


def prerequisite_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("visited"))
    any_of = F.array(F.array(F.lit("signup"), F.lit("purchase")), F.array(F.lit("error")))
    return seen.select("user_id", graphs.prerequisites_met(any_of, F.col("visited")).alias("met"))


def user_chain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda e: F.concat_ws("_", e["event_type"], F.expr("user_id % 4").cast("string"))).alias("chain"))
    return graphs.chain_scores(chains, _edges(spark, sf_dir), "user_id").select("user_id", "n_edges", "score", F.round("eligibility", 9).alias("eligibility"))


def graph_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    starts = edges.where("from_tool LIKE 'signup%'").select(F.col("from_tool").alias("tool")).distinct()
    return graphs.enumerate_chains(edges, starts, 4).select(F.array_join("chain", ">").alias("chain"), "score")


def sampled_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.sampled_walks(spark, _edges(spark, sf_dir), 2000, 42, 3, 12)


def diverse_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    walks = graphs.sampled_walks(spark, edges, 500, 42, 3, 12)
    scored = walks.join(graphs.chain_scores(walks, edges, "walk"), "walk")
    return graphs.diverse_selection(scored, "walk", "eligibility", 30, 10.0)


QUERIES = {f.__name__: f for f in (outcome_categories, outcome_summary, evidence_coverage, source_inventory, usage_totals, weighted_rubric, timing_median, effective_calls, corpus_stats, environment_rollup, decision_shares, revenue_by_flag, graph_edges, graph_roots, prerequisite_check, user_chain_scores, graph_chains, sampled_walks, diverse_selection)}

_CATEGORY = f"CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'tool_budget_fail' WHEN event_type = 'signup' THEN 'execution_failed' WHEN event_type = 'purchase' THEN 'verifier_pass' WHEN event_type = 'click' THEN 'verifier_fail' WHEN event_id % 19 = 0 THEN 'verification_error' WHEN {_STATUS} = 'failed' THEN 'execution_failed' WHEN {_STATUS} = 'completed' THEN 'completed_unverified' ELSE 'pending' END"
_EDGES = "e AS (SELECT from_tool, to_tool, count(*) AS n, count(*) % 3 + 1 AS weight FROM (SELECT event_type || '_' || user_id % 4 AS from_tool, lead(event_type || '_' || user_id % 4) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_tool FROM events) WHERE to_tool IS NOT NULL AND from_tool <> to_tool GROUP BY 1, 2)"

ORACLE_SQL = {
    "outcome_categories": f"WITH d(category) AS (VALUES ('tool_budget_fail'), ('execution_failed'), ('verifier_pass'), ('verifier_fail'), ('verification_error'), ('completed_unverified'), ('pending'), ('never')), c AS (SELECT {_CATEGORY} AS category FROM events) SELECT d.category, count(c.category) AS n FROM d LEFT JOIN c USING (category) GROUP BY d.category",
    "outcome_summary": f"WITH c AS (SELECT user_id, {_CATEGORY} AS category FROM events), s AS (SELECT user_id, count(*) FILTER (category = 'verifier_pass') AS n_passed, count(*) FILTER (category IN ('verifier_pass', 'verifier_fail')) AS n_decided FROM c GROUP BY user_id) SELECT *, n_passed / 128 AS rate_expected, n_passed / nullif(n_decided, 0) AS rate_decided FROM s",
    "evidence_coverage": "WITH s AS (SELECT source, count(*) FILTER (quality = 1 AND n_chars > 200) AS supported, count(*) FILTER (n_chars > 200) AS evaluated, count(*) FILTER (NOT n_chars > 200) AS not_required FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source) SELECT *, CASE WHEN evaluated = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * supported / evaluated END AS percent, supported = evaluated AS \"full\" FROM s",
    "source_inventory": "SELECT source, count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS bytes, string_agg(DISTINCT lang, '|' ORDER BY lang) AS langs FROM documents GROUP BY source",
    "usage_totals": "SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, count(DISTINCT user_id) AS users, bool_and(value IS NOT NULL) AS complete FROM events GROUP BY event_type",
    "weighted_rubric": "WITH s AS (SELECT doc_id % 20 AS rubric_set, CAST(sum((doc_id % 3 + 1) * quality) AS BIGINT) AS points, CAST(sum(doc_id % 3 + 1) AS BIGINT) AS weight FROM labels GROUP BY 1) SELECT *, points / weight AS score FROM s",
    "timing_median": "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, median(l_quantity) AS median FROM lineitem GROUP BY ALL",
    "effective_calls": "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'O') + count(DISTINCT (l_partkey, l_suppkey)) FILTER (l_linestatus <> 'O') AS effective_calls FROM lineitem GROUP BY l_returnflag",
    "corpus_stats": "SELECT lang, source, grouping(lang, source) AS level, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), ())",
    "environment_rollup": "SELECT n_regionkey, n_nationkey, count(*) AS customers, max(c_acctbal) AS most FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_nationkey)",
    "decision_shares": "SELECT o_orderpriority, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY o_orderpriority",
    "revenue_by_flag": "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
    "graph_edges": f"WITH {_EDGES} SELECT * FROM e",
    "graph_roots": f"WITH {_EDGES} SELECT DISTINCT from_tool AS tool FROM e WHERE from_tool NOT IN (SELECT to_tool FROM e WHERE weight >= 3 AND from_tool < to_tool)",
    "prerequisite_check": "SELECT user_id, (bool_or(event_type = 'signup') AND bool_or(event_type = 'purchase')) OR bool_or(event_type = 'error') AS met FROM events GROUP BY user_id",
    "user_chain_scores": f"WITH {_EDGES}, p AS (SELECT user_id, event_type || '_' || user_id % 4 AS from_tool, lead(event_type || '_' || user_id % 4) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_tool FROM events) SELECT user_id, count(*) - 1 AS n_edges, CAST(coalesce(sum(weight), 0) AS BIGINT) AS score, round(CASE WHEN count(*) > 1 THEN coalesce(sum(weight), 0) / (count(*) - 1) + ln(count(*)) ELSE 0 END, 9)::DOUBLE AS eligibility FROM p LEFT JOIN e USING (from_tool, to_tool) GROUP BY user_id",
    "graph_chains": f"WITH RECURSIVE {_EDGES}, c AS (SELECT DISTINCT [from_tool] AS chain, 0::BIGINT AS score FROM e WHERE from_tool LIKE 'signup%' UNION ALL SELECT list_append(c.chain, e.to_tool), c.score + e.weight FROM c JOIN e ON e.from_tool = c.chain[-1] WHERE NOT list_contains(c.chain, e.to_tool) AND len(c.chain) < 4) SELECT array_to_string(chain, '>') AS chain, score FROM c",
}
