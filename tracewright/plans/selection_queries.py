"""Selections over parts, orders and events: caps, scores, seeded choices, archetypes, budgets, names, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import selection
from tracewright.session import table


def capped_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = table(spark, sf_dir, "part").selectExpr("p_brand", "p_partkey", "CASE WHEN p_brand LIKE '%1' AND p_partkey % 50 = 0 THEN -1 ELSE p_size END AS uses")
    return selection.capped(tools, "p_brand", "uses", "p_partkey", 6)


def seed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size % 6 AS depth", "p_size % 5 AS width", "CASE WHEN p_partkey % 10 = 0 THEN 6 ELSE p_partkey % 4 END AS reach")
    return selection.weighted_scores(rows, {"depth": 40, "width": 35, "reach": 25}).select("p_partkey", "floored", "rounded")


def priority_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.priority_list(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", "p_partkey", 20)


def seeded_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name AS label", "concat(p_type, p_size) AS url")
    taken = rows.where("p_partkey < 40")
    return selection.seeded_distinct(rows, ["p_partkey"], 42, taken, ["url", "label"], 15).select("p_partkey", "label", "url")


def archetype_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").groupBy("p_name").agg(F.collect_list(F.struct(F.col("p_brand").alias("name"), F.expr("p_brand LIKE '%2'").alias("stateful"))).alias("tools"), F.collect_list("p_type").alias("resources"), (F.max("p_size") % 5).alias("requirements"), F.array_join(F.array_sort(F.collect_list("p_brand")), ",").alias("description"))
    return selection.archetype_order(rows, "p_name")


def token_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "n_chars div 4 AS given", "512 AS cap", "2048 AS context", "CASE WHEN doc_id % 2 = 0 THEN 1024 ELSE 4096 END AS server")
    return selection.token_budget(rows, "context", "server", "given", "cap", 64).select("doc_id", "input_budget", "accepted")


def shortened_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer has two long names, and an observed set in which they are shortened, some to a stem of the other."""
    long_ = "concat('service_', repeat('x', 50), '_', {0}, '_', repeat('y', 20))"
    short = "concat('service_', repeat('x', {1}), substring(concat('_', {0}, '_', repeat('y', 20)), 1, 55 - 8 - {1}), '_0123abcd')"
    expected = table(spark, sf_dir, "customer").selectExpr("c_custkey", "'expected' AS side", f"explode(array('plain', {long_.format('1000 + c_custkey')}, {long_.format('5000 + c_custkey')})) AS name")
    cut = f"CASE WHEN c_custkey % 3 = 0 THEN {short.format('1000 + c_custkey', 47)} WHEN c_custkey % 3 = 1 THEN concat('service_', repeat('x', 47), '_0123abc1') ELSE concat('other___', repeat('x', 47), '_0123abcd') END"
    observed = table(spark, sf_dir, "customer").selectExpr("c_custkey", "'observed' AS side", f"explode(array('plain', {cut}, concat('service_', repeat('x', 47), '_0123abce'))) AS name")
    return selection.shortened_match(expected.unionByName(observed), "c_custkey")


def toolset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = table(spark, sf_dir, "orders").selectExpr("o_custkey % 60 AS owner", "concat(o_orderstatus, CASE WHEN o_custkey % 60 < 20 THEN o_custkey % 4 ELSE 9 END) AS definition")
    return selection.toolset_groups(tools, "owner", "definition").select(F.array_join(F.transform("owners", lambda o: o.cast("string")), ",").alias("owners"))


def chain_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderstatus").alias("chain"))
    return selection.length_distribution({"attempted": chains, "eligible": chains.where("size(chain) > 8"), "selected": chains.where("size(chain) > 8 AND o_custkey % 7 = 0")}, "chain")


def mutation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").selectExpr("user_id", "event_type AS tool", "event_id % 3 > 0 AS success")
    tools = spark.createDataFrame([("purchase", True), ("signup", True), ("view", False)], "tool string, side_effects boolean")
    return selection.mutations(calls, tools, "user_id")


def path_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set(F.expr("concat('/', p_type, '/', p_name, '.', p_size)")).alias("paths"))
    found = selection.path_features(F.col("paths"), {"small": "^/SMALL/", "red": "/red ", "big": r"[.](49|50)$", "none": "^/nowhere"})
    return rows.select("p_brand", F.array_join(found, ",").alias("features"))


def meaningful_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").selectExpr("event_id", "event_type AS tool", "event_id % 5 > 0 AS valid_input", "event_id % 3 > 0 AS success", "CASE WHEN event_id % 2 = 0 THEN event_id % 4 = 0 END AS negative")
    tools = table(spark, sf_dir, "events").where("event_type <> 'signup'").select(F.col("event_type").alias("tool"))
    return selection.meaningful_calls(calls, tools).select("event_id", "tool")


def tool_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    reasons = {"no description": F.col("p_name").startswith("red"), "too many inputs": size > 40, "needs a network": F.col("p_type") == "ECONOMY"}
    return table(spark, sf_dir, "part").select("p_partkey", selection.exclusion_reason(reasons).alias("reason"))


def unified_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr("user_id", "event_type AS name", "event_id AS start")
    return selection.unified_calls(events.where("name IN ('view', 'click')"), events.where("name IN ('purchase', 'error')"), "user_id")


def capped_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    return selection.capped_in_order(rows, "p_brand", "p_size", "p_partkey", 5)


def verifier_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("CASE WHEN o_orderkey % 9 = 0 THEN 'failed' ELSE 'generated' END AS status", "CASE WHEN o_orderkey % 9 > 0 AND o_orderkey % 7 > 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'fallback' ELSE 'program' END END AS mode", "CASE WHEN o_orderkey % 4 = 0 THEN 'verification_error' ELSE 'completed' END AS result", "CASE WHEN o_orderkey % 2 = 0 THEN 1.0D ELSE 0.5D END AS score")
    return selection.batch_summary(rows)


QUERIES = {f.__name__: f for f in (capped_tools, seed_scores, priority_list, seeded_themes, archetype_ranks, token_budgets, shortened_names, toolset_groups, chain_lengths, mutation_counts, path_feature_sets, meaningful_calls, tool_exclusions, unified_calls, capped_methods, verifier_batch)}

_SUM = "(p_size % 6) * 40 + (p_size % 5) * 35 + (p_partkey % 4) * 25"
ORACLE_SQL = {
    "capped_tools": """
        WITH t AS (SELECT p_brand, p_partkey, CASE WHEN p_brand LIKE '%1' AND p_partkey % 50 = 0 THEN -1 ELSE p_size END AS uses FROM part), v AS (SELECT *, min(uses) OVER (PARTITION BY p_brand) >= 0 AS valid FROM t),
        r AS (SELECT p_brand, p_partkey, uses, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN valid THEN -uses ELSE 0 END, p_partkey) AS INT) AS place FROM v) SELECT * FROM r WHERE place <= 6""",
    "seed_scores": f"SELECT p_partkey, CASE WHEN p_partkey % 10 > 0 THEN CAST(({_SUM}) // 5 AS BIGINT) END AS floored, CASE WHEN p_partkey % 10 > 0 THEN CAST(round_even(({_SUM}) / 5, 0) AS BIGINT) END AS rounded FROM part",
    "priority_list": "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 20",
    "seeded_themes": """
        WITH RECURSIVE t AS (SELECT p_partkey, p_name AS label, p_type || p_size AS url, md5('42:' || p_partkey) AS place FROM part),
        open AS (SELECT *, row_number() OVER (ORDER BY place, p_partkey) AS k FROM t WHERE url NOT IN (SELECT url FROM t WHERE p_partkey < 40) AND label NOT IN (SELECT label FROM t WHERE p_partkey < 40)),
        pass AS (
          SELECT 0::BIGINT AS k, []::VARCHAR[] AS labels, []::VARCHAR[] AS urls, []::BIGINT[] AS picked
          UNION ALL SELECT o.k, CASE WHEN free THEN list_append(labels, label) ELSE labels END, CASE WHEN free THEN list_append(urls, url) ELSE urls END, CASE WHEN free THEN list_append(picked, p_partkey) ELSE picked END
          FROM (SELECT o.*, p.labels, p.urls, p.picked, NOT list_contains(p.labels, o.label) AND NOT list_contains(p.urls, o.url) AS free FROM pass p JOIN open o ON o.k = p.k + 1 WHERE len(p.picked) < 15) o)
        SELECT p_partkey, label, url FROM t WHERE list_contains((SELECT picked FROM pass ORDER BY k DESC LIMIT 1), p_partkey)""",
    "archetype_ranks": """
        SELECT p_name, CAST(count(*) FILTER (p_brand LIKE '%2') > 0 AS INT) AS grounded, CAST(count(DISTINCT p_brand) FILTER (p_brand LIKE '%2') AS INT) AS stateful, CAST(count(DISTINCT p_brand) AS INT) AS n_tools,
          CAST(count(DISTINCT p_type) AS INT) AS n_resources, CAST(max(p_size) % 5 + length(string_agg(p_brand, ',')) // 200 AS INT) AS breadth FROM part GROUP BY p_name""",
    "token_budgets": "SELECT doc_id, CAST(least(2048, CASE WHEN doc_id % 2 = 0 THEN 1024 ELSE 4096 END) - 576 AS INT) AS input_budget, n_chars // 4 + 576 <= least(2048, CASE WHEN doc_id % 2 = 0 THEN 1024 ELSE 4096 END) AS accepted FROM documents",
    "shortened_names": "SELECT c_custkey, c_custkey % 3 < 2 AS matched FROM customer",
    "toolset_groups": """
        WITH s AS (SELECT owner, string_agg(DISTINCT definition, ',' ORDER BY definition) AS d FROM (SELECT o_custkey % 60 AS owner, o_orderstatus || CASE WHEN o_custkey % 60 < 20 THEN o_custkey % 4 ELSE 9 END AS definition FROM orders) GROUP BY owner)
        SELECT string_agg(CAST(owner AS VARCHAR), ',' ORDER BY owner) AS owners FROM s GROUP BY d HAVING count(*) > 1""",
    "chain_lengths": """
        WITH c AS (SELECT o_custkey, count(*) AS length FROM orders GROUP BY o_custkey)
        SELECT 'attempted' AS stage, length, count(*) AS n FROM c GROUP BY length UNION ALL SELECT 'eligible', length, count(*) FROM c WHERE length > 8 GROUP BY length UNION ALL SELECT 'selected', length, count(*) FROM c WHERE length > 8 AND o_custkey % 7 = 0 GROUP BY length""",
    "mutation_counts": "SELECT user_id, count(*) FILTER (event_type IN ('purchase', 'signup') AND event_id % 3 > 0) AS mutations FROM events GROUP BY user_id",
    "path_feature_sets": "SELECT p_brand, concat_ws(',', CASE WHEN bool_or(p_type = 'SMALL') THEN 'small' END, CASE WHEN bool_or(p_name LIKE 'red %') THEN 'red' END, CASE WHEN bool_or(p_size IN (49, 50)) THEN 'big' END) AS features FROM part GROUP BY p_brand",
    "meaningful_calls": "SELECT event_id, event_type AS tool FROM events WHERE event_type <> 'signup' AND event_id % 5 > 0 AND (event_id % 3 > 0 OR event_id % 4 = 0)",
    "tool_exclusions": "SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'no description' WHEN p_size > 40 THEN 'too many inputs' WHEN p_type = 'ECONOMY' THEN 'needs a network' END AS reason FROM part",
    "unified_calls": """
        SELECT user_id, CASE WHEN event_type IN ('view', 'click') THEN 'native' ELSE 'domain' END AS kind, event_type AS name, event_id AS start, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS place FROM events WHERE event_type <> 'signup'""",
    "capped_methods": """
        WITH r AS (SELECT p_brand, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) <= 5)
        SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INT) AS place FROM r""",
    "verifier_batch": """
        WITH r AS (SELECT o_orderkey AS k, o_orderkey % 9 > 0 AND o_orderkey % 7 > 0 AS started FROM orders)
        SELECT count(*) AS total, count(*) FILTER (k % 9 > 0) AS generated, count(*) FILTER (started) AS started, count(*) FILTER (started AND k % 5 > 0 AND k % 4 > 0) AS completed, count(*) FILTER (started AND k % 5 > 0 AND k % 4 > 0 AND k % 2 = 0) AS full_score,
          count(*) FILTER (started AND k % 5 = 0) AS fallbacks, count(*) FILTER (k % 4 = 0) AS verification_errors FROM r""",
}
