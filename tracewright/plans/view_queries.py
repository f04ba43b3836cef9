"""Views of graphs and tasks made of orders and their lines, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import views
from tracewright.plans.declaration_queries import with_lines

_TO = "element_at(array('A', 'N', 'X'), CAST(x.l_suppkey % 3 AS INT) + 1)"


def _bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a bundle: edges of its lines from the second on, a task per line."""
    edges = f"transform(filter(slice(lines, 2, 2), x -> x.l_suppkey % 3 < 2 OR x.l_quantity > 40), x -> struct(x.l_returnflag AS from_tool, {_TO} AS to_tool, CASE WHEN x.l_tax = 0 THEN 4 ELSE 1 + CAST(x.l_quantity AS INT) % 3 END AS weight, CAST(NULL AS STRING) AS reason))"
    needs = "array(struct('A' AS to_tool, array(struct(array('N') AS all_of, CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' ELSE 'r' END AS reason)) AS any_of))"
    tasks = """transform(lines, (x, i) -> struct(concat('t', i) AS task_id, CASE WHEN x.l_quantity > 49 THEN CAST(array() AS array<string>) ELSE array('N', x.l_returnflag) END AS chain, x.l_tax AS score,
        CASE WHEN x.l_discount < 0.03 THEN struct(true AS passed, CAST(array() AS array<string>) AS errors) WHEN x.l_discount < 0.06 OR x.l_quantity > 49 THEN struct(false AS passed, array('e') AS errors) END AS validation,
        struct(x.l_tax > 0.02 AS success, CASE WHEN x.l_suppkey % 2 = 0 THEN array('N') END AS calls, CASE WHEN x.l_suppkey % 5 = 0 THEN array(struct('N' AS failed_tool, 'k' AS failure_kind)) END AS attempts) AS execution))"""
    return with_lines(spark, sf_dir).selectExpr("o_orderkey", "array('A', 'N', 'R') AS tools", f"{edges} AS edges", f"{needs} AS prerequisites", f"{tasks} AS tasks")


def graph_view_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bars the views of bundles."""
    return views.view_issues(_bundles(spark, sf_dir), "o_orderkey")


def graph_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each view, its edges and the tools at which its tasks failed."""
    edges = F.array_join(F.transform("edges", lambda e: F.concat_ws(">", e["id"], e["source"], e["target"], e["weight"].cast("string"))), ",")
    failed = F.array_join(F.transform("tasks", lambda t: F.coalesce(t["failed_tool"], F.lit("-"))), ",")
    return views.packed_views(_bundles(spark, sf_dir), "o_orderkey").select("o_orderkey", edges.alias("edges"), failed.alias("failed"), F.col("counts.tasks").alias("tasks"), "counts.passed", "counts.rejected", "counts.pending")


QUERIES = {f.__name__: f for f in (graph_view_issues, graph_views)}

_LINES = "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag) - 1 AS i FROM lineitem)"
_EDGES = f"(SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) - 1 AS e, l_returnflag AS a, ['A', 'N', 'X'][l_suppkey % 3 + 1] AS b, CASE WHEN l_tax = 0 THEN 4 ELSE 1 + CAST(l_quantity AS INT) % 3 END AS w FROM {_LINES} WHERE i IN (1, 2) AND (l_suppkey % 3 < 2 OR l_quantity > 40))"
_ISSUES = f"""(
    SELECT k AS o_orderkey, 'unknown_tool' AS code, '/edges/' || e AS path, a || '>' || b AS detail FROM {_EDGES} WHERE b = 'X'
    UNION ALL SELECT k, 'invalid_weight', '/edges/' || e, '4' FROM {_EDGES} WHERE w = 4
    UNION ALL (SELECT k, 'repeated_edge', '/edges/' || e, a || '>' || b FROM {_EDGES} QUALIFY row_number() OVER (PARTITION BY k, a, b ORDER BY e) > 1)
    UNION ALL SELECT o_orderkey, 'invalid_alternative', '/prerequisites/0/any_of/0', 'N' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT l_orderkey, 'empty_chain', '/tasks/' || i, 't' || i FROM {_LINES} WHERE l_quantity > 49 AND l_discount < 0.03)"""
ORACLE_SQL = {
    "graph_view_issues": f"FROM {_ISSUES} SEMI JOIN orders USING (o_orderkey)",
    "graph_views": f"""
        SELECT o_orderkey, coalesce(edges, '') AS edges, coalesce(failed, '') AS failed, coalesce(tasks, 0) AS tasks, coalesce(passed, 0) AS passed, coalesce(rejected, 0) AS rejected, coalesce(pending, 0) AS pending FROM orders
        LEFT JOIN (SELECT k AS o_orderkey, string_agg('base-' || e || '>' || a || '>' || b || '>' || w, ',' ORDER BY e) AS edges FROM {_EDGES} GROUP BY k) USING (o_orderkey)
        LEFT JOIN (SELECT l_orderkey AS o_orderkey, CAST(count(*) AS INT) AS tasks, CAST(count(*) FILTER (l_discount < 0.03) AS INT) AS passed, CAST(count(*) FILTER (l_discount >= 0.03 AND (l_discount < 0.06 OR l_quantity > 49)) AS INT) AS rejected, CAST(count(*) FILTER (l_discount >= 0.06 AND l_quantity <= 49) AS INT) AS pending,
            string_agg(CASE WHEN l_quantity > 49 THEN '-' WHEN l_suppkey % 5 = 0 THEN 'N' WHEN l_tax > 0.02 THEN '-' WHEN l_suppkey % 2 = 0 THEN l_returnflag ELSE 'N' END, ',' ORDER BY i) AS failed FROM {_LINES} GROUP BY l_orderkey) USING (o_orderkey)
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_ISSUES})""",
}
