"""Queries of choices where one pick bars others, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import assignment
from tracewright.session import table

SAMPLE_LABELS = ["urgent", "large", "open", "filled", "any"]


def bulk_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation of customers: how many can each have a supplier of one of their bulk orders for themselves."""
    bulk = table(spark, sf_dir, "lineitem").where("l_quantity >= 48").select("l_orderkey", "l_suppkey")
    edges = bulk.join(table(spark, sf_dir, "orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer").hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "c_custkey", "l_suppkey")
    sides = edges.groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("customers"), F.count_distinct("l_suppkey").alias("suppliers"))
    found = assignment.maximum_matching(edges, "c_nationkey", "c_custkey", "l_suppkey").groupBy("c_nationkey").agg(F.count("*").alias("matched"))
    return sides.join(found, "c_nationkey")


def distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by descending price that share neither customer nor day with one taken before."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), (-F.col("o_totalprice")).alias("rank"))
    return assignment.first_distinct(rows, ["rank", "o_orderkey"], ["o_custkey", "day"]).select("o_orderkey", "o_custkey")


def sample_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month one order a label, no customer twice."""
    tests = {"urgent": F.col("o_orderpriority").startswith("1"), "large": F.col("o_totalprice") > 150000, "open": F.col("o_orderstatus") == "O", "filled": F.col("o_orderstatus") == "F", "any": F.lit(True)}
    features = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), features.alias("features"), "o_custkey", "o_totalprice", "o_orderkey")
    return assignment.one_per_label(rows, "month", SAMPLE_LABELS, "features", "o_custkey", ["o_totalprice", "o_orderkey"]).select("month", "label", "o_custkey", "o_orderkey")


def _order_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.max("l_quantity").alias("most"), F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_discount") >= 0.09).alias("cut"))
    rows = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    tests = {"returned": F.col("returned"), "cut": F.col("cut"), "many": F.col("lines") >= 6, "bulk": F.col("most") >= 49, "dear": F.col("o_totalprice") > 150000}
    forms = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))
    return rows.select("o_orderpriority", "o_orderkey", forms.alias("forms"), F.col("o_orderstatus").alias("kind"), "lines", F.floor("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))


def order_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per priority twelve orders that differ in form from each other and from those of 1992."""
    rows = _order_forms(spark, sf_dir)
    return assignment.novelty_portfolio(rows.where("year > 1992"), rows.where("year <= 1992"), "o_orderpriority", "o_orderkey", "forms", "kind", ["lines", "price"], 12)


QUERIES = {f.__name__: f for f in (bulk_matching, distinct_orders, sample_per_label, order_portfolio)}

_LABEL_TESTS = {"urgent": "o_orderpriority LIKE '1%'", "large": "o_totalprice > 150000", "open": "o_orderstatus = 'O'", "filled": "o_orderstatus = 'F'", "any": "true"}


def _samples_sql() -> str:
    """The labels one after another."""
    steps, before = [], []
    for k, (label, test) in enumerate(_LABEL_TESTS.items()):
        used = " AND ".join(f"NOT EXISTS (SELECT 1 FROM p{j} WHERE p{j}.month = o.month AND p{j}.o_custkey = o.o_custkey)" for j in before) or "true"
        steps.append(f"p{k} AS (SELECT month, '{label}' AS label, o_custkey, o_orderkey FROM o WHERE {test} AND {used} QUALIFY row_number() OVER (PARTITION BY month ORDER BY o_totalprice, o_orderkey) = 1)")
        before.append(k)
    return "WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders), " + ", ".join(steps) + " " + " UNION ALL ".join(f"SELECT * FROM p{k}" for k in before)


_FORM_NAMES = ["bulk", "cut", "dear", "many", "returned"]
_COUNTS = ", ".join(f"c{k}" for k in range(5))
_HAS = [f"CAST(list_contains(o.forms, '{f}') AS INT)" for f in _FORM_NAMES]
ORACLE_SQL = {
    "distinct_orders": """
        WITH RECURSIVE o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders),
        state AS (SELECT 0 AS round, o.*, false AS taken FROM o
          UNION ALL SELECT round + 1, o_orderkey, o_custkey, day, place, first FROM (
            SELECT *, place = min(place) OVER (PARTITION BY o_custkey) AND place = min(place) OVER (PARTITION BY day) AS first,
              bool_or(lead) OVER (PARTITION BY o_custkey) OR bool_or(lead) OVER (PARTITION BY day) AS touched FROM (
                SELECT *, place = min(place) OVER (PARTITION BY o_custkey) AND place = min(place) OVER (PARTITION BY day) AS lead FROM state WHERE NOT taken))
          WHERE first OR NOT touched)
        SELECT o_orderkey, o_custkey FROM state WHERE taken""",
    "sample_per_label": _samples_sql(),
    "order_portfolio": f"""
        WITH RECURSIVE l AS (SELECT l_orderkey, count(*) AS lines, max(l_quantity) AS most, bool_or(l_returnflag = 'R') AS returned, bool_or(l_discount >= 0.09) AS cut FROM lineitem GROUP BY l_orderkey),
        every AS (SELECT o_orderpriority, o_orderkey, o_orderstatus AS kind, lines, floor(o_totalprice) AS price, year(o_orderdate) AS y,
          list_filter([CASE WHEN most >= 49 THEN 'bulk' END, CASE WHEN cut THEN 'cut' END, CASE WHEN o_totalprice > 150000 THEN 'dear' END, CASE WHEN lines >= 6 THEN 'many' END, CASE WHEN returned THEN 'returned' END], lambda x: x IS NOT NULL) AS forms FROM orders JOIN l ON o_orderkey = l_orderkey),
        start AS (SELECT p.o_orderpriority, {', '.join(f"count(*) FILTER (y <= 1992 AND list_contains(forms, '{f}')) AS c{k}" for k, f in enumerate(_FORM_NAMES))},
          coalesce(list(DISTINCT array_to_string(forms, ',')) FILTER (y <= 1992), []) AS sets, coalesce(list(DISTINCT kind) FILTER (y <= 1992), []) AS kinds FROM every p GROUP BY ALL),
        chosen AS (SELECT o_orderpriority, CAST(-1 AS BIGINT) AS o_orderkey, 0 AS place, {_COUNTS}, sets, kinds, []::BIGINT[] AS picked FROM start
          UNION ALL SELECT o_orderpriority, o_orderkey, place + 1, {', '.join(f'n{k}' for k in range(5))}, list_append(sets, name), list_append(kinds, kind), list_append(picked, o_orderkey) FROM (
            SELECT c.o_orderpriority, o.o_orderkey, c.place, {', '.join(f'c{k} + {h} AS n{k}' for k, h in enumerate(_HAS))}, c.sets, c.kinds, c.picked, array_to_string(o.forms, ',') AS name, o.kind FROM chosen c JOIN every o ON o.o_orderpriority = c.o_orderpriority AND y > 1992
            WHERE c.place < 12 AND NOT list_contains(c.picked, o.o_orderkey)
            QUALIFY row_number() OVER (PARTITION BY c.o_orderpriority ORDER BY {' + '.join(f'{h} * CAST(c{k} = 0 AS INT)' for k, h in enumerate(_HAS))} DESC, NOT list_contains(c.sets, array_to_string(o.forms, ',')) DESC, NOT list_contains(c.kinds, o.kind) DESC,
              round({' + '.join(f'{h} / (1.0 + c{k})' for k, h in enumerate(_HAS))}, 12) DESC, lines DESC, price DESC, o.o_orderkey) = 1))
        SELECT o_orderpriority, o_orderkey, CAST(place AS INT) AS place FROM chosen WHERE place > 0""",
}
