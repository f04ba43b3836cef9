"""Semantic checks of declarations made of orders and their lines, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import acceptance, declarations
from tracewright.session import table

_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines; the number of partitions is told, as few bytes are much work here and would be merged into one task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE).repartition(n, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*_LINE))).alias("lines"))
    return table(spark, sf_dir, "orders").repartition(n, "o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def environment_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an environment whose record sets are its lines."""
    sets = """transform(lines, x -> named_struct('id', CASE WHEN x.l_linenumber = 6 THEN 'temp' ELSE concat('s', x.l_suppkey % 4) END,
        'fields', map('k', named_struct('type', CASE WHEN x.l_returnflag = 'A' THEN 'object' ELSE 'integer' END, 'nullable', x.l_linestatus = 'O', 'scope', CASE WHEN x.l_quantity > 45 THEN 'none' WHEN x.l_quantity > 40 THEN 'files' END)),
        'key_fields', CASE WHEN x.l_discount >= 0.09 THEN array('k', 'z') ELSE array('k') END))"""
    scopes = "CASE WHEN o_orderpriority = '1-URGENT' THEN array('files', 'sqlite_x') WHEN o_orderpriority = '5-LOW' THEN array('files', 'files') ELSE array('files') END"
    links = "array(named_struct('id', 'r', 'left', named_struct('record_set', 's0', 'fields', array('k')), 'right', named_struct('record_set', 's1', 'fields', CASE o_orderstatus WHEN 'F' THEN array('k', 'k') WHEN 'O' THEN CAST(array() AS array<string>) ELSE array('k') END)))"
    envs = with_lines(spark, sf_dir).selectExpr("o_orderkey", f"{sets} AS sets", f"{scopes} AS scopes", f"{links} AS links")
    return declarations.environment_issues(envs, "o_orderkey", "sets", "scopes", "links")


def package_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a rubric package whose rubrics are its lines."""
    name = "CASE WHEN x.l_quantity > 49 THEN 'r 1' ELSE concat('r', i) END"
    rubrics = f"""transform(lines, (x, i) -> named_struct('id', {name}, 'weight', x.l_discount * 10, 'scale', CASE WHEN x.l_tax = 0 THEN 'odd' WHEN x.l_linestatus = 'F' THEN 'binary' ELSE 'ordinal_5' END,
        'criteria', map('0', 'no', '1', 'yes'), 'quotes', array(CASE WHEN x.l_quantity > 47 THEN 'none' ELSE x.l_returnflag END), 'tools', array(concat('t', x.l_suppkey % 3)), 'required', array('t0')))"""
    tools = f"""array(named_struct('id', 't0', 'rubrics', transform(filter(transform(lines, (x, i) -> struct({name} AS id, x.l_suppkey % 3 AS s)), y -> y.s = 0), y -> y.id)), named_struct('id', 't1', 'rubrics', transform(lines, (x, i) -> {name})))"""
    cover = f"transform(filter(transform(lines, (x, i) -> struct({name} AS id, x.l_returnflag AS quote, x.l_quantity AS n)), y -> y.n > 2), y -> struct(y.quote AS quote, array(y.id) AS rubrics))"
    packages = with_lines(spark, sf_dir).selectExpr("o_orderkey", f"{rubrics} AS rubrics", f"{tools} AS tools", f"{cover} AS cover", "array_join(transform(lines, x -> x.l_returnflag), ' ') AS task")
    return declarations.package_issues(packages, "o_orderkey", "rubrics", "tools", "cover", "task")


def _acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's lines as acceptance tests in JSON."""
    test = """named_struct('calls', CASE WHEN x.l_quantity > 2 THEN array(named_struct('tool', CASE WHEN x.l_quantity > 49 THEN '' ELSE 't' END)) ELSE CAST(array() AS array<struct<tool:string>>) END,
        'expect_success', CASE WHEN x.l_linestatus = 'O' THEN false END, 'expected_error', CASE WHEN x.l_discount >= 0.09 THEN named_struct('code', 'c') END,
        'data_checks', CASE WHEN x.l_tax < 0.04 THEN array(named_struct('path', CASE WHEN x.l_tax = 0 THEN 'a' ELSE '/a' END, 'op', 'range', 'min', x.l_quantity, 'max', 40)) END, 'extra', CASE WHEN x.l_linenumber = 7 THEN 1 END)"""
    return with_lines(spark, sf_dir).selectExpr("o_orderkey", f"parse_json(to_json(transform(lines, x -> {test}))) AS tests")


def acceptance_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where acceptance tests break their form."""
    return acceptance.issues_of_tests(_acceptance(spark, sf_dir), "o_orderkey", "tests")


def acceptance_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sets of acceptance tests pass the gate."""
    return acceptance.gate(_acceptance(spark, sf_dir), "o_orderkey", "tests")


QUERIES = {f.__name__: f for f in (environment_issues, package_issues, acceptance_issues, acceptance_gates)}

_LINES = "(SELECT *, l_orderkey AS o_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS i FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
_SETS = f"(SELECT *, CASE WHEN l_linenumber = 6 THEN 'temp' ELSE 's' || l_suppkey % 4 END AS id, CASE WHEN l_returnflag = 'A' THEN 'object' ELSE 'integer' END AS type FROM {_LINES})"
_RUBRICS = f"(SELECT *, CASE WHEN l_quantity > 49 THEN 'r 1' ELSE 'r' || i END AS id, 't' || l_suppkey % 3 AS tool, CASE WHEN l_quantity > 47 THEN 'none' ELSE l_returnflag END AS quote FROM {_LINES})"
ORACLE_SQL = {
    "acceptance_issues": f"""
        SELECT o_orderkey, '' AS path, 'not a list' AS rule FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT o_orderkey, '/' || i || '/calls', 'minItems' FROM {_LINES} WHERE l_quantity <= 2
        UNION ALL SELECT o_orderkey, '/' || i || '/calls/0/tool', 'minLength' FROM {_LINES} WHERE l_quantity > 49
        UNION ALL SELECT o_orderkey, '/' || i, 'additionalProperties' FROM {_LINES} WHERE l_linenumber = 7
        UNION ALL SELECT o_orderkey, '/' || i || '/data_checks/0', 'oneOf' FROM {_LINES} WHERE l_tax = 0
        UNION ALL SELECT o_orderkey, '/' || i || '/data_checks/0', 'empty range' FROM {_LINES} WHERE l_tax < 0.04 AND l_quantity > 40
        UNION ALL SELECT o_orderkey, '/' || i || '/expected_error', 'error of a success' FROM {_LINES} WHERE l_discount >= 0.09 AND l_linestatus <> 'O'""",
    "acceptance_gates": "SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'no tests' WHEN count(*) FILTER (l_linestatus <> 'O') = 0 THEN 'no successful test' WHEN count(*) FILTER (l_linestatus <> 'O' AND l_tax < 0.04) = 0 THEN 'nothing asserted' END AS gate FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
    "environment_issues": f"""
        WITH s AS MATERIALIZED (FROM {_SETS}), firsts AS (SELECT o_orderkey, id, type FROM s QUALIFY row_number() OVER (PARTITION BY o_orderkey, id ORDER BY i) = 1),
        o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, l.type AS l_type, r.type AS r_type FROM orders LEFT JOIN (FROM firsts WHERE id = 's0') l USING (o_orderkey) LEFT JOIN (FROM firsts WHERE id = 's1') r USING (o_orderkey))
        SELECT o_orderkey, 'duplicate_id' AS code, '/sets' AS path, string_agg(id, ',' ORDER BY id) AS detail FROM (SELECT o_orderkey, id FROM s GROUP BY ALL HAVING count(*) > 1) GROUP BY o_orderkey
        UNION ALL SELECT o_orderkey, 'duplicate_id', '/scopes', 'files' FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL SELECT o_orderkey, 'reserved_id', '/sets/' || i, 'temp' FROM s WHERE id = 'temp'
        UNION ALL SELECT o_orderkey, 'reserved_id', '/scopes/1', 'sqlite_x' FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey, 'unknown_scope', '/sets/' || i || '/fields/k', 'none' FROM s WHERE l_quantity > 45
        UNION ALL SELECT o_orderkey, 'invalid_key_field', '/sets/' || i || '/key_fields', 'k' FROM s WHERE type = 'object' OR l_linestatus = 'O'
        UNION ALL SELECT o_orderkey, 'unknown_key_field', '/sets/' || i || '/key_fields', 'z' FROM s WHERE l_discount >= 0.09
        UNION ALL SELECT o_orderkey, 'unknown_record_set', '/links/0/left', 's0' FROM o WHERE l_type IS NULL UNION ALL SELECT o_orderkey, 'unknown_record_set', '/links/0/right', 's1' FROM o WHERE r_type IS NULL
        UNION ALL SELECT o_orderkey, 'invalid_end_field', '/links/0/left', 'k' FROM o WHERE l_type = 'object'
        UNION ALL SELECT o_orderkey, 'invalid_end_field', '/links/0/right', unnest(CASE o_orderstatus WHEN 'F' THEN ['k', 'k'] WHEN 'O' THEN [] ELSE ['k'] END) FROM o WHERE r_type = 'object'
        UNION ALL SELECT o_orderkey, 'empty_end', '/links/0/right', 's1' FROM o WHERE r_type IS NOT NULL AND o_orderstatus = 'O'
        UNION ALL SELECT o_orderkey, 'unequal_ends', '/links/0', CASE o_orderstatus WHEN 'F' THEN '1:2' ELSE '1:0' END FROM o WHERE o_orderstatus IN ('F', 'O')""",
    "package_issues": f"""
        WITH r AS MATERIALIZED (FROM {_RUBRICS}), per AS (SELECT o_orderkey, count(*) FILTER (tool = 't0') AS n0, count(*) AS n FROM r GROUP BY o_orderkey),
        c AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY i) - 1 AS at_c FROM r WHERE l_quantity > 2)
        SELECT o_orderkey, 'nothing' AS code, unnest(['/rubrics', '/cover']) AS path, '' AS detail FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r)
        UNION ALL SELECT o_orderkey, 'nothing', '/cover', '' FROM per WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c)
        UNION ALL SELECT o_orderkey, 'duplicate_id', '/rubrics', string_agg(id, ',' ORDER BY id) FROM (SELECT o_orderkey, id FROM r GROUP BY ALL HAVING count(*) > 1) GROUP BY o_orderkey
        UNION ALL SELECT o_orderkey, 'invalid_id', '/rubrics/' || i, id FROM r WHERE id = 'r 1'
        UNION ALL SELECT o_orderkey, 'invalid_weight', '/rubrics/' || i || '/weight', '0.0' FROM r WHERE l_discount = 0
        UNION ALL SELECT o_orderkey, 'invalid_scale', '/rubrics/' || i || '/scale', 'odd' FROM r WHERE l_tax = 0
        UNION ALL SELECT o_orderkey, 'missing_criteria', '/rubrics/' || i || '/criteria', '2,3,4,5' FROM r WHERE l_tax <> 0 AND l_linestatus <> 'F'
        UNION ALL SELECT o_orderkey, 'invalid_quote', '/rubrics/' || i || '/quotes', 'none' FROM r WHERE quote = 'none'
        UNION ALL SELECT o_orderkey, 'unknown_tool', '/rubrics/' || i || '/tools', 't2' FROM r WHERE tool = 't2'
        UNION ALL SELECT o_orderkey, 'undeclared_tool', '/rubrics/' || i || '/required', 't0' FROM r WHERE tool <> 't0'
        UNION ALL SELECT o_orderkey, 'unknown_rubric', '/tools/0/rubrics', '' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM per WHERE n0 > 0)
        UNION ALL SELECT o_orderkey, 'unknown_rubric', '/tools/1/rubrics', '' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r)
        UNION ALL SELECT a.o_orderkey, 'one_way', '/tools/0/rubrics', string_agg(a.id, ',' ORDER BY a.id) FROM r a SEMI JOIN (FROM r WHERE tool = 't0') b ON a.o_orderkey = b.o_orderkey AND a.id = b.id WHERE a.tool <> 't0' GROUP BY a.o_orderkey
        UNION ALL SELECT o_orderkey, 'one_way', '/tools/1/rubrics', string_agg(id, ',' ORDER BY id) FROM r WHERE tool <> 't1' GROUP BY o_orderkey
        UNION ALL SELECT o_orderkey, 'uncovered', '/cover', string_agg(DISTINCT id, ',' ORDER BY id) FROM r WHERE (o_orderkey, id) NOT IN (SELECT (o_orderkey, id) FROM c) GROUP BY o_orderkey""",
}
