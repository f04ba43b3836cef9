"""Contracts over the tables: formats, nested validation, references, verdicts, parameter sources, graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import formats
from tracewright.operators import constraints, contracts
from tracewright.session import table

_KEY = "o_orderkey"
#: Texts of each format, valid in some rows only.
_SAMPLES = {
    "date": ("concat('2024-', CASE WHEN o_orderkey % 3 = 0 THEN '13' ELSE '02' END, '-', CASE WHEN o_orderkey % 5 = 0 THEN '30' ELSE '28' END)", "o_orderkey % 3 > 0 AND o_orderkey % 5 > 0"),
    "date-time": ("concat('2024-02-11T', CASE WHEN o_orderkey % 4 = 0 THEN '25' ELSE '23' END, ':59:00', CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE 'Z' END)", "o_orderkey % 4 > 0 AND o_orderkey % 7 > 0"),
    "time": ("concat('12:', CASE WHEN o_orderkey % 3 = 0 THEN '60' ELSE '59' END, CASE WHEN o_orderkey % 2 = 0 THEN '+02:00' ELSE '' END)", "o_orderkey % 3 > 0"),
    "duration": ("concat('P', CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '1D' END, CASE WHEN o_orderkey % 2 = 0 THEN 'T2H' ELSE '' END)", "o_orderkey % 3 > 0 OR o_orderkey % 2 = 0"),
    "uri": ("concat(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https:' END, '//host/', o_orderkey)", "o_orderkey % 3 > 0"),
    "uuid": ("concat('12345678-1234-1234-1234-1234567890', CASE WHEN o_orderkey % 3 = 0 THEN 'zz' ELSE 'ab' END)", "o_orderkey % 3 > 0"),
    "email": ("concat('a', CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '' END, '@b', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '.org' END)", "o_orderkey % 3 > 0 AND o_orderkey % 4 > 0"),
    "hostname": ("concat(CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE 'a' END, 'b.example', CASE WHEN o_orderkey % 4 = 0 THEN '_' ELSE '' END)", "o_orderkey % 3 > 0 AND o_orderkey % 4 > 0"),
    "ipv4": ("concat('10.0.0.', o_orderkey % 400)", "o_orderkey % 400 < 256"),
    "ipv6": ("concat(CASE WHEN o_orderkey % 3 = 0 THEN '1::2' ELSE '2001:db8' END, '::', o_orderkey % 9, CASE WHEN o_orderkey % 5 = 0 THEN ':g' ELSE ':7' END)", "o_orderkey % 3 > 0 AND o_orderkey % 5 > 0"),
}


def string_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(_KEY, *(f"{x} AS `{n}`" for n, (x, _) in _SAMPLES.items()))
    return rows.select(_KEY, *(formats.has_format(F.col(f"`{n}`"), n).alias(n.replace("-", "_")) for n in _SAMPLES))


_SCHEMA = {
    "properties": {
        "id": {"minimum": 10, "multipleOf": 3},
        "meta": {"properties": {"lang": {"enum": ["en", "de", "fr"]}, "source": {"pattern": "^src[0-9]$", "maxLength": 4}}},
        "lines": {"minItems": 2, "maxItems": 40, "uniqueItems": True, "items": {"maxLength": 400}},
        "size": {"nullable": True, "maximum": 5000},
    }
}


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.struct(F.col("doc_id").alias("id"), F.struct("lang", "source").alias("meta"), F.split("text", "\n").alias("lines"), F.expr("CASE WHEN doc_id % 4 > 0 THEN n_chars END").alias("size")).alias("record"))


def nested_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("doc_id", F.inline(constraints.violations(F.col("record"), _SCHEMA)))


def first_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = constraints.first_violation(F.col("record"), _SCHEMA)
    return _records(spark, sf_dir).select("doc_id", first.alias("first")).select("doc_id", "first.path", "first.rule")


_FORMAT_FIELDS = {"ip": constraints.Field("string", format="ipv4"), "n": constraints.Field("integer", multiple_of=3), "c": constraints.Field("string", const="O")}


def format_constraint_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(_KEY, f"{_SAMPLES['ipv4'][0]} AS ip", f"{_KEY} AS n", "o_orderstatus AS c")
    return constraints.row_issues(rows, [_KEY], _FORMAT_FIELDS)


_URLS = "CASE o_orderkey % 5 WHEN 0 THEN concat('https://raw.githubusercontent.com/a/b/', repeat('0a1B', 10), '/f') WHEN 1 THEN 'https://github.com/a/b/archive/main.zip' WHEN 2 THEN 'https://github.com/a/b' WHEN 3 THEN concat('https://api.github.com/repos/a/b/contents/x?z=1&ref=', repeat('0a', 20), 'f') ELSE concat('http://codeload.github.com/a/b/zip/', repeat('f0', 20)) END"
_PATHS = "CASE o_orderkey % 8 WHEN 0 THEN 'a/b.txt' WHEN 1 THEN '/etc/x' WHEN 2 THEN 'a/../b' WHEN 3 THEN 'a//b' WHEN 4 THEN 'a\\\\b' WHEN 5 THEN '__pycache__/m.pyc' WHEN 6 THEN 'src/m.pyo' ELSE 'C:x' END"
_QUANTITIES = "CASE o_orderkey % 5 WHEN 0 THEN concat(o_orderkey, ' GHz') WHEN 1 THEN '2.5khz' WHEN 2 THEN '3e2 Hz' WHEN 3 THEN '7 parsec' ELSE 'fast' END"


def url_path_and_unit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(_KEY, f"{_URLS} AS url", f"{_PATHS} AS path", f"{_QUANTITIES} AS quantity")
    uri = formats.resource_scope(F.concat(F.lit("aw://files/"), "path"))
    return rows.select(_KEY, formats.url_stability(F.col("url")).alias("stability"), formats.safe_relative(F.col("path")).alias("is_safe"), formats.runtime_cache_path(F.col("path")).alias("is_cache"), uri["scope"].alias("scope"), uri["path"].alias("scoped_path"), formats.in_hertz(F.col("quantity")).alias("hertz"))


def tool_name_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"red": "crimson", "red widget": "gadget", "small": "little", "bolt": "pin"}
    return table(spark, sf_dir, "part").select("p_partkey", formats.mapped_names(F.col("p_name"), names).alias("name"))


def unresolved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "concat('see /data1/', p_brand, '/x and /data1/ok/', p_size, ' or /usr/bin and /data1/', p_brand, '/x')"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{text} AS text")
    return rows.select("p_partkey", F.array_join(formats.unresolved_paths(F.col("text"), ["/data1/", "/root/.cli/"], ["/data1/ok"]), ",").alias("paths"))


def tool_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("tool", F.split("p_name", " ")[1])
    score = formats.relevance(F.lit("find the red widget or small bolt"), F.col("tool"), F.concat_ws(" ", "p_name", "p_type"))
    return rows.select("p_partkey", score.cast("long").alias("score"), formats.character_sum(F.col("p_name")).alias("character_sum"))


def file_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(_KEY, "array(concat('f', o_custkey % 90), concat('f', o_orderkey % 70), null) AS refs")
    files = table(spark, sf_dir, "customer").selectExpr("concat('f', c_custkey % 60) AS path")
    return contracts.missing_files(rows, files, [_KEY], "refs")


def layout_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_type, '/', p_brand, CASE WHEN p_size < 20 THEN '.json' ELSE '.csv' END) AS path")
    return contracts.uncovered_files(files, ["^ECONOMY/", r"^SMALL/Brand#1[^/]*\.csv$"])


def verdict_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.selectExpr("doc_id", "text", "explode(CASE WHEN doc_id % 6 = 0 THEN array(0, 1) WHEN doc_id % 6 = 1 THEN array(0, 1, 2, 2) WHEN doc_id % 6 = 2 THEN array(0, 1, 2, 3) ELSE array(0, 1, 2) END) AS requirement")
    verdicts = rows.selectExpr("doc_id", "requirement", "CASE WHEN doc_id % 10 = 3 AND requirement = 1 THEN 'not in the text~' ELSE substring(text, 1, 10) END AS quote", "doc_id % 7 <> requirement AS passed", "CASE WHEN doc_id % 7 > 3 OR doc_id % 11 = 0 THEN 'pass' ELSE 'fail' END AS outcome")
    requirements = docs.selectExpr("doc_id", "explode(array(0, 1, 2)) AS requirement")
    return contracts.verdict_issues(verdicts, requirements, docs, "doc_id")


def parameter_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    leaves = orders.selectExpr(_KEY, "explode(array('/a/b', '/a/c', '/d/0', '/d/1')) AS pointer")
    sources = orders.selectExpr(_KEY, "explode(CASE o_orderkey % 4 WHEN 0 THEN array('/a', '/d') WHEN 1 THEN array('/a', '/a/b', '/d/0') WHEN 2 THEN array('') ELSE array('/a/b', '/d', '/zz') END) AS pointer")
    return contracts.leaf_sources(leaves, sources, [_KEY])


def tool_allowlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "CASE c_custkey % 3 WHEN 0 THEN array('b', 'a') WHEN 1 THEN array('a') ELSE array('a', 'b', 'x') END AS tools", "array('a', 'b') AS allowed")
    return contracts.allowlist_issues(rows, "c_custkey", "tools", "allowed")


def score_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size % 7 AS depth", "p_size % 5 AS width", "2.0 * (p_size % 7) + 0.5 * (p_size % 5) + CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS total", "CASE WHEN p_partkey % 8 = 0 THEN 'keep' WHEN 2.0 * (p_size % 7) + 0.5 * (p_size % 5) >= 8 THEN 'keep' WHEN 2.0 * (p_size % 7) + 0.5 * (p_size % 5) >= 4 THEN 'review' ELSE 'drop' END AS route")
    return contracts.score_issues(rows.withColumn("total", F.col("total").cast("double")), "p_partkey", {"depth": 2.0, "width": 0.5}, "total", "route", [(8.0, "keep"), (4.0, "review")], "drop")


def access_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "orders").selectExpr("concat(o_orderstatus, o_custkey % 9) AS asset")
    access = table(spark, sf_dir, "nation").selectExpr("concat(element_at(array('F', 'O', 'P'), n_nationkey % 3 + 1), n_nationkey % 9) AS asset", "CASE WHEN n_nationkey % 2 = 0 THEN 'read_only' ELSE 'copy_on_write' END AS access")
    return contracts.access_issues(changes, access)


def history_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey", "CASE WHEN o_custkey % 5 = 0 THEN o_orderstatus ELSE 'O' END AS environment", "o_orderkey % 100 AS task")
    return contracts.history_issues(rows, "o_custkey", "environment", "task")


def rubric_symmetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_partkey % 300 AS rubric", "l_suppkey % 90 AS tool", "l_linenumber AS n")
    return contracts.one_way_links(lines.where("n <= 4"), lines.where("n >= 3"), "rubric", "tool")


def graph_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = table(spark, sf_dir, "events").selectExpr("user_id AS env", "event_type AS name")
    steps = table(spark, sf_dir, "events").selectExpr("user_id AS env", "event_type AS from_tool", "element_at(array('view', 'click', 'error', 'purchase', 'other'), cast(event_id % 5 + 1 AS int)) AS to_tool", "cast(event_id % 6 AS int) - 1 AS weight", "event_id % 3 = 0 AS prerequisite")
    return contracts.graph_decision_issues(steps.where("from_tool <> to_tool"), tools, "env", "name")


def graph_edge_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").selectExpr("concat('t', l_suppkey % 40) AS from_tool", "concat('t', l_partkey % 40) AS to_tool", "cast(l_quantity % 5 AS int) AS weight")
    known = table(spark, sf_dir, "supplier").selectExpr("concat('t', s_suppkey % 35) AS name")
    return contracts.edge_issues(edges, known)


def claimed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders").selectExpr("o_custkey AS grp", "o_orderkey AS item")
    claims = items.where("NOT (grp % 4 = 1 AND item % 3 = 0)").selectExpr("grp", "item % 3 AS class", "item").unionByName(items.where("grp % 4 = 2 AND item % 5 = 0").selectExpr("grp", "9 AS class", "item"))
    return contracts.partition_claims(claims, items, "grp", "item")


def distinct_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]), 1, 3), ">").alias("chain"))
    return contracts.first_chains(chains, "chain", "user_id")


def url_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("url", F.regexp_replace("url", "/[^/]*$", ""))
    cited = table(spark, sf_dir, "orders").selectExpr("concat(CASE WHEN o_orderkey % 3 = 0 THEN 'ftp' ELSE 'https' END, '://cited.example/', o_orderkey % 20) AS url").unionByName(pages.select("url"))
    return contracts.first_urls(pages.select("url", "page_id"), cited, "url", "page_id")


QUERIES = {f.__name__: f for f in (string_formats, nested_violations, first_violations, format_constraint_issues, url_path_and_unit_values, tool_name_mapping, unresolved_paths, tool_relevance, file_references, layout_coverage, verdict_contract, parameter_sources, tool_allowlists, score_audit, access_violations, history_consistency, rubric_symmetry, graph_decisions, graph_edge_contract, claimed_classes, distinct_chains, url_registry)}

_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents)"
_VIOLATIONS = f"""(SELECT doc_id, '/id' AS path, 'minimum' AS rule FROM documents WHERE doc_id < 10 UNION ALL SELECT doc_id, '/id', 'multipleOf' FROM documents WHERE doc_id % 3 > 0
  UNION ALL SELECT doc_id, '/meta/lang', 'enum' FROM documents WHERE lang NOT IN ('en', 'de', 'fr') UNION ALL SELECT doc_id, '/meta/source', 'pattern' FROM documents WHERE NOT regexp_full_match(source, 'src[0-9]')
  UNION ALL SELECT doc_id, '/meta/source', 'maxLength' FROM documents WHERE length(source) > 4 UNION ALL SELECT doc_id, '/lines', 'minItems' FROM documents WHERE len(string_split(text, chr(10))) < 2
  UNION ALL SELECT doc_id, '/lines', 'maxItems' FROM documents WHERE len(string_split(text, chr(10))) > 40 UNION ALL SELECT doc_id, '/lines', 'uniqueItems' FROM {_LINES} GROUP BY doc_id HAVING count(*) > count(DISTINCT line)
  UNION ALL SELECT doc_id, '/lines/' || k, 'maxLength' FROM {_LINES} WHERE length(line) > 400 UNION ALL SELECT doc_id, '/size', 'maximum' FROM documents WHERE doc_id % 4 > 0 AND n_chars > 5000)"""
_SCORE = "(SELECT p_partkey, 2.0 * (p_size % 7) + 0.5 * (p_size % 5) AS s FROM part)"
_ROUTE = "CASE WHEN s >= 8 THEN 'keep' WHEN s >= 4 THEN 'review' ELSE 'drop' END"
_DECISIONS = "(SELECT user_id AS env, event_type AS from_tool, ['view', 'click', 'error', 'purchase', 'other'][event_id % 5 + 1] AS to_tool, CAST(event_id % 6 AS INT) - 1 AS weight, event_id % 3 = 0 AS prerequisite FROM events)"
ORACLE_SQL = {
    "string_formats": "SELECT o_orderkey, " + ", ".join(f"{valid} AS {n.replace('-', '_')}" for n, (_, valid) in _SAMPLES.items()) + " FROM orders",
    "nested_violations": f"SELECT doc_id, path, rule FROM {_VIOLATIONS}",
    "first_violations": f"SELECT d.doc_id, v.path, v.rule FROM documents d LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY path, rule) AS k FROM {_VIOLATIONS}) v ON v.doc_id = d.doc_id AND v.k = 1",
    "format_constraint_issues": "SELECT o_orderkey, 'ip' AS field, 'format' AS rule FROM orders WHERE o_orderkey % 400 > 255 UNION ALL SELECT o_orderkey, 'n', 'multiple_of' FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT o_orderkey, 'c', 'const' FROM orders WHERE o_orderstatus <> 'O'",
    "url_path_and_unit_values": """SELECT o_orderkey, ['immutable_repository', 'mutable_repository', NULL, 'mutable_repository', 'immutable_repository'][o_orderkey % 5 + 1] AS stability, o_orderkey % 8 IN (0, 5, 6) AS is_safe, o_orderkey % 8 IN (5, 6) AS is_cache,
        CASE WHEN o_orderkey % 8 IN (0, 5, 6) THEN 'files' END AS scope, CASE o_orderkey % 8 WHEN 0 THEN 'a/b.txt' WHEN 5 THEN '__pycache__/m.pyc' WHEN 6 THEN 'src/m.pyo' END AS scoped_path,
        CASE o_orderkey % 5 WHEN 0 THEN o_orderkey * 1e9::DOUBLE WHEN 1 THEN 2500.0::DOUBLE WHEN 2 THEN 300.0::DOUBLE END AS hertz FROM orders""",
    "tool_name_mapping": "SELECT p_partkey, replace(replace(replace(replace(p_name, 'red widget', 'gadget'), 'small', 'little'), 'bolt', 'pin'), 'red', 'crimson') AS name FROM part",
    "unresolved_paths": "SELECT p_partkey, '/data1/' || p_brand || '/x' AS paths FROM part",
    "tool_relevance": """
        WITH w AS (SELECT *, string_split(p_name, ' ')[2] AS tool, ['find', 'the', 'red', 'widget', 'or', 'small', 'bolt'] AS q, list_distinct(string_split(lower(p_name || ' ' || p_type), ' ')) AS d FROM part)
        SELECT p_partkey, CAST(CASE WHEN list_contains(q, tool) THEN 108 ELSE 0 END + len(list_intersect(q, d)) AS BIGINT) AS score, CAST(list_sum(list_transform(string_split(p_name, ''), lambda c: unicode(c))) AS BIGINT) AS character_sum FROM w""",
    "file_references": "SELECT DISTINCT o_orderkey, 'f' || r AS path FROM (SELECT o_orderkey, o_custkey % 90 AS r FROM orders UNION SELECT o_orderkey, o_orderkey % 70 FROM orders) WHERE r >= 60",
    "layout_coverage": "SELECT p_partkey, p_type || '/' || p_brand || CASE WHEN p_size < 20 THEN '.json' ELSE '.csv' END AS path FROM part WHERE p_type <> 'ECONOMY' AND NOT (p_type = 'SMALL' AND p_brand LIKE 'Brand#1%' AND p_size >= 20)",
    "verdict_contract": """
        SELECT doc_id, CAST(doc_id % 6 = 0 AS BIGINT) AS unjudged, CAST(doc_id % 6 = 2 AS BIGINT) AS unasked, CAST(doc_id % 6 = 1 AS BIGINT) AS repeated, CAST(doc_id % 10 = 3 AS BIGINT) AS misquoted,
          (doc_id % 7 > 3 OR doc_id % 11 = 0) <> (doc_id % 7 > CASE doc_id % 6 WHEN 0 THEN 1 WHEN 2 THEN 3 ELSE 2 END) AS wrong_outcome FROM documents""",
    "parameter_sources": "SELECT o_orderkey, p AS pointer, n AS sources FROM orders, (VALUES (1, '/a/b', 2), (1, '/d/1', 0), (3, '/a/c', 0)) AS bad(m, p, n) WHERE o_orderkey % 4 = m",
    "tool_allowlists": "SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 'b' ELSE '' END AS missing, CASE c_custkey % 3 WHEN 2 THEN 'x' ELSE '' END AS extra FROM customer WHERE c_custkey % 3 > 0",
    "score_audit": f"SELECT p_partkey, CAST(s + CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS total, CASE WHEN p_partkey % 8 = 0 THEN 'keep' ELSE {_ROUTE} END AS route, CAST(s AS DOUBLE) AS recomputed, {_ROUTE} AS expected_route FROM {_SCORE} WHERE p_partkey % 9 = 0 OR (p_partkey % 8 = 0 AND s < 8)",
    "access_violations": """
        WITH access AS (SELECT ['F', 'O', 'P'][n_nationkey % 3 + 1] || n_nationkey % 9 AS asset, CASE WHEN n_nationkey % 2 = 0 THEN 'read only' END AS reason FROM nation)
        SELECT * FROM (SELECT c.asset, CASE WHEN a.asset IS NULL THEN 'undeclared' ELSE a.reason END AS reason FROM (SELECT DISTINCT o_orderstatus || o_custkey % 9 AS asset FROM orders) c LEFT JOIN access a USING (asset)) WHERE reason IS NOT NULL""",
    "history_consistency": "SELECT o_custkey, count(DISTINCT CASE WHEN o_custkey % 5 = 0 THEN o_orderstatus ELSE 'O' END) AS environments, count(*) - count(DISTINCT o_orderkey % 100) AS repeated_tasks FROM orders GROUP BY o_custkey HAVING environments > 1 OR repeated_tasks > 0",
    "rubric_symmetry": """
        WITH f AS (SELECT DISTINCT l_partkey % 300 AS rubric, l_suppkey % 90 AS tool FROM lineitem WHERE l_linenumber <= 4), b AS (SELECT DISTINCT l_partkey % 300 AS rubric, l_suppkey % 90 AS tool FROM lineitem WHERE l_linenumber >= 3)
        SELECT *, 'forward' AS side FROM (FROM f EXCEPT FROM b) UNION ALL SELECT *, 'backward' FROM (FROM b EXCEPT FROM f)""",
    "graph_decisions": f"""
        WITH t AS (SELECT DISTINCT user_id AS env, event_type AS name FROM events), pairs AS (SELECT a.env, a.name AS from_tool, b.name AS to_tool FROM t a JOIN t b ON a.env = b.env AND a.name <> b.name),
        told AS (SELECT env, from_tool, to_tool, count(*) AS times, min(weight) AS lo, max(weight) AS hi, bool_or(prerequisite) AS needed FROM {_DECISIONS} WHERE from_tool <> to_tool GROUP BY ALL),
        joined AS (SELECT coalesce(p.env, t.env) AS env, coalesce(p.from_tool, t.from_tool) AS from_tool, coalesce(p.to_tool, t.to_tool) AS to_tool, p.env IS NOT NULL AS known, times, lo, hi, needed FROM pairs p FULL JOIN told t ON p.env = t.env AND p.from_tool = t.from_tool AND p.to_tool = t.to_tool)
        SELECT env, from_tool, to_tool, 'not judged' AS issue FROM joined WHERE times IS NULL UNION ALL SELECT env, from_tool, to_tool, 'unknown pair' FROM joined WHERE NOT known UNION ALL SELECT env, from_tool, to_tool, 'judged twice' FROM joined WHERE times > 1
        UNION ALL SELECT env, from_tool, to_tool, 'weight outside 0 to 3' FROM joined WHERE lo < 0 OR hi > 3 UNION ALL SELECT env, from_tool, to_tool, 'prerequisite without edge' FROM joined WHERE needed AND hi <= 0""",
    "graph_edge_contract": """
        WITH told AS (SELECT 't' || l_suppkey % 40 AS from_tool, 't' || l_partkey % 40 AS to_tool, count(*) AS times, min(CAST(l_quantity % 5 AS INT)) AS lo, max(CAST(l_quantity % 5 AS INT)) AS hi FROM lineitem GROUP BY ALL), known AS (SELECT DISTINCT 't' || s_suppkey % 35 AS name FROM supplier)
        SELECT from_tool, to_tool, 'self edge' AS issue FROM told WHERE from_tool = to_tool UNION ALL SELECT from_tool, to_tool, 'told twice' FROM told WHERE times > 1 UNION ALL SELECT from_tool, to_tool, 'weight outside 1 to 3' FROM told WHERE lo < 1 OR hi > 3
        UNION ALL SELECT from_tool, to_tool, 'unknown tool' FROM told WHERE from_tool NOT IN (FROM known) OR to_tool NOT IN (FROM known)""",
    "claimed_classes": """
        WITH items AS (SELECT o_custkey AS grp, o_orderkey AS item FROM orders), broken AS (SELECT DISTINCT grp FROM items WHERE (grp % 4 = 1 AND item % 3 = 0) OR (grp % 4 = 2 AND item % 5 = 0))
        SELECT grp, item FROM items WHERE grp IN (FROM broken) UNION ALL SELECT grp, min(item) FROM items WHERE grp NOT IN (FROM broken) GROUP BY grp, item % 3""",
    "distinct_chains": "SELECT chain, min(user_id) AS user_id FROM (SELECT user_id, array_to_string(list(event_type ORDER BY event_id)[1:3], '>') AS chain FROM events GROUP BY user_id) GROUP BY chain",
    "url_registry": """
        WITH p AS (SELECT regexp_replace(url, '/[^/]*$', '') AS url, page_id FROM pages), c AS (SELECT DISTINCT 'https://cited.example/' || o_orderkey % 20 AS url FROM orders WHERE o_orderkey % 3 > 0)
        SELECT url, min(page_id) AS page_id, 'registered' AS origin FROM p GROUP BY url UNION ALL SELECT url, NULL, 'cited' FROM c WHERE url NOT IN (SELECT url FROM p)""",
}
