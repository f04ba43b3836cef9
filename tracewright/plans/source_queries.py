"""Sources that read text and paths: Markdown tables, embedded JSON, listings, previews, discovery; and release manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import shared_dir, table
from tracewright.sources import records, sinks


def markdown_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a document: a heading, a table of three rows with merged cells, text, and a heading behind it."""
    lines = "concat('# ', p_brand, '\n| name | size |\n|---|---|\n| ', p_name, ' | 1 |\n|  | ', p_size, ' |\n| other |  |\ntext\n## last\n| a |\n| - |\n| ', p_type, ' |')"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"posexplode(split({lines}, '\n')) AS (line, value)")
    found = records.markdown_rows(rows, "p_partkey")
    return found.select("p_partkey", "line", "heading", F.array_join("cells", "|").alias("cells"))


def embedded_page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat("html", F.expr("CASE page_id % 3 WHEN 0 THEN concat('<script type=\"x\" id=\"data\">\n{\"page\": ', page_id, '}\n</script>') WHEN 1 THEN '<SCRIPT id=''data''>not json</SCRIPT>' ELSE '' END"))
    return table(spark, sf_dir, "pages").select("page_id", records.embedded_json(html, "data").alias("json"))


def resource_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "part").selectExpr("p_type AS scope", "concat(upper(p_name), '/', p_partkey) AS path", "p_size AS bytes")
    return records.listing(files, "SMALL", "Red", 25, 10)


def resource_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.octet_length("text").cast("long").alias("bytes"), records.preview(F.encode("text", "UTF-8"), 100).alias("preview"))


def latest_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "events").selectExpr("concat('/runs/', event_id, '/verifiers/case', user_id, CASE WHEN event_type = 'view' THEN '/notes.txt' ELSE '/verdict.json' END) AS path", "event_id div 3 AS modified")
    return records.verdict_paths(files)


def verified_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS case", "o_orderkey % 2 = 0 AS canonical", "CASE WHEN o_orderstatus = 'F' THEN 'verifier_pass' ELSE 'verifier_fail' END AS label", "CASE WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'fail' END AS outcome")
    excluded = table(spark, sf_dir, "customer").selectExpr("c_custkey * 3 AS case")
    return records.verified_passes(attempts, excluded).select("case", "label")


def delivery_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "orders").selectExpr("concat('/deliveries/', CASE WHEN o_orderkey % 9 = 0 THEN 'readme' ELSE concat('env_', o_custkey % 60, '/v', o_orderkey % 5) END) AS path")
    found = records.delivery_index(paths, "^/deliveries/(env_[0-9]+)/")
    return found.select("environment", F.array_join("paths", ",").alias("paths"))


def latest_case_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").selectExpr("o_custkey AS environment", "concat('run', lpad(o_orderkey, 9, '0')) AS run", "o_orderstatus <> 'P' AS complete", "array(concat('a', o_orderkey), concat('b', o_orderkey)) AS tasks")
    return records.latest_cases(runs)


def newest_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "events").selectExpr("concat('/b/', user_id, '/step_', event_id % 500, CASE WHEN event_id % 10 = 0 THEN '.tmp' ELSE '.json' END) AS path")
    return records.newest_checkpoints(files, r"/b/([0-9]+)/step_([0-9]+)\.json$")


def release_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release of conversations published to the shared folder in one step, told by its manifest as read back."""
    turns = table(spark, sf_dir, "conversations")
    outputs = {"main": turns, "strict": turns.where("role <> 'system'"), "audit": turns.where("length(text) > 200")}
    told = sinks.published(outputs, f"{shared_dir(spark).rstrip('/')}/release-{uuid.uuid4().hex}", ["conv_id", "turn", "role"], {"version": 1})
    return told.select("output", "rows", "digest")


QUERIES = {f.__name__: f for f in (markdown_table_rows, embedded_page_json, resource_listing, resource_previews, latest_verdicts, verified_passes, delivery_index, latest_case_tasks, newest_checkpoints, release_manifest)}

_DIGEST = "CAST(sum(CAST(('0x' || substr(sha256(concat_ws(chr(31), conv_id, turn, role)), 1, 15)) AS BIGINT)) AS VARCHAR)"
_OUTPUTS = {"main": "TRUE", "strict": "role <> 'system'", "audit": "length(text) > 200"}
ORACLE_SQL = {
    "markdown_table_rows": """
        SELECT p_partkey, CAST(v.line AS INT) AS line, CASE WHEN v.line < 8 THEN p_brand ELSE 'last' END AS heading, CASE v.line WHEN 3 THEN p_name || '|1' WHEN 4 THEN p_name || '|' || p_size WHEN 5 THEN 'other|' || p_size ELSE p_type END AS cells
        FROM part, (VALUES (3), (4), (5), (10)) AS v(line)""",
    "embedded_page_json": """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{"page": ' || page_id || '}' END AS json FROM pages""",
    "resource_listing": "SELECT p_type AS scope, upper(p_name) || '/' || p_partkey AS path, p_size AS bytes FROM part WHERE p_type = 'SMALL' AND contains(lower(p_name || '/' || p_partkey), 'red') ORDER BY path LIMIT 25 OFFSET 10",
    "resource_previews": """
        WITH c AS (SELECT doc_id, text, strlen(text) AS bytes, range(0, least(101, length(text) + 1)) AS cuts FROM documents)
        SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, left(text, CAST(list_max(list_filter(cuts, lambda k: strlen(left(text, CAST(k AS BIGINT))) <= 100)) AS BIGINT)) AS preview FROM c""",
    "latest_verdicts": """
        WITH f AS (SELECT 'case' || user_id AS "case", '/runs/' || event_id || '/verifiers/case' || user_id || '/verdict.json' AS path, event_id // 3 AS modified FROM events WHERE event_type <> 'view')
        SELECT "case", path, modified FROM f QUALIFY row_number() OVER (PARTITION BY "case" ORDER BY modified DESC, path) = 1""",
    "verified_passes": """SELECT o_orderkey AS "case", 'verifier_pass' AS label FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT c_custkey * 3 FROM customer)""",
    "delivery_index": "SELECT 'env_' || o_custkey % 60 AS environment, string_agg(DISTINCT '/deliveries/env_' || o_custkey % 60 || '/v' || o_orderkey % 5, ',' ORDER BY '/deliveries/env_' || o_custkey % 60 || '/v' || o_orderkey % 5) AS paths FROM orders WHERE o_orderkey % 9 > 0 GROUP BY 1",
    "latest_case_tasks": """
        WITH l AS (SELECT o_custkey AS environment, max(o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
        SELECT environment, 'run' || lpad(CAST(k AS VARCHAR), 9, '0') AS run, unnest(['a' || k, 'b' || k]) AS task FROM l""",
    "newest_checkpoints": "SELECT CAST(user_id AS VARCHAR) AS bundle, CAST(max(event_id % 500) AS BIGINT) AS step, '/b/' || user_id || '/step_' || max(event_id % 500) || '.json' AS path FROM events WHERE event_id % 10 > 0 GROUP BY user_id",
    "release_manifest": " UNION ALL ".join(f"SELECT '{n}' AS output, count(*) AS rows, {_DIGEST} AS digest FROM conversations WHERE {w}" for n, w in _OUTPUTS.items()),
}
