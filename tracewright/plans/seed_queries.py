"""Seeds, themes and migrations of entries made of parts, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import seeds
from tracewright.session import dealt, table

SITE, SOURCE, MOST = "https://catalogue/", "cat", 3

#: A part's entry: up to seven tools, of which every fourth has no description; all tell their use where the size is even.
_ENTRY = """to_json(named_struct('qualifiedName', CASE WHEN p_partkey % 50 = 0 THEN '' ELSE concat(p_brand, '/', p_name) END, 'description', concat('a ', p_type), 'displayName', CASE WHEN p_size % 3 = 0 THEN p_name END, 'useCount', p_size, 'homeSite', p_brand,
    'tools', transform(slice(sequence(1, 7), 1, p_size % 8), k -> named_struct('name', concat('t', k), 'description', CASE WHEN k % 4 = 0 THEN ' ' ELSE 'does' END, 'useCount', CASE WHEN p_size % 2 = 0 OR k > 1 THEN p_partkey * k % 5 END, 'inputSchema', named_struct('properties', named_struct('a', k)))),
    'toolNames', array(p_brand, 'x')))"""
_OLD = """to_json(named_struct('environment', named_struct('basic_info', named_struct('url', concat('u', p_partkey))), 'init_ref_tools', transform(sequence(1, p_size % 4 + 1), k -> named_struct('name', concat('t', k), 'description', p_type, 'inputSchema', named_struct('properties', named_struct('a', k)), 'tag', p_size)),
    'others', named_struct('tool_count', 3, 'brand', p_brand)))"""


def _parts(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "part"), "p_partkey").selectExpr("p_partkey", "p_size", f"parse_json({text}) AS v")


def catalogue_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each entry's seed, or why there is none."""
    found = seeds.seeds_of_entries(_parts(spark, sf_dir, _ENTRY), "p_partkey", "v", "p_size", SOURCE, SITE, MOST)
    names = F.array_join(F.transform("tools", lambda t: F.concat(t["name"], F.to_json(t["input"]), F.to_json(t["output"]))), ",")
    return found.select("p_partkey", "reason", "global_id", F.array_join("url", ",").alias("url"), "description", names.alias("tools"), F.to_json("metadata").alias("metadata"), "received", "invalid", "removed", "rule")


def catalogue_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seeds.themes_of_entries(_parts(spark, sf_dir, _ENTRY), "p_partkey", "v", SITE)
    return found.select("p_partkey", "label", "url", "description", F.array_join("operations", ",").alias("operations"), F.to_json("metadata").alias("metadata"))


def migrated_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seeds.migrated_seeds(_parts(spark, sf_dir, _OLD), "p_partkey", "v")
    names = F.array_join(F.transform("tools", lambda t: F.concat(t["name"], F.to_json(t["input"]), F.to_json(t["rest"]))), ",")
    return found.select("p_partkey", "schema_version", F.array_join("url", ",").alias("url"), names.alias("tools"), "n_tools", F.to_json("others").alias("others"))


def seed_set_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What orders, taken for a set of seeds with their lines as tools, share or tell wrongly."""
    tools = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("name"))).alias("tools"))
    orders = table(spark, sf_dir, "orders").join(tools, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey")
    rows = orders.select("o_orderkey", F.concat(F.lit("cat_"), F.lower(F.substring("o_orderpriority", 1, 1)), F.lit("_"), F.when(key % 9 == 0, key - key % 2).otherwise(key)).alias("global_id"), F.substring("o_orderpriority", 1, 1).alias("name"), F.when(key % 11 == 0, key - 1).otherwise(key).alias("index"), "tools", (key % 7).cast("int").alias("n_tools"))
    return seeds.seed_set_issues(rows, "o_orderkey", SOURCE)


QUERIES = {f.__name__: f for f in (catalogue_seeds, catalogue_themes, migrated_seeds, seed_set_issues)}

_SOUND = "[k FOR k IN range(1, p_size % 8 + 1) IF k % 4 <> 0]"
_TOLD = f"(p_size % 2 = 0 OR NOT list_contains({_SOUND}, 1))"
_PICKED = f"CASE WHEN len({_SOUND}) > {MOST} AND {_TOLD} THEN list_transform(list_sort(list_transform({_SOUND}, lambda k: [-(p_partkey * k % 5), k])), lambda x: x[2])[1:{MOST}] ELSE {_SOUND}[1:{MOST}] END"
_SEEDS = "(SELECT o_orderkey, 'cat_' || left(o_orderpriority, 1) || '_' || CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey - o_orderkey % 2 ELSE o_orderkey END AS global_id, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS i, left(o_orderpriority, 1) AS name, CAST(o_orderkey % 7 AS INT) AS n_tools FROM orders)"
ORACLE_SQL = {
    "catalogue_seeds": f"""
        SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'no name or description' END AS reason, CASE WHEN p_partkey % 50 > 0 THEN columns(* EXCLUDE p_partkey) END FROM (
            SELECT p_partkey, 'cat_' || lower(trim(regexp_replace(p_brand || '/' || p_name, '[^0-9a-zA-Z]+', '_', 'g'), '_')) || '_' || p_size AS global_id, '{SITE}' || p_brand || '/' || p_name AS url, 'a ' || p_type AS description,
                array_to_string(list_transform({_PICKED}, lambda k: 't' || k || '{{"a":' || k || '}}' || '{{}}'), ',') AS tools,
                '{{' || CASE WHEN p_size % 3 = 0 THEN '"display_name":"' || p_name || '",' ELSE '' END || '"home_site":"' || p_brand || '","tool_names":["' || p_brand || '","x"],"use_count":' || p_size || '}}' AS metadata,
                CAST(p_size % 8 AS INT) AS received, CAST(p_size % 8 - len({_SOUND}) AS INT) AS invalid, CAST(greatest(len({_SOUND}) - {MOST}, 0) AS INT) AS removed, CASE WHEN len({_SOUND}) <= {MOST} THEN 'all' WHEN {_TOLD} THEN 'useCount' ELSE 'source_order' END AS rule FROM part)""",
    "catalogue_themes": f"""
        SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name ELSE name END AS label, '{SITE}' || name AS url, 'a ' || p_type AS description, CASE WHEN p_size % 8 = 0 THEN p_brand || ',x' ELSE array_to_string(list_transform(range(1, p_size % 8 + 1), lambda k: 't' || k), ',') END AS operations,
            '{{' || CASE WHEN name <> '' THEN '"qualifiedName":"' || name || '",' ELSE '' END || '"useCount":' || p_size || '}}' AS metadata FROM (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_brand || '/' || p_name END AS name FROM part)""",
    "migrated_seeds": """SELECT p_partkey, '1.1' AS schema_version, 'u' || p_partkey AS url, array_to_string(list_transform(range(1, p_size % 4 + 2), lambda k: 't' || k || '{"a":' || k || '}{"tag":' || p_size || '}'), ',') AS tools, CAST(p_size % 4 + 1 AS INT) AS n_tools, '{"brand":"' || p_brand || '"}' AS others FROM part""",
    "seed_set_issues": f"""
        WITH s AS (FROM {_SEEDS}), t AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT o_orderkey, 'shared global_id' AS issue, global_id AS detail FROM s QUALIFY count(*) OVER (PARTITION BY global_id) > 1
        UNION ALL (SELECT o_orderkey, 'shared index', CAST(i AS VARCHAR) FROM s QUALIFY count(*) OVER (PARTITION BY i) > 1)
        UNION ALL SELECT o_orderkey, 'id does not follow', 'cat_' || name || '_' || i FROM s WHERE global_id <> 'cat_' || name || '_' || i
        UNION ALL SELECT l_orderkey, 'repeated tools', string_agg(l_returnflag, ',' ORDER BY l_returnflag) FROM t SEMI JOIN orders ON o_orderkey = l_orderkey WHERE n > 1 GROUP BY l_orderkey
        UNION ALL SELECT o_orderkey, 'wrong count', CAST(n_tools AS VARCHAR) FROM s LEFT JOIN (SELECT l_orderkey, sum(n) AS n FROM t GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE n_tools <> coalesce(n, 0)""",
}
