"""Queries over nested values, requirements, counters and fuzzy names, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import json_schema
from tracewright.operators import coverage, fuzzy, trees
from tracewright.session import dealt, table

#: A contract of order records with references, alternatives and closed objects.
ORDER_SCHEMA = {
    "$defs": {"line": {"type": "object", "required": ["part", "quantity"], "properties": {"part": {"type": "integer"}, "quantity": {"type": "number", "maximum": 45}, "flag": {"enum": ["A", "N", "R"]}}, "additionalProperties": False}},
    "type": "object",
    "properties": {
        "status": {"enum": ["F", "O"]},
        "price": {"type": "number", "exclusiveMinimum": 0, "maximum": 190000},
        "day": {"type": "string", "format": "date"},
        "payment": {"oneOf": [{"type": "object", "required": ["card"]}, {"type": "object", "required": ["account"]}]},
        "lines": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/line"}},
        "note": {"type": "string", "nullable": True},
    },
    "required": ["customer"],
}


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of every order with its lines; some lack members or hold what the contract bars.

    The number of partitions is told, as few bytes are much work here and would be merged into one task.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice").repartition(n, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), F.when(F.col("l_linenumber") == 7, F.lit("x")).alias("extra"), F.col("l_extendedprice").alias("w")))).alias("lines"))
    lines = lines.select("l_orderkey", F.transform("lines", lambda x: F.struct(x["part"].alias("part"), x["quantity"].alias("quantity"), x["extra"].alias("extra"))).alias("lines"))
    orders = table(spark, sf_dir, "orders").repartition(n, "o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    payment = F.struct(F.when(F.col("o_orderkey") % 3 != 1, "c").alias("card"), F.when(F.col("o_orderkey") % 3 != 2, "a").alias("account"))
    record = F.struct(F.when(F.col("o_custkey") % 10 > 0, F.col("o_custkey")).alias("customer"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), payment.alias("payment"), "lines")
    return orders.select("o_orderkey", F.to_json(record).alias("json"))


def schema_first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first error of each order record against a contract, if it has one."""
    first = json_schema.first_error(F.col("v"), ORDER_SCHEMA)
    return _order_records(spark, sf_dir).select("o_orderkey", F.parse_json("json").alias("v")).select("o_orderkey", first.alias("e")).select("o_orderkey", "e.path", "e.rule")


def schema_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often order records break each rule of the contract, lines' numbers aside."""
    errors = _order_records(spark, sf_dir).select(F.parse_json("json").alias("v")).select(F.explode(json_schema.schema_errors(F.col("v"), ORDER_SCHEMA)).alias("e"))
    return errors.groupBy(F.regexp_replace("e.path", "/[0-9]+", "/*").alias("path"), F.col("e.rule").alias("rule")).agg(F.count("*").alias("n"))


def tree_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of each part's record."""
    text = "concat('{\"id\":', p_partkey, ',\"a/b\":[\"', p_brand, '\",{\"size\":', p_size, '}],\"none\":{}', CASE WHEN p_partkey % 3 = 0 THEN ',\"t\":[[null]]' ELSE '' END, '}')"
    return trees.tree_nodes(table(spark, sf_dir, "part").selectExpr("p_partkey", f"parse_json({text}) AS v"), "p_partkey", "v")


_SCHEMAS = "concat('{\"type\":\"object\",\"properties\":{\"', p_brand, '\":{\"type\":\"array\",\"items\":{\"type\":\"integer\"}},\"s\":{\"oneOf\":[{\"type\":\"null\"},{\"maximum\":', p_size, '}]}}', CASE WHEN p_partkey % 2 = 0 THEN ',\"additionalProperties\":{\"type\":\"string\"}' ELSE '' END, '}')"


def schema_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subschema of each part's schema."""
    return trees.schema_nodes(table(spark, sf_dir, "part").selectExpr("p_partkey", f"parse_json({_SCHEMAS}) AS v"), "p_partkey", "v")


def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat paths of what each part's tool gives on success."""
    data = "concat('{\"properties\":{\"count\":{},\"items\":{\"type\":\"array\",\"items\":{\"properties\":{\"', p_name, '\":{\"properties\":{\"x\":{}}},\"id\":{}}}}}}')"
    text = f"concat('{{\"oneOf\":[{{\"properties\":{{\"success\":{{\"const\":false}},\"data\":{{}}}}}},{{\"properties\":{{\"success\":{{\"const\":', CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE '1' END, '}},\"data\":', {data}, '}}}}]}}')"
    paths = trees.flat_paths(trees.success_data(F.col("v")))
    return dealt(table(spark, sf_dir, "part"), "p_partkey").selectExpr("p_partkey", f"parse_json({text}) AS v").select("p_partkey", F.array_join(paths, ",").alias("paths"))


def _required(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    served = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").join(customers, F.col("o_custkey") == F.col("c_custkey")).where("c_acctbal > 6000")
    return customers.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")), served.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))


def capability_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation whether urgent orders of well-off customers were filled in all segments that it has."""
    return coverage.divided(*_required(spark, sf_dir), "nation", "segment")


def readiness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first issues of nations: segments not served, suppliers below a floor, no customers."""
    required, provided = _required(spark, sf_dir)
    gaps = coverage.uncovered(required, provided, "nation", "segment").select(F.concat_ws(":", F.lpad(F.col("nation").cast("string"), 2, "0"), "segment").alias("subject"))
    suppliers = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    low = coverage.below_floor(suppliers, ["n_name"], F.col("s_acctbal") > 5000, F.lit(3)).select(F.col("n_name").alias("subject"))
    return coverage.readiness({"suppliers below floor": low, "segment not served": gaps}, "subject")


PATTERNS = {"digits": "[0-9]+", "bars": "[|]+", "ats": "@", "never": "☃"}


def scrub_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of what would be replaced in documents, summed by source."""
    docs = table(spark, sf_dir, "documents").select("source", coverage.replacement_counts(F.col("text"), PATTERNS).alias("counts"))
    return coverage.counter_totals(docs, ["source"], "counts")


def similar_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy duplicates among hosts of pages and names of parts."""
    hosts = table(spark, sf_dir, "pages").select(F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#:]*)", 1)).alias("name"))
    return fuzzy.similar_names(hosts.unionAll(table(spark, sf_dir, "part").select(F.lower("p_name"))), "name").withColumn("ratio", F.round("ratio", 9))


QUERIES = {f.__name__: f for f in (schema_first_errors, schema_error_counts, tree_pointers, schema_pointers, output_paths, capability_coverage, readiness_report, scrub_counters, similar_hosts)}

_LINES = "(SELECT l_orderkey, l_quantity, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, CASE WHEN l_linenumber = 7 THEN 'x' END NULLS FIRST, l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"
_ERRORS = f"""(
    SELECT o_orderkey, 1 AS member, 0 AS k, '/status' AS path, 'enum' AS rule FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT o_orderkey, 2, 0, '/price', 'exclusiveMinimum' FROM orders WHERE o_totalprice <= 0 UNION ALL SELECT o_orderkey, 2, 1, '/price', 'maximum' FROM orders WHERE o_totalprice > 190000
    UNION ALL SELECT o_orderkey, 4, 0, '/payment', 'oneOf' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT DISTINCT l_orderkey, 5, -1, '/lines', 'minItems' FROM {_LINES} WHERE n < 2
    UNION ALL SELECT l_orderkey, 5, 3 * k, '/lines/' || k || '/quantity', 'maximum' FROM {_LINES} WHERE l_quantity > 45
    UNION ALL SELECT l_orderkey, 5, 3 * k + 1, '/lines/' || k, 'additionalProperties' FROM {_LINES} WHERE l_linenumber = 7
    UNION ALL SELECT o_orderkey, 6, 0, '', 'required' FROM orders WHERE o_custkey % 10 = 0)"""
_NEED = "(SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS segment FROM customer)"
_HAVE = "(SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND c_acctbal > 6000)"
ORACLE_SQL = {
    "schema_first_errors": f"SELECT o.o_orderkey, e.path, e.rule FROM orders o LEFT JOIN (SELECT * FROM {_ERRORS} QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY member, k) = 1) e USING (o_orderkey)",
    "schema_error_counts": f"SELECT regexp_replace(path, '/[0-9]+', '/*') AS path, rule, count(*) AS n FROM {_ERRORS} JOIN orders USING (o_orderkey) GROUP BY ALL",
    "tree_pointers": """
        SELECT p_partkey, unnest([
          {'pointer': '', 'depth': 0, 'kind': 'object', 'value': NULL}, {'pointer': '/id', 'depth': 1, 'kind': 'scalar', 'value': CAST(p_partkey AS VARCHAR)}, {'pointer': '/a~1b', 'depth': 1, 'kind': 'array', 'value': NULL},
          {'pointer': '/a~1b/0', 'depth': 2, 'kind': 'scalar', 'value': '"' || p_brand || '"'}, {'pointer': '/a~1b/1', 'depth': 2, 'kind': 'object', 'value': NULL}, {'pointer': '/a~1b/1/size', 'depth': 3, 'kind': 'scalar', 'value': CAST(p_size AS VARCHAR)}, {'pointer': '/none', 'depth': 1, 'kind': 'object', 'value': NULL}], recursive := true) FROM part
        UNION ALL SELECT p_partkey, unnest([{'pointer': '/t', 'depth': 1, 'kind': 'array', 'value': NULL}, {'pointer': '/t/0', 'depth': 2, 'kind': 'array', 'value': NULL}, {'pointer': '/t/0/0', 'depth': 3, 'kind': 'scalar', 'value': 'null'}], recursive := true) FROM part WHERE p_partkey % 3 = 0""",
    "schema_pointers": """
        SELECT p_partkey, unnest([
          {'pointer': '', 'depth': 0, 'type': 'object'}, {'pointer': '/properties/' || p_brand, 'depth': 1, 'type': 'array'}, {'pointer': '/properties/' || p_brand || '/items', 'depth': 2, 'type': 'integer'},
          {'pointer': '/properties/s', 'depth': 1, 'type': NULL}, {'pointer': '/properties/s/oneOf/0', 'depth': 2, 'type': 'null'}, {'pointer': '/properties/s/oneOf/1', 'depth': 2, 'type': NULL}], recursive := true) FROM part
        UNION ALL SELECT p_partkey, '/additionalProperties', 1, 'string' FROM part WHERE p_partkey % 2 = 0""",
    "output_paths": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'count,' || array_to_string(list_sort(['items[].' || p_name || '.x', 'items[].id']), ',') ELSE '' END AS paths FROM part",
    "capability_coverage": f"SELECT n.nation, count(*) AS required, count(*) FILTER (h.nation IS NULL) AS missing, count(*) FILTER (h.nation IS NULL) = 0 AS complete FROM {_NEED} n LEFT JOIN {_HAVE} h USING (nation, segment) GROUP BY n.nation",
    "readiness_report": f"""
        WITH low AS (SELECT n_name FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_name HAVING count(*) FILTER (s_acctbal > 5000) < 3),
        gaps AS (SELECT lpad(CAST(nation AS VARCHAR), 2, '0') || ':' || segment AS subject FROM (FROM {_NEED} EXCEPT FROM {_HAVE})),
        every AS (SELECT 0 AS kind, 'suppliers below floor' AS issue, n_name AS subject FROM low UNION ALL SELECT 1, 'segment not served', subject FROM gaps)
        SELECT CAST(row_number() OVER (ORDER BY kind, subject) AS INT) AS place, issue, subject FROM every QUALIFY place <= 32""",
    "scrub_counters": "SELECT source, name, CAST(sum(n) AS BIGINT) AS total, count(*) AS records FROM (SELECT source, unnest(['digits', 'bars', 'ats']) AS name, unnest([len(regexp_extract_all(text, '[0-9]+')), len(regexp_extract_all(text, '[|]+')), len(regexp_extract_all(text, '@'))]) AS n FROM documents) WHERE n > 0 GROUP BY ALL",
}
