"""Record sets: pages, lookups, mutations, keys, references, differences, constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import constraints, diff, keys, records
from tracewright.session import table


def record_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.page(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"}, "o_totalprice", ["o_orderkey"], descending=True, limit=50, offset=20)
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


def record_get_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.get(table(spark, sf_dir, "customer"), {"c_custkey": 7}, ["c_custkey"])


def record_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    row = spark.createDataFrame([(1_000_000_007, "Customer#new", 3, 12.5, "BUILDING")], customer.schema)
    return records.create(customer, row, ["c_custkey"])


def record_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.update(table(spark, sf_dir, "customer"), {"c_custkey": 7}, {"c_name": "renamed", "c_acctbal": -1.5}, ["c_custkey"])


def record_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return records.delete(region, {"r_regionkey": 2}, ["r_regionkey"], [(nation.where("n_regionkey <> 2"), ["n_regionkey"])])


def record_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def reference_left_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.reference_counts(table(spark, sf_dir, "orders"), ["o_custkey"], table(spark, sf_dir, "customer").where("c_acctbal > 0"), ["c_custkey"])


def reference_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.missing_references(table(spark, sf_dir, "lineitem"), ["l_partkey"], table(spark, sf_dir, "part").where("p_size < 40"), ["p_partkey"])


def key_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = (("customer", ["c_custkey"]), ("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("part", ["p_partkey"]))
    frames = [keys.key_report(table(spark, sf_dir, name), name, own) for name, own in sets]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def _changed_orders(orders: DataFrame) -> DataFrame:
    kept = orders.where("o_orderkey % 50 <> 0")
    touched = kept.withColumns({"o_orderstatus": F.when(F.expr("o_orderkey % 33 = 0"), "X").otherwise(F.col("o_orderstatus")), "o_custkey": F.when(F.expr("o_orderkey % 44 = 0"), F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))})
    fresh = orders.where("o_orderkey % 70 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    return touched.unionByName(fresh)


_ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
_CHANGED_SQL = """
after AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 44 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 33 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 50 <> 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 70 = 0)"""


def state_diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(_ORDER_FIELDS)
    return diff.row_changes(orders, _changed_orders(orders), ["o_orderkey"])


def state_diff_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(_ORDER_FIELDS)
    changes = diff.field_changes(orders, _changed_orders(orders), ["o_orderkey"])
    return changes.withColumn("changed_fields", F.array_join("changed_fields", ","))


def keyless_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    after = items.where("l_returnflag <> 'R'").unionByName(items.where("l_orderkey % 100 = 1"))
    return diff.keyless_changes(items, after)


def file_manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"))
    after = files.where("hash(path) IS NOT NULL AND NOT path LIKE '%7'").withColumn("sha256", F.when(F.col("path").like("%3"), F.sha2("path", 256)).otherwise(F.col("sha256")))
    after = after.unionByName(files.where("path LIKE '%99'").select(F.concat(F.lit("new/"), "path").alias("path"), "sha256"))
    return diff.path_changes(files, after)


def table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [diff.table_digest(table(spark, sf_dir, t)).withColumn("name", F.lit(t)) for t in ("nation", "region", "labels")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


_PART_FIELDS = {
    "p_name": constraints.Field("string", min_length=10, pattern="^[a-z ]+$"),
    "p_size": constraints.Field("integer", minimum=3, maximum=45),
    "p_retailprice": constraints.Field("number", maximum=1500),
    "p_brand": constraints.Field("string", enum=("Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#22", "Brand#23")),
}


def row_constraint_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.row_issues(table(spark, sf_dir, "part"), ["p_partkey"], _PART_FIELDS)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    columns = ["c_custkey", "c_nationkey", "c_mktsegment"]
    long = customer.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))).alias("_e")).select("_e.*")
    return long.groupBy("field").agg(F.count("value").alias("n"), F.count_distinct("value").alias("n_distinct"), F.min("value").alias("least"), F.max("value").alias("most"))


QUERIES = {f.__name__: f for f in (record_list_page, record_get_by_key, record_create, record_update, record_delete, record_duplicate_keys, reference_left_counts, reference_missing, key_constraint_report, state_diff_rows, state_diff_fields, keyless_diff, file_manifest_diff, table_digest, row_constraint_issues, column_profile)}

_DIGEST = "SELECT '{t}' AS name, count(*) AS n, CAST(coalesce(sum(CAST(('0x' || substr(md5({row}), 1, 15)) AS BIGINT)), 0) AS VARCHAR) AS digest FROM {t}"


def _row(columns: list[str]) -> str:
    return " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns)


ORACLE_SQL = {
    "record_list_page": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 20",
    "record_get_by_key": "SELECT * FROM customer WHERE c_custkey = 7",
    "record_create": "SELECT * FROM customer UNION ALL SELECT 1000000007, 'Customer#new', 3, 12.5, 'BUILDING'",
    "record_update": "SELECT c_custkey, CASE WHEN c_custkey = 7 THEN 'renamed' ELSE c_name END AS c_name, c_nationkey, CASE WHEN c_custkey = 7 THEN -1.5 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
    "record_delete": "SELECT * FROM region WHERE r_regionkey <> 2",
    "record_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "reference_left_counts": "SELECT count(*) FILTER (c.c_custkey IS NOT NULL) AS matched, count(*) FILTER (o.o_custkey IS NOT NULL AND c.c_custkey IS NULL) AS missing, 0::BIGINT AS partly_null, count(*) FILTER (o.o_custkey IS NULL) AS all_null FROM orders o LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey",
    "reference_missing": "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) GROUP BY l_partkey",
    "key_constraint_report": " UNION ALL ".join(f"SELECT '{t}' AS label, count(*) AS n_rows, count(DISTINCT ({k})) AS distinct_keys, 0::BIGINT AS null_keys, count(*) = count(DISTINCT ({k})) AS is_key FROM {t}" for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey, l_linenumber"), ("part", "p_partkey"))),
    "state_diff_rows": f"WITH {_CHANGED_SQL} SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'inserted' WHEN a.o_orderkey IS NULL THEN 'deleted' ELSE 'updated' END AS change FROM orders b FULL JOIN after a ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR (a.o_custkey, a.o_orderstatus, a.o_orderpriority) IS DISTINCT FROM (b.o_custkey, b.o_orderstatus, b.o_orderpriority)",
    "state_diff_fields": f"WITH {_CHANGED_SQL} SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'inserted' WHEN a.o_orderkey IS NULL THEN 'deleted' ELSE 'updated' END AS change, CASE WHEN a.o_orderkey IS NULL OR b.o_orderkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.o_custkey IS DISTINCT FROM b.o_custkey THEN 'o_custkey' END, CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END) END AS changed_fields FROM orders b FULL JOIN after a ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR (a.o_custkey, a.o_orderstatus) IS DISTINCT FROM (b.o_custkey, b.o_orderstatus)",
    "keyless_diff": "WITH a AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM (SELECT * FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 100 = 1) GROUP BY ALL) SELECT a.l_orderkey, a.l_linenumber, a.l_returnflag, a.n AS n_before, coalesce(b.n, 0) AS n_after FROM a LEFT JOIN b USING (l_orderkey, l_linenumber, l_returnflag) WHERE a.n <> coalesce(b.n, 0)",
    "file_manifest_diff": "WITH f AS (SELECT source || '/' || doc_id AS path FROM documents), x AS (SELECT path FROM f WHERE path LIKE '%99') SELECT path, CASE WHEN path LIKE '%7' THEN 'deleted' ELSE 'modified' END AS change FROM f WHERE path LIKE '%7' OR path LIKE '%3' UNION ALL SELECT 'new/' || path, 'created' FROM x",
    "table_digest": " UNION ALL ".join(_DIGEST.format(t=t, row=_row(c)) for t, c in (("nation", ["n_nationkey", "n_name", "n_regionkey"]), ("region", ["r_regionkey", "r_name"]), ("labels", ["doc_id", "quality", "toxic"]))),
    "row_constraint_issues": " UNION ALL ".join(
        f"SELECT p_partkey, '{f}' AS field, '{r}' AS rule FROM part WHERE {c}"
        for f, r, c in (
            ("p_name", "min_length", "length(p_name) < 10"),
            ("p_name", "pattern", "NOT regexp_matches(p_name, '^[a-z ]+$')"),
            ("p_size", "minimum", "p_size < 3"),
            ("p_size", "maximum", "p_size > 45"),
            ("p_retailprice", "maximum", "p_retailprice > 1500"),
            ("p_brand", "enum", "p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21', 'Brand#22', 'Brand#23')"),
            *((f, "null", f"{f} IS NULL") for f in ("p_name", "p_size", "p_retailprice", "p_brand")),
        )
    ),
    "column_profile": " UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS n, count(DISTINCT {c}) AS n_distinct, min(CAST({c} AS VARCHAR)) AS least, max(CAST({c} AS VARCHAR)) AS most FROM customer" for c in ("c_custkey", "c_nationkey", "c_mktsegment")),
}
