"""States of record sets and files over orders, parts and documents: manifests, differences, replays, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import states
from tracewright.session import table

# rows of two states of the orders: assets by status, digests of what a row holds
_BEFORE = ["o_orderstatus AS asset", "o_orderkey AS id", "md5(concat(o_orderpriority, o_custkey)) AS digest"]
_AFTER = ["CASE WHEN o_orderkey % 40 = 0 THEN 'X' ELSE o_orderstatus END AS asset", "o_orderkey AS id", "md5(concat(CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE o_orderpriority END, o_custkey)) AS digest"]
_RUNS = "SELECT c_custkey % 50 AS case_, 'run' || c_nationkey % 3 AS run, CASE WHEN c_custkey % 4 = 0 AND c_nationkey % 3 = 1 THEN 'x' ELSE 'same' END AS digest, c_mktsegment AS component FROM customer"


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(*_BEFORE), orders.where("o_orderkey % 13 <> 5").selectExpr(*_AFTER)


def state_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _states(spark, sf_dir)
    both = a.withColumn("state", F.lit("before")).unionByName(b.withColumn("state", F.lit("after")))
    return states.state_manifest(both, ["state"], "asset", "digest")


def state_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.digest_of_digests(state_manifests(spark, sf_dir), ["state"], "asset")


def ordered_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "md5(text) AS digest")
    return states.ordered_digest(rows, ["conv_id"], "turn", "digest", chunk=3)


def composite_state_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _states(spark, sf_dir)
    declared = spark.createDataFrame([("F",), ("O",), ("P",)], "asset string")
    return states.changed_assets(states.state_diff(a, b, "asset", "id", "digest"), declared, "asset")


def replay_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey % 50 AS case_", "concat('run', c_nationkey % 3) AS run", "CASE WHEN c_custkey % 4 = 0 AND c_nationkey % 3 = 1 THEN 'x' ELSE 'same' END AS digest", "c_mktsegment AS component")
    return states.replay_stability(rows, "case_", "run", "component", "digest")


def first_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    flat = lambda *pairs: "inline(array(" + ", ".join(f"named_struct('pointer', {p}, 'value', {v})" for p, v in pairs) + "))"
    left = part.selectExpr("p_partkey", flat(("'/a'", "p_name"), ("'/b'", "p_brand"), ("'/c'", "p_type")))
    right = part.selectExpr("p_partkey", flat(("'/a'", "CASE WHEN p_size % 5 = 0 THEN 'other' ELSE p_name END"), ("CASE WHEN p_size % 7 = 0 THEN '/d' ELSE '/b' END", "p_brand"), ("'/c'", "CASE WHEN p_size % 3 > 0 THEN p_type END")))
    return states.first_difference(left, right, ["p_partkey"])


def receipt_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").where("doc_id % 10 <> 3").selectExpr("concat('f/', doc_id) AS path", "sha2(text, 256) AS sha256")
    receipts = table(spark, sf_dir, "documents").where("doc_id % 10 <> 4").selectExpr("concat('f/', doc_id) AS path", "CASE WHEN doc_id % 10 = 5 THEN sha2(source, 256) ELSE sha2(text, 256) END AS sha256")
    return states.receipt_integrity(files, receipts)


def priority_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = table(spark, sf_dir, "customer").selectExpr("c_custkey % 400 AS path", "'ledger' AS origin").distinct()
    receipts = table(spark, sf_dir, "orders").selectExpr("o_custkey % 700 AS path", "'receipt' AS origin").distinct()
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey % 900 AS path", "'scan' AS origin").distinct()
    return states.union_by_priority([ledger, receipts, parts], ["path"])


def presence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = table(spark, sf_dir, "part").selectExpr("concat(p_name, p_size % 4) AS symbol")
    index = table(spark, sf_dir, "part").selectExpr("concat(p_name, p_size % 3 + 2) AS symbol")
    return states.presence_audit(selected, index, "symbol")


def evidence_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    seeds = orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("retained"))
    reviews = orders.where("o_custkey % 3 > 0").groupBy("o_custkey").agg(F.collect_set(F.expr("CASE WHEN o_orderkey % 11 = 0 THEN 'Z' ELSE o_orderstatus END")).alias("evidence"))
    return states.evidence_subset(reviews, seeds, "o_custkey")


def multiset_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 500 AS run", "l_suppkey % 4 AS tool", "l_linenumber", "l_partkey")
    return states.same_multisets(lines.where("NOT (run % 3 = 1 AND l_partkey % 50 = 0)").select("run", "tool"), lines.where("NOT (run % 3 = 2 AND l_partkey % 60 = 0)").select("run", "tool"), "run")


def alias_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    bindings = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS binding", "concat('d', s_suppkey % 70) AS dir", "CASE WHEN s_suppkey % 4 > 0 THEN concat('d', s_suppkey % 90) END AS declared")
    cases = table(spark, sf_dir, "customer").selectExpr("concat('d', c_custkey % 120) AS name")
    return states.alias_join(bindings, cases, ["dir", "declared"], "name")


def cited_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS case_", "l_linenumber AS call_id", "concat('t', l_suppkey % 5) AS tool", "l_suppkey % 5 <> 4 AS allowed").dropDuplicates(["case_", "call_id"])
    one = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_"), F.col("l_linenumber").alias("call_id")).agg(F.min("l_suppkey").alias("s"))
    calls = one.selectExpr("case_", "call_id", "concat('t', s % 5) AS tool", "s % 5 <> 4 AS allowed")
    citations = lines.selectExpr("case_", "CASE WHEN case_ % 10 = 0 THEN call_id + 50 ELSE call_id END AS call_id").where("call_id % 3 > 0")
    required = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS case_", "explode(array('t0', 't1')) AS tool").where("case_ % 4 = 0")
    return states.cited_calls(citations, calls, required, "case_")


def numbered_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return states.numbered(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


def container_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, element_at(array('.zip', '.XLSX', '.json', '.ipynb'), cast(p_partkey % 4 + 1 AS int))) AS path", "md5(p_name) AS digest")
    return files.select("p_partkey", states.comparable_digest(F.col("path"), F.col("digest"), (".zip", ".xlsx", ".ipynb")).alias("digest"))


QUERIES = {f.__name__: f for f in (state_manifests, state_digests, ordered_digests, composite_state_diff, replay_stability, first_differences, receipt_integrity, priority_union, presence_audit, evidence_subsets, multiset_equality, alias_bindings, cited_calls, numbered_duplicates, container_digests)}

_A = f"(SELECT {', '.join(_BEFORE)} FROM orders)"
_B = f"(SELECT {', '.join(_AFTER)} FROM orders WHERE o_orderkey % 13 <> 5)"
_HEX = "CAST('0x' || substr(digest, {0}, 8) AS BIGINT)"
_MANIFEST = f"(SELECT state, asset, count(*) AS n, sha256(concat_ws(':', count(*), sum({_HEX.format(1)}), sum({_HEX.format(9)}))) AS digest FROM (SELECT 'before' AS state, * FROM {_A} UNION ALL SELECT 'after', * FROM {_B}) GROUP BY state, asset)"
ORACLE_SQL = {
    "state_manifests": f"SELECT * FROM {_MANIFEST}",
    "state_digests": f"SELECT state, count(*) AS assets, sha256(string_agg(asset || '=' || digest, chr(10) ORDER BY asset || '=' || digest)) AS digest FROM {_MANIFEST} GROUP BY state",
    "ordered_digests": "SELECT conv_id, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(d, ',' ORDER BY run)) AS digest FROM (SELECT conv_id, turn // 3 AS run, count(*) AS n, sha256(string_agg(md5(text), ',' ORDER BY turn)) AS d FROM conversations GROUP BY ALL) GROUP BY conv_id",
    "composite_state_diff": f"""
        WITH d AS (SELECT coalesce(a.asset, b.asset) AS asset, a.id IS NULL AS i, b.id IS NULL AS d, a.digest <> b.digest AS u FROM {_A} a FULL JOIN {_B} b ON a.asset = b.asset AND a.id = b.id)
        SELECT asset, count(*) FILTER (i) AS inserted, count(*) FILTER (u) AS updated, count(*) FILTER (d) AS deleted, asset IN ('F', 'O', 'P') AS declared FROM d WHERE i OR d OR u GROUP BY asset""",
    "replay_stability": f"""
        WITH r AS ({_RUNS}), t AS (SELECT case_, count(DISTINCT run) AS of_runs FROM r GROUP BY case_)
        SELECT case_, component, count(DISTINCT run) AS runs, count(DISTINCT digest) AS kinds, count(DISTINCT digest) = 1 AND count(DISTINCT run) = min(of_runs) AS stable FROM r JOIN t USING (case_) GROUP BY case_, component""",
    "first_differences": """
        SELECT p_partkey, d.pointer, d.a, d.b FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN {'pointer': '/a', 'a': p_name, 'b': 'other'} WHEN p_size % 7 = 0 THEN {'pointer': '/b', 'a': p_brand, 'b': NULL} WHEN p_size % 3 = 0 THEN {'pointer': '/c', 'a': p_type, 'b': NULL} END AS d FROM part) WHERE d IS NOT NULL""",
    "receipt_integrity": "SELECT 'f/' || doc_id AS path, CASE doc_id % 10 WHEN 3 THEN 'no file' WHEN 4 THEN 'no receipt' WHEN 5 THEN 'mismatch' ELSE 'ok' END AS status FROM documents",
    "priority_union": """
        WITH l AS (SELECT DISTINCT c_custkey % 400 AS path FROM customer), r AS (SELECT DISTINCT o_custkey % 700 AS path FROM orders), s AS (SELECT DISTINCT p_partkey % 900 AS path FROM part)
        SELECT path, 'ledger' AS origin FROM l UNION ALL SELECT path, 'receipt' FROM r WHERE path NOT IN (FROM l) UNION ALL SELECT path, 'scan' FROM s WHERE path NOT IN (FROM l) AND path NOT IN (FROM r)""",
    "presence_audit": """
        WITH s AS (SELECT DISTINCT p_name || p_size % 4 AS symbol FROM part), i AS (SELECT DISTINCT p_name || (p_size % 3 + 2) AS symbol FROM part)
        SELECT coalesce(s.symbol, i.symbol) AS symbol, CASE WHEN i.symbol IS NULL THEN 'missing' WHEN s.symbol IS NULL THEN 'unselected' ELSE 'present' END AS state FROM s FULL JOIN i ON s.symbol = i.symbol""",
    "evidence_subsets": "SELECT o_custkey, o_custkey % 3 > 0 AS reviewed, CAST(o_custkey % 3 > 0 AND bool_or(o_orderkey % 11 = 0) AS BIGINT) AS foreign_evidence FROM orders GROUP BY o_custkey",
    "multiset_equality": """
        WITH l AS (SELECT l_orderkey % 500 AS run, l_suppkey % 4 AS tool, l_partkey FROM lineitem), c AS (SELECT run, tool, count(*) FILTER (NOT (run % 3 = 1 AND l_partkey % 50 = 0)) - count(*) FILTER (NOT (run % 3 = 2 AND l_partkey % 60 = 0)) AS n FROM l GROUP BY ALL)
        SELECT run, CAST(sum(greatest(n, 0)) AS BIGINT) AS only_a, CAST(sum(greatest(-n, 0)) AS BIGINT) AS only_b FROM c GROUP BY run""",
    "alias_bindings": """
        WITH b AS (SELECT s_suppkey AS binding, 'd' || s_suppkey % 70 AS name FROM supplier UNION SELECT s_suppkey, 'd' || s_suppkey % 90 FROM supplier WHERE s_suppkey % 4 > 0), c AS (SELECT DISTINCT 'd' || c_custkey % 120 AS name FROM customer)
        SELECT name, CASE WHEN count(binding) = 1 THEN min(binding) END AS binding, count(binding) AS n FROM c LEFT JOIN b USING (name) GROUP BY name""",
    "cited_calls": """
        WITH one AS (SELECT l_orderkey AS case_, l_linenumber AS call_id, min(l_suppkey) % 5 AS s FROM lineitem GROUP BY ALL),
        cites AS (SELECT case_, call_id FROM (SELECT case_, CASE WHEN case_ % 10 = 0 THEN call_id + 50 ELSE call_id END AS call_id FROM one) WHERE call_id % 3 > 0),
        joined AS (SELECT c.case_, o.s FROM cites c LEFT JOIN one o ON o.case_ = c.case_ AND o.call_id = c.call_id),
        cited AS (SELECT case_, count(*) FILTER (s IS NULL) AS unknown, count(*) FILTER (s = 4) AS forbidden FROM joined GROUP BY case_),
        open_ AS (SELECT case_, count(*) AS uncovered FROM (SELECT o_orderkey AS case_, unnest([0, 1]) AS s FROM orders WHERE o_orderkey % 4 = 0) r WHERE NOT EXISTS (SELECT 1 FROM joined j WHERE j.case_ = r.case_ AND j.s = r.s) GROUP BY case_)
        SELECT coalesce(c.case_, o.case_) AS case_, coalesce(unknown, 0) AS unknown, coalesce(forbidden, 0) AS forbidden, coalesce(uncovered, 0) AS uncovered FROM cited c FULL JOIN open_ o ON c.case_ = o.case_""",
    "numbered_duplicates": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS INT) AS ordinal FROM lineitem",
    "container_digests": "SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN md5(p_name) END AS digest FROM part",
}
