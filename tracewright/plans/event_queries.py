"""Joins, ranks and frames over events, orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import matching, ranking
from tracewright.session import table

_RULES = [("blog", "*://blog.*"), ("blog_org", "*://blog.*.org*"), ("shop", "*://shop.*"), ("any_org", "*.org*"), ("page", "*/*")]


def latest_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.first_per_group(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").asc()])
    return found.select("user_id", "event_type", "event_id", "value")


def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("batch", F.col("event_id") % 7)
    return ranking.first_per_group(events, ["user_id"], [F.col("batch").desc(), F.col("event_id").desc()]).select("user_id", "batch", "event_id")


def topk_per_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_per_group(table(spark, sf_dir, "documents"), ["lang"], [F.col("n_chars").asc(), F.col("doc_id").asc()], 5).select("lang", "place", "doc_id", "n_chars")


def popularity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.dense_place(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name"), F.col("p_size"), [F.lower("p_name"), F.col("p_partkey")])


def trailing_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = ranking.trailing("user_id", ["ts", "event_id"], 20)
    bad = (F.col("event_type") == "error").cast("int")
    return table(spark, sf_dir, "events").select("event_id", F.sum(bad).over(frame).alias("errors"), F.count("*").over(frame).alias("seen"))


def call_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.within_budget(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], 40).select("user_id", "event_id", "call", "allowed")


def breaker_running_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("event_id") % 13))
    found = ranking.running_distinct(events, "user_id", "error", ["ts", "event_id"])
    return found.select("event_id", "distinct_so_far", (F.col("distinct_so_far") >= 5).alias("open"))


def request_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.segments(table(spark, sf_dir, "events"), F.col("event_type") == "signup", "user_id", ["ts", "event_id"])
    return found.groupBy("user_id", "segment").agg(F.count("*").alias("n"), F.min("event_id").alias("least_id"), F.count_if(F.col("event_type") == "click").alias("clicks"))


def forward_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    found = matching.next_of_kind(events, F.col("event_type") == "purchase", "event_id", "user_id", ["ts", "event_id"], "next_purchase")
    return found.where("event_type = 'error'").select("event_id", "next_purchase")


def next_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    signups = table(spark, sf_dir, "events").where("event_type = 'signup'")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return signups.select("user_id", "event_id", F.lead("event_id").over(order).alias("next_id"), (F.lag("event_id").over(order) > F.col("event_id")).alias("goes_back"))


def multiset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("item", F.expr("l_orderkey * 1000000 + l_partkey * 10 + l_linenumber"))
    items = items.groupBy("item").agg(F.min("l_suppkey").alias("supp"), F.min("l_returnflag").alias("flag"))
    calls = items.where("flag = 'R'").select("item", "supp")
    return matching.multiset_match(calls, items.where("flag = 'A'"), ["supp"], "item", "item").select("item", "matched")


def multiset_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return matching.multiset_excess(orders.where("o_orderkey % 3 > 0").select("o_custkey", "o_orderstatus"), orders.where("o_orderkey % 3 = 0").select("o_custkey", "o_orderstatus"))


def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return matching.positional_join(events.where("event_type = 'view'"), events.where("event_type = 'click'"), "user_id", "event_id", "event_id")


def set_equality_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("group", F.expr("user_id * 10 + event_id % 5"))
    left, right = events.where("user_id % 2 = 0"), events.where("user_id % 2 = 1")
    sets = lambda df: matching.member_sets(df, "group", "event_type").groupBy(F.array_join("members", ",").alias("members")).agg(F.count("*").alias("n"), F.min("group").alias("least"))
    return sets(left).select("members", F.col("n").alias("left_n"), F.col("least").alias("left_least")).join(sets(right).select("members", F.col("n").alias("right_n"), F.col("least").alias("right_least")), "members")


def prefix_alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.prefix_aliases(table(spark, sf_dir, "part"), "p_name", 8)


def glob_rule_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", matching.most_specific_rule(pages, "url", _RULES).alias("rule"))


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call may take a parameter from the last view of the same user that ended before it began."""
    events = table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("event_type") == "view", "source").when(F.col("event_type") == "purchase", "call")).where("kind IS NOT NULL")
    from pyspark.sql import Window

    before = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("source", F.last(F.when(F.col("kind") == "source", F.col("event_id")), ignorenulls=True).over(before))
    return found.where("kind = 'call'").select("event_id", "source")


QUERIES = {f.__name__: f for f in (latest_by_user, last_write_wins, topk_per_feature, popularity_rank, trailing_health, call_budget, breaker_running_distinct, request_windows, forward_asof, next_boundary, multiset_match, multiset_containment, positional_join, set_equality_join, prefix_alias_join, glob_rule_join, interval_join)}

_W = "PARTITION BY user_id ORDER BY ts, event_id"
_ITEMS = "items AS (SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS item, min(l_suppkey) AS supp, min(l_returnflag) AS flag FROM lineitem GROUP BY 1)"
_SETS = "SELECT members, count(*) AS n, min(g) AS least FROM (SELECT user_id * 10 + event_id % 5 AS g, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS members FROM events WHERE user_id % 2 = {k} GROUP BY 1) GROUP BY members"

ORACLE_SQL = {
    "latest_by_user": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1",
    "last_write_wins": "SELECT user_id, event_id % 7 AS batch, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 7 DESC, event_id DESC) = 1",
    "topk_per_feature": "SELECT lang, row_number() OVER w AS place, doc_id, n_chars FROM documents WINDOW w AS (PARTITION BY lang ORDER BY n_chars, doc_id) QUALIFY row_number() OVER w <= 5",
    "popularity_rank": "SELECT p_partkey, p_size, p_name, row_number() OVER (ORDER BY p_size DESC NULLS LAST, lower(p_name), p_partkey) AS place FROM part",
    "trailing_health": f"SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS errors, count(*) OVER w AS seen FROM events WINDOW w AS ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
    "call_budget": f"SELECT user_id, event_id, row_number() OVER ({_W}) AS call, row_number() OVER ({_W}) <= 40 AS allowed FROM events",
    "breaker_running_distinct": f"WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN event_id % 13 END AS error FROM events), f AS (SELECT *, error IS NOT NULL AND row_number() OVER (PARTITION BY user_id, error ORDER BY ts, event_id) = 1 AS fresh FROM e), r AS (SELECT event_id, CAST(sum(CAST(fresh AS INT)) OVER ({_W}) AS BIGINT) AS distinct_so_far FROM f) SELECT event_id, distinct_so_far, distinct_so_far >= 5 AS open FROM r",
    "request_windows": f"WITH s AS (SELECT *, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER ({_W}) AS BIGINT) AS segment FROM events) SELECT user_id, segment, count(*) AS n, min(event_id) AS least_id, count(*) FILTER (event_type = 'click') AS clicks FROM s GROUP BY user_id, segment",
    "forward_asof": f"SELECT event_id, next_purchase FROM (SELECT event_id, event_type, first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_purchase FROM events) WHERE event_type = 'error'",
    "next_boundary": f"SELECT user_id, event_id, lead(event_id) OVER w AS next_id, lag(event_id) OVER w > event_id AS goes_back FROM events WHERE event_type = 'signup' WINDOW w AS ({_W})",
    "multiset_match": f"WITH {_ITEMS}, a AS (SELECT item, supp, row_number() OVER (PARTITION BY supp ORDER BY item) AS k FROM items WHERE flag = 'R'), b AS (SELECT item AS matched, supp, row_number() OVER (PARTITION BY supp ORDER BY item) AS k FROM items WHERE flag = 'A') SELECT item, matched FROM a LEFT JOIN b USING (supp, k)",
    "multiset_containment": "SELECT o_custkey, o_orderstatus, count(*) AS excess FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 > 0 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0) GROUP BY ALL",
    "positional_join": "WITH a AS (SELECT user_id, event_id AS left_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id AS right_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'click') SELECT user_id, place, left_id, right_id FROM a FULL JOIN b USING (user_id, place)",
    "set_equality_join": f"SELECT members, a.n AS left_n, a.least AS left_least, b.n AS right_n, b.least AS right_least FROM ({_SETS.format(k=0)}) a JOIN ({_SETS.format(k=1)}) b USING (members)",
    "prefix_alias_join": "SELECT substr(p_name, 1, 8) AS alias, min(p_name) AS name FROM part GROUP BY 1 HAVING count(DISTINCT p_name) = 1",
    "glob_rule_join": "SELECT page_id, CASE WHEN url GLOB '*://blog.*.org*' THEN 'blog_org' WHEN url GLOB '*://blog.*' THEN 'blog' WHEN url GLOB '*://shop.*' THEN 'shop' WHEN url GLOB '*.org*' THEN 'any_org' WHEN url GLOB '*/*' THEN 'page' END AS rule FROM pages",
    "interval_join": f"SELECT event_id, source FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS source FROM events WHERE event_type IN ('view', 'purchase')) WHERE event_type = 'purchase'",
}
