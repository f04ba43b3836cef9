"""Conversations: messages, integrity, context windows, releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import releases, traces
from tracewright.session import table


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def conversation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: context windows of conversations, a new one from each user turn that follows an assistant's."""
    windows = traces.context_windows(_turns(spark, sf_dir), F.col("role") == "user")
    return traces.window_audit(windows)


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = traces.messages(_turns(spark, sf_dir))
    text = F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["turn"].cast("string"), m["role"], F.coalesce(m["text"], F.lit("-")))), "\n")
    return found.select("conv_id", F.size("messages").cast("long").alias("n"), F.sha2(text, 256).alias("messages_sha256"))


def conversation_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir)
    broken = turns.where("NOT (conv_id % 10 = 3 AND turn = 1)").withColumn("role", F.when(F.expr("conv_id % 10 = 4 AND turn = 0"), "robot").otherwise(F.col("role")))
    return traces.conversation_flags(broken)


def call_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type IN ('view', 'click')")
    rows = events.select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("pos"), F.when(F.col("event_type") == "view", "call").otherwise("result").alias("kind"), F.expr("event_id % 11").alias("call_id"), F.expr("event_id % 17 <> 0").alias("defined"))
    return traces.call_issues(rows, "conv_id")


def event_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = traces.fold_events(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "view")
    return steps.groupBy("user_id", "step").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("event_id").alias("last_id"))


def strict_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    flags = F.array_compact(F.array(F.when(F.col("quality") == 0, "low_quality"), F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("n_chars") < 100, "short")))
    strict, rest = releases.split(docs.select("doc_id", "quality", "toxic", "n_chars"), flags)
    return strict.select("doc_id", F.lit("").alias("flags")).unionByName(rest.select("doc_id", F.array_join("quality_flags", ",").alias("flags")))


def release_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    base = releases.merged([docs.where("doc_id % 4 = 0"), docs.where("doc_id % 4 = 1"), docs.where("doc_id % 4 >= 2")], "doc_id")
    fresh = docs.where("doc_id % 4 = 2 AND doc_id % 3 = 0").withColumn("lang", F.lit("zz"))
    return releases.replaced(base, fresh, "doc_id")


def release_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    found = docs.unionByName(docs.where("doc_id % 5 = 3").withColumn("n_chars", F.lit(-1).cast("long")))
    return releases.appended(docs.where("doc_id % 5 < 2"), found, "doc_id", [F.col("n_chars").asc()])


def release_merge_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``release_merge`` with parts that make up the whole table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    base = releases.merged([docs.where(f"doc_id % 4 = {k}") for k in range(4)], "doc_id")
    return releases.replaced(base, docs.where("doc_id % 4 = 2 AND doc_id % 3 = 0").withColumn("lang", F.lit("zz")), "doc_id")


def release_append_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``release_append`` with all documents found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    found = docs.unionByName(docs.where("doc_id % 5 = 3").withColumn("n_chars", F.lit(-1).cast("long")))
    return releases.appended(docs.where("doc_id % 5 < 2"), found, "doc_id", [F.col("n_chars").asc()])


def release_preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    after = docs.where("doc_id % 9 <> 4").withColumn("digest", F.when(F.expr("doc_id % 9 = 5"), F.sha2("digest", 256)).otherwise(F.col("digest")))
    return releases.preserved(docs, after, "doc_id", "digest")


QUERIES = {f.__name__: f for f in (conversation_windows, conversation_messages, conversation_integrity, call_integrity, event_fold, strict_split, release_merge, release_append, release_merge_whole, release_append_whole, release_preserved)}

ORACLE_SQL = {
    "conversation_windows": "WITH w AS (SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS segment FROM conversations) SELECT conv_id, segment, count(*) AS n_messages, count(*) FILTER (role = 'assistant') AS n_assistant, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars, min(turn) AS first_turn, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM w GROUP BY conv_id, segment",
    "conversation_messages": "SELECT conv_id, count(*) AS n, sha256(string_agg(turn || ':' || role || ':' || coalesce(nullif(trim(text), ''), '-'), chr(10) ORDER BY turn)) AS messages_sha256 FROM conversations GROUP BY conv_id",
    "conversation_integrity": "WITH b AS (SELECT conv_id, turn, CASE WHEN conv_id % 10 = 4 AND turn = 0 THEN 'robot' ELSE role END AS role FROM conversations WHERE NOT (conv_id % 10 = 3 AND turn = 1)) SELECT conv_id, count(*) AS n, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS gapless, count(*) FILTER (role NOT IN ('system', 'user', 'assistant', 'tool')) AS unknown_roles, count(*) FILTER (role = 'assistant') AS n_assistant, arg_max(role, turn) AS last_role FROM b GROUP BY conv_id",
    "call_integrity": "WITH r AS (SELECT user_id AS conv_id, event_id % 11 AS call_id, event_type = 'view' AS c, event_id AS pos, event_id % 17 <> 0 AS defined FROM events WHERE event_type IN ('view', 'click')), g AS (SELECT conv_id, call_id, count(*) FILTER (c) AS calls, count(*) FILTER (NOT c) AS results, min(pos) FILTER (c) AS called, min(pos) FILTER (NOT c) AS answered, count(*) FILTER (c AND NOT defined) AS bad FROM r GROUP BY conv_id, call_id)"
    + " UNION ALL ".join(f" SELECT conv_id, call_id, '{n}' AS issue FROM g WHERE {c}" for n, c in (("duplicate call", "calls > 1"), ("result without call", "calls = 0"), ("undefined tool", "bad > 0"), ("unresolved", "results = 0"), ("duplicate result", "results > 1"), ("result before call", "answered < called"))),
    "event_fold": "WITH s AS (SELECT *, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS step FROM events) SELECT user_id, step, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, max(event_id) AS last_id FROM s GROUP BY user_id, step",
    "strict_split": "SELECT doc_id, concat_ws(',', CASE WHEN quality = 0 THEN 'low_quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 100 THEN 'short' END) AS flags FROM documents LEFT JOIN labels USING (doc_id)",
    "release_merge": "SELECT doc_id, CASE WHEN doc_id % 4 = 2 AND doc_id % 3 = 0 THEN 'zz' ELSE lang END AS lang, n_chars FROM documents",
    "release_append": "SELECT doc_id, lang, CASE WHEN doc_id % 5 = 3 THEN -1 ELSE n_chars END AS n_chars FROM documents",
    "release_merge_whole": "SELECT doc_id, CASE WHEN doc_id % 4 = 2 AND doc_id % 3 = 0 THEN 'zz' ELSE lang END AS lang, n_chars FROM documents",
    "release_append_whole": "SELECT doc_id, lang, CASE WHEN doc_id % 5 = 3 THEN -1 ELSE n_chars END AS n_chars FROM documents",
    "release_preserved": "SELECT doc_id, CASE WHEN doc_id % 9 = 4 THEN 'removed' ELSE 'modified' END AS issue FROM documents WHERE doc_id % 9 IN (4, 5)",
}
