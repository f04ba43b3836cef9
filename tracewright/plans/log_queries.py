"""Event logs: compactions, stitched answers, stops, controllers, exchanges and totals over events as runs of users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import logs
from tracewright.session import table

# what stands for log fields: expressions that Spark and DuckDB read alike
_COMPACTION = ["CASE event_type WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'cancelled' WHEN 'view' THEN 'applied' ELSE 'other' END AS kind", "CASE WHEN event_id % 3 > 0 THEN event_id * 7 END AS tokens"]
_PRELUDE = ["CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'output' WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'blank' WHEN event_type = 'signup' THEN 'comment' ELSE 'created' END AS kind"]
_REQUEST = ["event_id % 6 AS request_id", "1 + event_id % 3 AS attempts", "event_type = 'error' AND event_id % 2 = 0 AS failed"]
_USAGE = ["CASE WHEN user_id % 5 = 0 AND event_type = 'view' THEN 'other' WHEN event_type = 'view' THEN 'usage' WHEN event_type = 'signup' THEN 'total' WHEN event_type = 'click' THEN 'answer' WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'ended' ELSE 'other' END AS kind", "event_id % 100 AS tokens", "CASE WHEN event_id % 4 = 0 THEN ' ' ELSE event_type || event_id END AS text"]
_STEP = ["event_id % 7 AS turn", "event_id % 3 AS step", "CASE WHEN event_type = 'error' THEN 'compaction' ELSE 'agent_step' END AS kind", "event_id AS request_id"]


def _log(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id AS run", "event_id AS line", *columns)


def _from(columns: list[str]) -> str:
    return f"(SELECT user_id AS run, event_id AS line, {', '.join(columns)} FROM events)"


def log_compactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.compactions(_log(spark, sf_dir, _COMPACTION))


def stitched_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four conversation turns each stand for a request and its resumptions."""
    turns = table(spark, sf_dir, "conversations").selectExpr("conv_id * 100 + turn div 4 AS run", "turn AS line", "substring(text, 1, 12) AS text", "role")
    before = turns.withColumn("parts", F.collect_list("text").over(logs._up_to("run", "line", -1)))
    resumed = before.selectExpr("run", "line", "line div 4 AS turn", "CASE WHEN run % 3 = 1 AND size(parts) = 2 THEN 'lost' ELSE array_join(parts, '') END AS prefix", "text", "run % 5 > 0 AS ok")
    return logs.stitched_answers(resumed)


def prelude_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.prelude_decisions(_log(spark, sf_dir, _PRELUDE), ["created"])


def first_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"errors": (F.col("event_type") == "error", 14), "calls": (F.col("event_type") == "click", 15), "spent": (F.col("value") > 50, 24), "upstream": (F.expr("event_type = 'error' AND event_id % 50 = 0"), 0)}
    return logs.first_stops(_log(spark, sf_dir, ["event_id", "event_type", "value"]), limits)


def bounded_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.dispatched(_log(spark, sf_dir, ["event_type"]), F.col("event_type") == "error", 4, 10)
    return rows.select("run", "line", "dispatched")


def concurrency_controller(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log(spark, sf_dir, ["CAST(event_type = 'error' AND event_id % 3 = 0 AND user_id % 2 = 0 AS BIGINT) AS errors"])
    return logs.controlled(rows, start=16, stable=10)


def request_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log(spark, sf_dir, ["event_type", "event_id % 9 AS request_id"])
    responses = rows.where("event_type <> 'view'").withColumn("status", F.expr("CASE WHEN event_type = 'error' THEN 500 ELSE 200 END"))
    return logs.with_last_response(rows.where("event_type = 'view'").select("run", "request_id", F.col("line").alias("asked")), responses, ["run", "request_id"])


def usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.usage_summary(_log(spark, sf_dir, _USAGE))


def transport_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.transport_summary(_log(spark, sf_dir, _REQUEST))


def initial_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.initial_requests(_log(spark, sf_dir, ["(event_id * 7919) % 1009 AS request_id"]))


def step_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.step_requests(_log(spark, sf_dir, _STEP), ["run", "turn", "step"])


def fallback_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _log(spark, sf_dir, ["event_id % 13 AS turn"])
    steps = requests.where("turn < 6").groupBy("run", "turn").agg(F.min("line").alias("step_no")).unionByName(requests.groupBy("run").agg(F.lit(20).cast("long").alias("turn"), F.max("line").alias("step_no")))
    return logs.fallback_steps(requests, steps, "run", ["turn"])


QUERIES = {f.__name__: f for f in (log_compactions, stitched_answers, prelude_decisions, first_stops, bounded_dispatch, concurrency_controller, request_responses, usage_summary, transport_summary, initial_requests, step_requests, fallback_steps)}

_RUN_BY_LINE = "OVER (PARTITION BY run ORDER BY line)"
ORACLE_SQL = {
    "log_compactions": f"""
        WITH numbered AS (SELECT *, count(*) FILTER (kind = 'started') {_RUN_BY_LINE} - 1 AS compaction FROM {_from(_COMPACTION)}),
        ends AS (SELECT run, compaction, min(line) AS ended_line FROM numbered WHERE kind IN ('completed', 'cancelled') GROUP BY ALL)
        SELECT n.run, n.compaction, min(n.line) AS started_line, min(e.ended_line) AS ended_line,
          coalesce(min(n.kind) FILTER (n.line = e.ended_line), 'started') AS status,
          arg_max(n.tokens, n.line) FILTER (n.kind = 'applied' OR n.line = e.ended_line) AS tokens, count(*) FILTER (n.kind = 'applied') AS n_applied
        FROM numbered n LEFT JOIN ends e USING (run, compaction) WHERE n.compaction >= 0 GROUP BY n.run, n.compaction""",
    "stitched_answers": """
        WITH turns AS (SELECT conv_id * 100 + turn // 4 AS run, turn AS line, substring(text, 1, 12) AS text FROM conversations),
        resumed AS (SELECT run, line, text, CASE WHEN run % 3 = 1 AND row_number() OVER w = 3 THEN 'lost' ELSE coalesce(string_agg(text, '') OVER (PARTITION BY run ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS prefix, run % 5 > 0 AS ok, row_number() OVER w AS k, count(*) OVER (PARTITION BY run) AS n FROM turns WINDOW w AS (PARTITION BY run ORDER BY line)),
        judged AS (SELECT run, arg_max(prefix, line) AS prefix, arg_max(text, line) AS text, max(n) AS n, bool_and(ok) AS ok FROM resumed GROUP BY run)
        SELECT run, CASE WHEN joined THEN prefix || text ELSE text END AS answer, CAST(CASE WHEN joined THEN n - 1 ELSE 0 END AS BIGINT) AS joined
        FROM (SELECT *, n > 1 AND ok AND NOT (run % 3 = 1 AND n >= 3) AND prefix <> text AS joined FROM judged)""",
    "prelude_decisions": f"""
        WITH rows_ AS (SELECT *, count(*) FILTER (kind = 'error') {_RUN_BY_LINE} AS errors FROM {_from(_PRELUDE)} WHERE kind <> 'comment'),
        found AS (SELECT run, min(line) FILTER (kind = 'output') AS first_line, min(line) FILTER (kind = 'blank' AND errors > 0) AS failed, max(errors) AS errors FROM rows_ GROUP BY run)
        SELECT run, CASE WHEN first_line IS NOT NULL AND (failed IS NULL OR first_line < failed) THEN 'through' WHEN errors > 0 THEN 'error' ELSE 'incomplete' END AS decision,
          CASE WHEN first_line IS NOT NULL AND (failed IS NULL OR first_line < failed) THEN first_line ELSE failed END AS line FROM found""",
    "first_stops": """
        WITH counted AS (SELECT user_id AS run, event_id AS line, count(*) FILTER (event_type = 'error') OVER w AS e, count(*) FILTER (event_type = 'click') OVER w AS c, count(*) FILTER (value > 50) OVER w AS s, count(*) FILTER (event_type = 'error' AND event_id % 50 = 0) OVER w AS u
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
        ends AS (SELECT run, min(line) FILTER (e > 14) AS e, min(line) FILTER (c > 15) AS c, min(line) FILTER (s > 24) AS s, min(line) FILTER (u > 0) AS u FROM counted GROUP BY run)
        SELECT run, least(e, c, s, u) AS stop_line, CASE least(e, c, s, u) WHEN e THEN 'errors' WHEN c THEN 'calls' WHEN s THEN 'spent' WHEN u THEN 'upstream' END AS stop_reason FROM ends""",
    "bounded_dispatch": "SELECT user_id AS run, event_id AS line, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 4 PRECEDING) <= 10 AS dispatched FROM events",
    "concurrency_controller": """
        WITH RECURSIVE rows_ AS (SELECT user_id AS run, event_id AS line, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k,
          sum(CAST(event_type = 'error' AND event_id % 3 = 0 AND user_id % 2 = 0 AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS errors FROM events),
        states AS (SELECT run, 0 AS k, CAST(0 AS BIGINT) AS line, CAST(16 AS BIGINT) AS workers, CAST(0 AS BIGINT) AS since FROM (SELECT DISTINCT run FROM rows_)
          UNION ALL SELECT s.run, r.k, r.line,
            CASE WHEN r.errors >= 3 THEN greatest(4, s.workers // 2) WHEN r.errors = 0 AND s.workers < 64 AND s.since + 1 >= 10 THEN least(64, s.workers + least(25, greatest(5, s.workers // 2))) ELSE s.workers END,
            CASE WHEN r.errors >= 3 OR (r.errors = 0 AND s.workers < 64 AND s.since + 1 >= 10) THEN 0 ELSE s.since + 1 END
          FROM states s JOIN rows_ r ON r.run = s.run AND r.k = s.k + 1)
        SELECT run, line, workers FROM states WHERE k > 0""",
    "request_responses": """
        WITH rows_ AS (SELECT user_id AS run, event_id AS line, event_id % 9 AS request_id, event_type FROM events),
        last AS (SELECT run, request_id, arg_max(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, line) AS status, count(*) AS responses FROM rows_ WHERE event_type <> 'view' GROUP BY ALL)
        SELECT r.run, r.request_id, r.line AS asked, l.status, coalesce(l.responses, 0) AS responses FROM rows_ r LEFT JOIN last l USING (run, request_id) WHERE r.event_type = 'view'""",
    "usage_summary": f"SELECT run, CAST(coalesce(sum(tokens) FILTER (kind = 'usage'), arg_max(tokens, line) FILTER (kind = 'total'), 0) AS BIGINT) AS tokens, arg_max(text, line) FILTER (kind = 'answer' AND trim(text) <> '') AS answer, coalesce(arg_max(text, line) FILTER (kind = 'ended'), 'failed') AS reason FROM {_from(_USAGE)} GROUP BY run",
    "transport_summary": f"SELECT run, count(*) AS requests, count(DISTINCT request_id) FILTER (failed) AS failed_ids, CAST(sum(attempts - 1) AS BIGINT) AS retries FROM {_from(_REQUEST)} GROUP BY run",
    "initial_requests": f"SELECT run, min(request_id) AS least_id, arg_min(request_id, line) AS first_logged, arg_max(request_id, line) AS last_logged FROM {_from(['(event_id * 7919) % 1009 AS request_id'])} GROUP BY run",
    "step_requests": f"SELECT run, turn, step, max(request_id) AS request_id, count(*) AS attempts FROM {_from(_STEP)} WHERE kind = 'agent_step' GROUP BY ALL",
    "fallback_steps": """
        WITH requests AS (SELECT user_id AS run, event_id AS line, event_id % 13 AS turn FROM events),
        steps AS (SELECT run, turn, min(line) AS step_no FROM requests WHERE turn < 6 GROUP BY ALL UNION ALL SELECT run, 20, max(line) FROM requests GROUP BY run),
        named AS (SELECT r.run, r.line, s.step_no FROM requests r LEFT JOIN steps s USING (run, turn)),
        free AS (SELECT run, step_no, row_number() OVER (PARTITION BY run ORDER BY step_no) AS place FROM steps WHERE turn = 20),
        rest AS (SELECT run, line, row_number() OVER (PARTITION BY run ORDER BY line) AS place FROM named WHERE step_no IS NULL)
        SELECT run, line, step_no FROM named WHERE step_no IS NOT NULL UNION ALL SELECT r.run, r.line, f.step_no FROM rest r LEFT JOIN free f USING (run, place)""",
}
