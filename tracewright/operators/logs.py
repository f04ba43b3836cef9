"""Runs of logged events in line order: compactions, stitched answers, preludes, stops, controllers and totals.

A run's rows are ordered by ``line``; two rows of one run never share a line. Rows with a null run form one run, rows
with a null line come first, empty logs give empty results, and further columns of the input are not read. Every window is
partitioned by run, so a single run has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _up_to(run: str, line: str, last: int = 0) -> Window:
    return Window.partitionBy(run).orderBy(line).rowsBetween(Window.unboundedPreceding, last)


def compactions(events: DataFrame, run: str = "run", line: str = "line") -> DataFrame:
    """One row per compaction of (run, line, kind, tokens): kinds started, completed, cancelled, applied.

    A start opens a compaction; the first end after it closes it, further ones change nothing; an apply event enriches
    the last one opened. ``tokens`` is the last value that the closing end or an apply event gave.
    """
    rows = events.select(run, line, "kind", "tokens").withColumn("compaction", F.count_if(F.col("kind") == "started").over(_up_to(run, line)) - 1)
    rows = rows.where("compaction >= 0")
    within = Window.partitionBy(run, "compaction").orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.col("kind").isin("completed", "cancelled")
    rows = rows.withColumn("closes", ends & (F.count_if(ends).over(within) == 1))
    tells = (F.col("closes") | (F.col("kind") == "applied")) & F.col("tokens").isNotNull()
    return rows.groupBy(run, "compaction").agg(
        F.min(line).alias("started_line"),
        F.min(F.when(F.col("closes"), F.col(line))).alias("ended_line"),
        F.coalesce(F.min(F.when(F.col("closes"), F.col("kind"))), F.lit("started")).alias("status"),
        F.max_by("tokens", F.when(tells, F.col(line))).alias("tokens"),
        F.count_if(F.col("kind") == "applied").alias("n_applied"),
    )


def stitched_answers(requests: DataFrame, run: str = "run", line: str = "line") -> DataFrame:
    """Per run of (run, line, turn, prefix, text, ok): the final answer with what interrupted responses had sent before.

    ``prefix`` is the text a request resumes from, ``ok`` whether it is an interrupted step that may be resumed. The parts
    join only if each prefix equals the earlier prefix and what came after it, back to one without prefix in the same
    turn; otherwise the last response stands alone.
    """
    order = Window.partitionBy(run).orderBy(line)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = requests.select(run, line, "turn", text("prefix").alias("prefix"), text("text").alias("text"), F.coalesce("ok", F.lit(False)).alias("ok"))
    rows = rows.withColumn("next_prefix", F.lead("prefix").over(order)).withColumn("last_turn", F.last("turn").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    before = F.col("next_prefix").isNotNull()
    rows = rows.withColumn("opens", F.max(F.when(before & (F.col("prefix") == ""), F.col(line))).over(Window.partitionBy(run)))
    follows = F.col("ok") & (F.col("text") != "") & F.col("turn").eqNullSafe(F.col("last_turn")) & (F.col("next_prefix") == F.concat("prefix", "text"))
    in_chain = before & (F.col(line) >= F.col("opens"))
    found = rows.groupBy(run).agg(
        F.max_by(F.struct("prefix", "text"), line).alias("final"),
        F.count_if(in_chain).alias("parts"),
        F.count_if(in_chain & ~follows).alias("broken"),
    )
    joins = (F.col("parts") > 0) & (F.col("broken") == 0) & (F.col("final.prefix") != "") & (F.col("final.text") != "") & (F.col("final.prefix") != F.col("final.text"))
    answer = F.when(joins, F.concat("final.prefix", "final.text")).otherwise(F.col("final.text"))
    return found.select(run, answer.alias("answer"), F.when(joins, F.col("parts")).otherwise(0).alias("joined"))


def prelude_decisions(events: DataFrame, prelude: list[str], run: str = "run", line: str = "line") -> DataFrame:
    """Per run of (run, line, kind) whether its stream is let through, and the line that decides.

    Kinds in ``prelude`` and comments decide nothing; the first other event lets the stream through; an error counts
    once a blank follows it; a stream that ends before either is incomplete, or has the error it ended with.
    """
    rows = events.select(run, line, "kind").where("kind IS NULL OR kind <> 'comment'")
    rows = rows.withColumn("errors", F.count_if(F.col("kind") == "error").over(_up_to(run, line)))
    quiet = F.col("kind").isin("blank", "error", *prelude)
    found = rows.groupBy(run).agg(
        F.min(F.when(~quiet | F.col("kind").isNull(), F.col(line))).alias("first"),
        F.min(F.when((F.col("kind") == "blank") & (F.col("errors") > 0), F.col(line))).alias("failed"),
        F.max("errors").alias("errors"),
    )
    through = F.col("first").isNotNull() & (F.col("failed").isNull() | (F.col("first") < F.col("failed")))
    decision = F.when(through, "through").when(F.col("errors") > 0, "error").otherwise("incomplete")
    return found.select(run, decision.alias("decision"), F.when(through, F.col("first")).otherwise(F.col("failed")).alias("line"))


def first_stops(events: DataFrame, limits: dict[str, tuple[Column, int]], run: str = "run", line: str = "line") -> DataFrame:
    """Per run the earliest line at which one of the limits is passed, and its name (by the order of ``limits``).

    ``limits``: name -> (what counts, how many are allowed).
    """
    counted = events.withColumns({f"count_{k}": F.count_if(what).over(_up_to(run, line)) for k, (what, _) in limits.items()})
    passed = [F.min(F.when(F.col(f"count_{k}") > most, F.col(line))).alias(f"at_{k}") for k, (_, most) in limits.items()]
    found = counted.groupBy(run).agg(*passed)
    at = F.least(*(F.col(f"at_{k}") for k in limits)) if len(limits) > 1 else F.col(f"at_{next(iter(limits))}")
    name = F.coalesce(*(F.when(F.col(f"at_{k}") == at, F.lit(k)) for k in limits))
    return found.select(run, at.alias("stop_line"), name.alias("stop_reason"))


def dispatched(results: DataFrame, failed: Column, concurrency: int, most_errors: int, run: str = "run", line: str = "line") -> DataFrame:
    """Adds ``dispatched``: a task starts once the one ``concurrency`` places before it has ended, unless by then more
    than ``most_errors`` had failed."""
    before = F.count_if(failed).over(_up_to(run, line, -concurrency))
    return results.withColumn("dispatched", before <= most_errors)


def controlled(results: DataFrame, run: str = "run", line: str = "line", start: int = 64, least: int = 4, most: int = 64, recent: int = 20, many: int = 3, stable: int = 50) -> DataFrame:
    """(run, line, workers) after each result of (run, line, errors): a concurrency controller.

    ``many`` errors among the ``recent`` results halve the workers; after ``stable`` results without a change and none of
    the recent ones with an error, half as many (5 to 25) are added.
    """

    def steps(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("line", kind="stable")
        window = group["errors"].fillna(0).rolling(recent, min_periods=1).sum()
        now, since, out = start, 0, []
        for errors in window:
            since += 1
            if errors >= many:
                now, since = max(least, now // 2), 0
            elif errors == 0 and now < most and since >= stable:
                now, since = min(most, now + min(25, max(5, now // 2))), 0
            out.append(now)
        return group.assign(workers=out)[["run", "line", "workers"]]

    rows = results.select(F.col(run).alias("run"), F.col(line).alias("line"), F.col("errors").cast("long").alias("errors"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.groupBy("run").applyInPandas(steps, f"run {kinds['run']}, line {kinds['line']}, workers long")


def with_last_response(requests: DataFrame, responses: DataFrame, keys: list[str], line: str = "line", columns: Iterable[str] = ("status",)) -> DataFrame:
    """Requests with the columns of their last response, null where there is none."""
    columns = list(columns)
    last = responses.groupBy(*keys).agg(F.max_by(F.struct(*columns), line).alias("response"), F.count("*").alias("responses"))
    return requests.join(last, keys, "left").select(*requests.columns, *(F.col(f"response.{c}").alias(c) for c in columns), F.coalesce("responses", F.lit(0)).alias("responses"))


def usage_summary(events: DataFrame, run: str = "run", line: str = "line") -> DataFrame:
    """Per run of (run, line, kind, tokens, text): the sum over usage events, the last non-blank answer, why it ended.

    Where a run has no usage event, the last cumulative count (kind ``total``) stands for the sum.
    """
    kind = F.col("kind")
    answers = (kind == "answer") & (F.trim("text") != "")
    return events.groupBy(run).agg(
        F.coalesce(F.sum(F.when(kind == "usage", F.col("tokens"))), F.max_by("tokens", F.when(kind == "total", F.col(line))), F.lit(0)).cast("long").alias("tokens"),
        F.max_by("text", F.when(answers, F.col(line))).alias("answer"),
        F.coalesce(F.max_by("text", F.when(kind == "ended", F.col(line))), F.lit("failed")).alias("reason"),
    )


def transport_summary(requests: DataFrame, run: str = "run") -> DataFrame:
    """Per run of (run, request_id, attempts, failed): requests, distinct ids that failed in the end, further attempts."""
    return requests.groupBy(run).agg(F.count("*").alias("requests"), F.count_distinct(F.when(F.col("failed"), F.col("request_id"))).alias("failed_ids"), F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))), F.lit(0)).cast("long").alias("retries"))


def initial_requests(requests: DataFrame, run: str = "run", line: str = "line") -> DataFrame:
    """Per run the request of least id and the first one logged: retries can make them differ."""
    return requests.groupBy(run).agg(F.min("request_id").alias("least_id"), F.min_by("request_id", line).alias("first_logged"), F.max_by("request_id", line).alias("last_logged"))


def step_requests(requests: DataFrame, keys: list[str]) -> DataFrame:
    """Per step of (keys, request_id, kind) its last agent request after retries, and how many there were."""
    return requests.where("kind = 'agent_step'").groupBy(*keys).agg(F.max("request_id").alias("request_id"), F.count("*").alias("attempts"))


def fallback_steps(requests: DataFrame, steps: DataFrame, run: str, keys: list[str], order: str = "line") -> DataFrame:
    """(run, order, step_no) of requests: the step with the same keys; the k-th request without one takes the k-th step
    that no request names."""
    named = requests.join(steps.select(run, *keys, "step_no"), [run, *keys], "left").select(run, order, "step_no")
    free = steps.join(requests.select(run, *keys).distinct(), [run, *keys], "left_anti")
    place = lambda df, by: df.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy(by)))
    rest = place(named.where("step_no IS NULL").drop("step_no"), order).join(place(free.select(run, "step_no"), "step_no"), [run, "place"], "left").select(run, order, "step_no")
    return named.where("step_no IS NOT NULL").unionByName(rest)
