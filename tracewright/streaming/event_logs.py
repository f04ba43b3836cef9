"""Streams of event-log rows: incremental release appends, per-run call budgets and a breaker over distinct errors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def new_keys(stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """The first row of each key; with a watermark the keys are forgotten after ``delay``, so state stays bounded."""
    if event_time and delay:
        return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def windowed_counts(stream: DataFrame, event_time: str, by: list[str], width: str, delay: str) -> DataFrame:
    """Counts per tumbling window; late rows beyond ``delay`` are dropped."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay).groupBy(F.window(event_time, width), *by).agg(F.count("*").alias("n"))


def call_budget(stream: DataFrame, run: str, order: str, limit: int) -> DataFrame:
    """(run, order, call, allowed): calls numbered per run across micro-batches; those beyond the limit are stopped.

    Calls of one batch are numbered in the given order; a run's rows must not arrive later than rows that follow them.
    """
    kind = dict(stream.dtypes)

    def count(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        calls = range(seen + 1, seen + len(rows) + 1)
        state.update((seen + len(rows),))
        yield pd.DataFrame({run: key[0], order: rows[order].to_numpy(), "call": list(calls), "allowed": [c <= limit for c in calls]})

    schema = f"{run} {kind[run]}, {order} {kind[order]}, call long, allowed boolean"
    return stream.select(run, order).groupBy(run).applyInPandasWithState(count, schema, "seen long", "append", GroupStateTimeout.NoTimeout)


def distinct_errors(stream: DataFrame, trace: str, line: str, breaker: str, limit: int) -> DataFrame:
    """(breaker, n_errors, open): distinct (trace, line) errors per breaker, and whether it has tripped."""
    once = stream.dropDuplicates([trace, line])
    return once.groupBy(breaker).agg(F.count("*").alias("n_errors")).withColumn("open", F.col("n_errors") >= limit)


def call_counts(stream: DataFrame, run: str, call: str, name: str, event_time: str, delay: str) -> DataFrame:
    """(run, native, environment, other): distinct calls of a run so far, by the prefix of their tool's name.

    A call that is logged again within ``delay`` counts once; offsets and lines that are cut are the source's business.
    """
    once = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([run, call])
    native, environment = F.startswith(name, F.lit("native_")), F.startswith(name, F.lit("env_"))
    return once.groupBy(run).agg(F.count_if(native).alias("native"), F.count_if(environment).alias("environment"), F.count_if(~native & ~environment).alias("other"))
