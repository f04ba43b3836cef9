"""Outcome, coverage, usage and corpus reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Outcome categories, from the one that wins.
CATEGORIES = ("tool_budget_fail", "execution_failed", "verifier_pass", "verifier_fail", "verification_error", "completed_unverified", "pending")


def outcome_category(budget_stop: Column, status: Column, outcome: Column, error: Column) -> Column:
    """A budget stop wins over all else; then a cancelled run, a verified pass or fail, a verification error, a failed run
    and a completed one; all others are pending. ``outcome``: pass or fail where it was verified, else null."""
    return (
        F.when(budget_stop, CATEGORIES[0])
        .when(status.isin("cancelled", "canceled"), CATEGORIES[1])
        .when(outcome == "pass", CATEGORIES[2])
        .when(outcome == "fail", CATEGORIES[3])
        .when(error, CATEGORIES[4])
        .when(status.isin("failed", "environment_stopped"), CATEGORIES[1])
        .when(status == "completed", CATEGORIES[5])
        .otherwise(CATEGORIES[6])
    )


def counts_over(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """A row for each category of the domain, zero where none occurs."""
    every = df.sparkSession.createDataFrame([(x,) for x in domain], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def pass_rates(df: DataFrame, passed: Column, decided: Column, expected: int, by: list[str]) -> DataFrame:
    """Passes over a fixed denominator and over decided rows; null where nothing is decided."""
    sums = df.groupBy(*by).agg(F.count_if(passed).alias("n_passed"), F.count_if(decided).alias("n_decided"))
    return sums.withColumns({"rate_expected": F.col("n_passed") / F.lit(expected), "rate_decided": F.try_divide("n_passed", "n_decided")})


def coverage(df: DataFrame, supported: Column, required: Column, by: list[str]) -> DataFrame:
    """Supported over required subjects as a percentage; 100 where nothing is required."""
    sums = df.groupBy(*by).agg(F.count_if(supported & required).alias("supported"), F.count_if(required).alias("evaluated"), F.count_if(~required).alias("not_required"))
    return sums.withColumn("percent", F.when(F.col("evaluated") == 0, F.lit(100.0)).otherwise(100.0 * F.col("supported") / F.col("evaluated")))


def share_of_all(df: DataFrame, column: str) -> DataFrame:
    """Counts of a column's values and their share of all rows; the window is over distinct values."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def weighted_score(score: Column, most: Column, weight: Column) -> Column:
    """Of a rubric's rows: the weighted mean of score over its maximum."""
    return F.sum(weight * score / most) / F.sum(weight)


def effective_calls(df: DataFrame, by: list[str], changes: Column, identity: list[str]) -> DataFrame:
    """Calls that change state, plus distinct reads."""
    what = F.struct(*identity)
    return df.groupBy(*by).agg((F.count_if(changes) + F.count_distinct(F.when(~changes, what))).alias("effective_calls"))
