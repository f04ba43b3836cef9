"""Profiles of what a collection supports: subjects against evidence cards, measures by origin, works, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How far a card supports a subject, least first.
STATUSES = ("missing", "partial", "supported")
#: A subject that needs no data; cards of this role prove nothing.
NOT_REQUIRED, NO_EVIDENCE = "not_required", "semantic_evidence"
SUBJECT = ["subject_type", "subject_name"]


def subject_coverage(universe: DataFrame, cards: DataFrame, independent: DataFrame) -> DataFrame:
    """(subject_type, subject_name, origins, status, basis, path, reason) of every subject of the universe.

    ``universe``: (type, name, origins); ``cards``: (type, name, status, role, path, reason), of which the one of the highest
    status counts, the last path among equals; an unknown status counts as missing. ``independent``: (type, name, reason)
    of subjects that need no data, once each. Cards are brought down to one a subject before the join. Cards of subjects
    outside the universe, or with a null type or name, support nothing.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status")), F.lit(0)).cast("int")
    usable = cards.where(~F.col("role").eqNullSafe(NO_EVIDENCE))
    best = usable.groupBy(*SUBJECT).agg(F.max_by(F.struct("status", "role", "path", "reason"), F.struct(F.greatest(rank, F.lit(1)), "path", "reason")).alias("card"))
    free = independent.groupBy(*SUBJECT).agg(F.min(F.coalesce("reason", F.lit(""))).alias("free"))
    rows = universe.select(*SUBJECT, "origins").join(best, SUBJECT, "left").join(free, SUBJECT, "left")
    known = F.when(F.col("card.status").isin(*STATUSES), F.col("card.status")).otherwise(STATUSES[0])
    status = F.when(F.col("free").isNotNull(), NOT_REQUIRED).otherwise(known)
    return rows.select(*SUBJECT, "origins", status.alias("status"), F.coalesce("card.role", F.lit("none")).alias("basis"), F.col("card.path").alias("path"), F.coalesce("free", "card.reason").alias("reason"))


def measures(coverage: DataFrame) -> DataFrame:
    """(origin, subject_type, supported, total, not_required, listed, percent) by origin and type, and by origin with a null
    type: one aggregate with grouping sets. Subjects of several origins count in each; where nothing is evaluated it is 100 percent."""
    rows = coverage.select(F.explode(F.array_distinct("origins")).alias("origin"), "subject_type", "status")
    needed = F.col("status") != NOT_REQUIRED
    sums = rows.groupingSets([["origin", "subject_type"], ["origin"]], "origin", "subject_type").agg(F.count_if(F.col("status") == STATUSES[2]).alias("supported"), F.count_if(needed).alias("total"), F.count_if(~needed).alias("not_required"), F.count(F.lit(1)).alias("listed"))
    return sums.withColumn("percent", F.when(F.col("total") == 0, 100.0).otherwise(100.0 * F.col("supported") / F.col("total")))


def work_status(tasks: DataFrame, work: DataFrame) -> DataFrame:
    """(task_name, status, reason) of each named task; ``work``: (task_name, status, reason), the best status counts. Blank
    names are no tasks."""
    rank = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))
    best = work.groupBy("task_name").agg(F.max_by(F.struct("status", "reason"), F.struct(rank, "reason")).alias("best"))
    names = tasks.select(F.trim("task_name").alias("task_name")).where("task_name <> ''").distinct()
    return names.join(best, "task_name", "left").select("task_name", F.coalesce("best.status", F.lit(STATUSES[0])).alias("status"), F.col("best.reason").alias("reason"))


def work_measure(status: DataFrame) -> DataFrame:
    """One row (supported, partial, missing, total, percent); no tasks are 0 percent."""
    counts = status.agg(*(F.count_if(F.col("status") == s).alias(s) for s in reversed(STATUSES)), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("percent", F.when(F.col("total") == 0, 0.0).otherwise(100.0 * F.col("supported") / F.col("total")))


def gaps(coverage: DataFrame, status: DataFrame) -> DataFrame:
    """(subject_type, subject_name, status, reason) of all subjects and works that are missing or supported in part."""
    works = status.select(F.lit("work").alias("subject_type"), F.col("task_name").alias("subject_name"), "status", "reason")
    return coverage.select(*SUBJECT, "status", "reason").unionByName(works).where(F.col("status").isin(*STATUSES[:2]))
