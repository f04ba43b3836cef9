"""Requirements and what meets them: relational division, gaps as a bounded report, counters with open sets of names.

Sums and sets are combined before they are shuffled; reports are the first rows of an order, kept per partition and
merged, never a sort of the whole. Null keys are values; a requirement told twice counts once; empty requirements are met.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: issues that a readiness report lists at most.
MOST_ISSUES = 32


def _gaps(required: DataFrame, provided: DataFrame, keys: list[str]) -> DataFrame:
    need, have = required.select(*keys).distinct(), provided.select(*(F.col(k).alias(f"tw_{k}") for k in keys)).distinct()
    return need.join(have, [need[k].eqNullSafe(have[f"tw_{k}"]) for k in keys], "left_anti")


def uncovered(required: DataFrame, provided: DataFrame, group: str, item: str) -> DataFrame:
    """(group, item) that a group requires and nothing provides for it."""
    return _gaps(required, provided, [group, item])


def divided(required: DataFrame, provided: DataFrame, group: str, item: str) -> DataFrame:
    """(group, required, missing, complete): whether a group is provided with all that it requires."""
    need = required.select(group, item).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("required"))
    gaps = uncovered(required, provided, group, item).groupBy(F.col(group).alias("tw_group")).agg(F.count(F.lit(1)).alias("missing"))
    both = need.join(gaps, need[group].eqNullSafe(gaps["tw_group"]), "left").withColumn("missing", F.coalesce("missing", F.lit(0).cast("long")))
    return both.select(group, "required", "missing", (F.col("missing") == 0).alias("complete"))


def below_floor(df: DataFrame, by: list[str], counted: Column, floor: Column) -> DataFrame:
    """(by, found, floor) of the groups with fewer counted rows than their largest floor; null floors ask for nothing."""
    sums = df.groupBy(*by).agg(F.count_if(counted).alias("found"), F.max(floor).cast("long").alias("floor"))
    return sums.where(F.col("found") < F.col("floor"))


def readiness(issues: dict[str, DataFrame], subject: str, most: int = MOST_ISSUES) -> DataFrame:
    """(place, issue, subject) of the first ``most`` issues by the order of their kinds, then subject.

    ``issues``: frames with a ``subject`` column by kind; no row means ready. Each partition keeps its own first rows.
    """
    frames = [df.select(F.lit(k).alias("tw_kind"), F.lit(kind).alias("issue"), F.col(subject).cast("string").alias("subject")) for k, (kind, df) in enumerate(issues.items())]
    first = reduce(DataFrame.unionAll, frames).orderBy("tw_kind", F.asc_nulls_first("subject")).limit(most)
    ranked = first.agg(F.array_sort(F.collect_list(F.struct("tw_kind", "subject", "issue"))).alias("rows"))
    return ranked.select(F.posexplode("rows").alias("place", "row")).select((F.col("place") + 1).alias("place"), "row.issue", "row.subject")


def replacement_counts(text: Column, patterns: dict[str, str]) -> Column:
    """A map of how often each pattern occurs in a text, by name, without those that don't; null text: an empty map."""
    counts = F.map_from_arrays(F.array(*map(F.lit, patterns)), F.array(*(F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long") for p in patterns.values())))
    return F.map_filter(counts, lambda _, n: n > 0)


def counter_totals(df: DataFrame, by: list[str], counters: str) -> DataFrame:
    """(by, name, total, records): maps of counters summed by name; names needn't be known, and each is a row, so many
    names are no wide state. Null maps count nothing."""
    entries = df.select(*by, F.explode(F.map_entries(counters)).alias("tw_entry"))
    return entries.groupBy(*by, F.col("tw_entry.key").alias("name")).agg(F.sum("tw_entry.value").alias("total"), F.count(F.lit(1)).alias("records"))


def counter_maps(df: DataFrame, by: list[str], counters: str) -> DataFrame:
    """(by, totals): the same as one map a group, names in order; for names that fit in a row."""
    totals = counter_totals(df, by, counters)
    return totals.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "total")))).alias("totals"))
