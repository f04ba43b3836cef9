"""Choices in tiers: a better tier goes first, and within one, score is weighed against likeness to what is chosen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import overlap
from tracewright.session import written


def steps(chain: Column) -> Column:
    """The distinct ordered pairs of neighbours in a chain; none for shorter chains."""
    pairs = F.zip_with(F.slice(chain, 1, F.greatest(F.size(chain) - 1, F.lit(0))), F.slice(chain, 2, F.greatest(F.size(chain) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.array_distinct(pairs)


def tiered_selection(chains: DataFrame, group: str, key: str, chain: str, tier: str, score: str, count: int, penalty: float) -> DataFrame:
    """(group, key, place, value): ``count`` chains of each group, chosen one after another.

    The best tier (largest) is used up before the next. Within a tier the largest value wins: score over the tier's largest
    score, minus ``penalty`` times the largest share of steps in common with a chain chosen before, of whatever tier. Ties go
    by score, length, chain (larger first), then the smaller key. A tier whose largest score is zero is not scaled.

    Two cuts lose nothing: tiers after ``count`` chains of better ones are never reached, and as a penalty takes
    ``penalty`` at most, no chain that is further below the ``count``-th best of its tier can win. What is left takes one
    pass a turn, for all groups at once; tables between turns are written. Rows with a null group, key, chain, tier or score take
    no part, repeated rows take part each; an empty table gives an empty result.
    """
    if penalty < 0:
        raise ValueError("a penalty can't be negative")
    rows = chains.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(chain).alias("chain"), F.col(tier).alias("tier"), F.col(score).cast("double").alias("score")).dropna()
    tiers = rows.groupBy("g", "tier").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("most"))
    before = F.sum("n").over(Window.partitionBy("g").orderBy(F.desc("tier")).rowsBetween(Window.unboundedPreceding, -1))
    reached = tiers.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < count)
    rows = rows.join(reached.select("g", "tier", F.when(F.col("most") == 0, 1.0).otherwise(F.col("most")).alias("most")), ["g", "tier"]).withColumn("share", F.col("score") / F.col("most")).drop("most")
    alike = Window.partitionBy("g", "tier", "score", "chain").orderBy("k")
    rows = rows.withColumn("copy", F.row_number().over(alike)).where(F.col("copy") <= count)  # of equal chains the first ones
    rows = written(rows, "tier-rows")
    best = rows.withColumn("at", F.row_number().over(Window.partitionBy("g", "tier").orderBy(F.desc("share"), "k"))).where(F.col("at") <= count)
    least = best.groupBy("g", "tier").agg((F.min("share") - penalty).alias("least"), F.max("at").alias("at"))
    bound = least.select("g", "tier", F.when(F.col("at") == count, F.col("least")).alias("least"))
    left = rows.join(bound, ["g", "tier"]).where(F.col("least").isNull() | (F.col("share") >= F.col("least")))
    left = written(left.select("g", "k", "chain", "tier", "score", "share", "copy", steps(F.col("chain")).alias("steps"), F.lit(0.0).alias("like")), "tier-left")
    taken: list[DataFrame] = []
    for place in range(1, count + 1):
        value = F.col("share") - penalty * F.col("like")
        order = F.struct("tier", value.alias("value"), "score", F.size("chain").alias("n"), "chain", (-F.col("copy")).alias("copy"))
        now = left.groupBy("g").agg(F.max_by(F.struct("k", "steps", value.alias("value")), order).alias("pick")).select("g", "pick.*")
        now = written(now.withColumn("place", F.lit(place)), "tier-taken")
        taken.append(now)
        if place == count or now.isEmpty():
            break
        chosen = now.select("g", F.col("k").alias("taken"), F.col("steps").alias("other"))
        left = left.join(chosen, "g").where("k <> taken").withColumn("like", F.greatest("like", overlap(F.col("steps"), F.col("other"))))
        left = written(left.drop("taken", "other"), "tier-left")
    every = reduce(DataFrame.unionAll, taken)
    return every.select(F.col("g").alias(group), F.col("k").alias(key), "place", "value")


def first_of_each(rows: DataFrame, key: str, order: str, wanted: list[Column], count: int) -> DataFrame:
    """(key, order, place, wanted): for each condition in turn the first row that meets it and whose key no one before took,
    then the first rows left, until there are ``count``; ``wanted`` is the condition's number from 0, null for those left.

    A condition loses at most one key to each before it, so its first keys in that number are enough: ranks with a limit,
    which leave a square of the conditions, and a fold over these. ``order`` must be unique. A condition that is null
    isn't met; rows without a key take no part; of the rows of one key the first that meets a condition counts.
    """
    last = len(wanted)
    met = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in enumerate(wanted)), F.lit(last)))
    rows = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(order).alias("o"), F.explode(met).alias("turn"))
    first = rows.groupBy("turn", "k").agg(F.min("o").alias("o"))
    room = F.when(F.col("turn") == last, count + last).otherwise(F.col("turn") + 1)
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("turn").orderBy("o"))).where(F.col("n") <= count + last).where(F.col("n") <= room)
    held = ranked.agg(F.array_sort(F.collect_list(F.struct("turn", "o", "k"))).alias("held"))

    def take(picks: Column, row: Column) -> Column:
        used = F.exists(picks, lambda p: p["k"] == row["k"]) | ((row["turn"] < last) & F.exists(picks, lambda p: p["turn"] == row["turn"]))
        return F.when(used, picks).otherwise(F.concat(picks, F.array(row)))

    picks = F.slice(F.aggregate("held", F.slice("held", F.lit(1), F.lit(0)), take), 1, count)
    out = held.select(F.posexplode(picks).alias("place", "pick"))
    return out.select(F.col("pick.k").alias(key), F.col("pick.o").alias(order), (F.col("place") + 1).alias("place"), F.when(F.col("pick.turn") < last, F.col("pick.turn")).alias("wanted"))
