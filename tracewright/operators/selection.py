"""Choosing among tools, seeds and archetypes: caps, scores, seeded order, matches of shortened names, summaries.

Ranks are windows over groups that are tool sets or seeds, small; a choice over a whole table is an order with a limit.
Nulls rank last unless said otherwise, ties are broken by the named columns, empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.assignment import first_distinct, maximum_matching


def capped(tools: DataFrame, group: str, usage: str, order: str, most: int) -> DataFrame:
    """At most ``most`` tools a group: by usage if every one has a valid count, else in source order; adds ``place``."""
    valid = F.bool_and(F.coalesce((F.col(usage) >= 0) & ~F.isnan(F.col(usage).cast("double")) & (F.col(usage).cast("double") < float("inf")), F.lit(False))).over(Window.partitionBy(group))
    rows = tools.withColumn("tw_rank", F.when(valid, -F.col(usage).cast("double")).otherwise(F.lit(0.0)))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("tw_rank", order))).where(F.col("place") <= most).drop("tw_rank")


def weighted_scores(reviews: DataFrame, weights: dict[str, int], most: int = 5) -> DataFrame:
    """Adds ``floored`` and ``rounded``: the weighted sum over the top score, floored, and half-even; null where a dimension
    has no whole score from 0 to ``most``."""
    total = sum((F.col(k) * w for k, w in weights.items()), F.lit(0))
    valid = F.lit(True)
    for k in weights:
        valid = valid & F.coalesce((F.col(k) >= 0) & (F.col(k) <= most) & (F.col(k) == F.floor(k)), F.lit(False))
    return reviews.withColumns({"floored": F.when(valid, F.floor(total / most).cast("long")), "rounded": F.when(valid, F.bround((total / most).cast("decimal(20,6)"), 0).cast("long"))})


def priority_list(df: DataFrame, score: str, order: str, most: int) -> DataFrame:
    """The ``most`` rows of the highest score, earlier ones first among equals."""
    return df.orderBy(F.desc_nulls_last(score), order).limit(most)


def seeded_order(key: Column, seed: int) -> Column:
    """A place in a shuffle that depends on the seed and the key alone, not on how rows are dealt."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def seeded_distinct(df: DataFrame, keys: list[str], seed: int, taken: DataFrame, names: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of a pass in seeded order that skips rows with a name (one of ``names``) of a row taken
    before; ``taken`` holds earlier ones. A row that is skipped bars none."""
    rows = df.withColumn("tw_place", seeded_order(F.concat_ws("|", *keys), seed))
    for n in names:
        rows = rows.join(taken.select(n).distinct(), n, "left_anti")
    return first_distinct(rows, ["tw_place", *keys], names).orderBy("tw_place", *keys).limit(count).drop("tw_place")


def archetype_order(archetypes: DataFrame, key: str) -> DataFrame:
    """(key, rank parts) of (key, tools: array of (name, stateful), resources, requirements, description), best first:
    any stateful tool, how many, how many tools, resources, requirements and length; the key breaks ties, descending."""
    tools = F.array_distinct("tools")
    stateful = F.size(F.filter(tools, lambda t: t["stateful"]))
    parts = {"grounded": (stateful > 0).cast("int"), "stateful": stateful, "n_tools": F.size(tools), "n_resources": F.size(F.array_distinct("resources")), "breadth": F.col("requirements") + F.floor(F.length(F.coalesce("description", F.lit(""))) / 200).cast("int")}
    return archetypes.select(key, *(c.alias(k) for k, c in parts.items())).orderBy(*(F.desc(k) for k in parts), F.desc(key))


def token_budget(requests: DataFrame, context: str, server: str, given: str, output: str, margin: int) -> DataFrame:
    """Adds the input budget and whether a request fits its context, the smaller of its own and the server's."""
    size = F.least(context, server)
    return requests.withColumns({"input_budget": size - F.col(output) - margin, "accepted": F.coalesce(F.col(given) + F.col(output) + margin <= size, F.lit(False))})


#: What ends a shortened name.
ALIAS_MARKS = ("_[0-9a-f]{8}", "-[0-9a-f]{8}", "_-[0-9a-f]{7,8}")


def shortened_match(names: DataFrame, case: str, limit: int = 64) -> DataFrame:
    """(case, matched): whether observed names are the expected ones, some shortened to ``limit`` characters.

    ``names``: (case, side 'observed' or 'expected', name). A shortened name keeps the beginning of its own and ends in a
    mark. A case matches if the names left over on both sides can be paired one to one, by a maximum matching.
    """
    rows = names.select(F.col(case).alias("case"), "side", "name").distinct()
    sides = rows.groupBy("case", "name").agg(F.count_if(F.col("side") == "observed").alias("o"), F.count_if(F.col("side") == "expected").alias("e"))
    # the leftmost mark, as "_-" and digits hold the form "-" and digits
    stem = F.regexp_extract("name", f"^(.*?)(?:{'|'.join(ALIAS_MARKS)})$", 1)
    aliases = sides.where("o > 0 AND e = 0").select("case", F.col("name").alias("alias"), F.when((F.length("name") == limit) & F.col("name").rlike(f"(?:{'|'.join(ALIAS_MARKS)})$"), stem).alias("stem"))
    long_ = sides.where(f"e > 0 AND o = 0 AND length(name) > {limit}").select("case", F.col("name").alias("full"))
    edges = aliases.join(long_, "case").where(F.col("full").startswith(F.col("stem"))).select("case", "alias", "full")
    paired = maximum_matching(edges, "case", "alias", "full").groupBy("case").agg(F.count("*").alias("paired"))
    sizes = sides.groupBy("case").agg(F.sum("o").alias("observed"), F.sum("e").alias("expected"), F.count_if((F.col("o") > 0) & (F.col("e") == 0)).alias("open"))
    out = sizes.join(paired, "case", "left").select("case", ((F.col("observed") == F.col("expected")) & (F.col("open") == F.coalesce("paired", F.lit(0)))).alias("matched"))
    return out.withColumnRenamed("case", case)


def toolset_groups(tools: DataFrame, owner: str, definition: str) -> DataFrame:
    """(digest, owners) of the owners whose sets of definitions are the same, order aside, where there are two or more."""
    sets = tools.groupBy(owner).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(F.sha2(definition, 256))), ","), 256).alias("digest"))
    return sets.groupBy("digest").agg(F.array_sort(F.collect_list(owner)).alias("owners")).where("size(owners) > 1")


def length_distribution(stages: dict[str, DataFrame], chain: str) -> DataFrame:
    """(stage, length, n): how long the chains of each stage are."""
    out = None
    for name, df in stages.items():
        part = df.groupBy(F.size(chain).cast("long").alias("length")).agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "length", "n")
        out = part if out is None else out.unionByName(part)
    return out


def mutations(calls: DataFrame, tools: DataFrame, group: str) -> DataFrame:
    """(group, mutations): successful calls of tools with side effects; zero where there is none."""
    joined = calls.join(tools.select("tool", "side_effects"), "tool", "left")
    return joined.groupBy(group).agg(F.count_if(F.coalesce(F.col("success") & F.col("side_effects"), F.lit(False))).alias("mutations"))


def path_features(paths: Column, tests: dict[str, str]) -> Column:
    """The names of the patterns that any of the paths matches, in the order given."""

    def any_matches(pattern: str) -> Column:
        return F.exists(paths, lambda p: p.rlike(pattern))

    return F.array_compact(F.array(*(F.when(any_matches(pattern), F.lit(name)) for name, pattern in tests.items())))


def meaningful_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Calls of known tools with valid input that succeeded, or whose failure is a well-formed negative answer."""
    return calls.join(tools.select("tool").distinct(), "tool", "left_semi").where("valid_input AND (success OR coalesce(negative, false))")


def exclusion_reason(columns: dict[str, Column]) -> Column:
    """The first reason that holds, in the order given; null where none does."""
    return F.coalesce(*(F.when(bad, F.lit(reason)) for reason, bad in columns.items()))


def unified_calls(native: DataFrame, domain: DataFrame, run: str) -> DataFrame:
    """(run, place, kind, name, start) of native and domain calls as one list by their start events."""
    both = native.select(run, F.lit("native").alias("kind"), "name", "start").unionByName(domain.select(run, F.lit("domain").alias("kind"), "name", "start"))
    return both.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy("start", "kind", "name")))


def capped_in_order(rows: DataFrame, group: str, relevance: str, order: str, most: int) -> DataFrame:
    """The ``most`` most relevant rows of a group, in their source order again; adds their new place."""
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(relevance), order))
    kept = rows.withColumn("tw_best", best).where(F.col("tw_best") <= most).drop("tw_best")
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order)))


def batch_summary(rows: DataFrame) -> DataFrame:
    """One row: verifier batches of (status, mode, result, score)."""
    program = F.col("mode") == "program"
    done = program & (F.col("result") == "completed")
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "generated").alias("generated"),
        F.count("mode").alias("started"),
        F.count_if(done).alias("completed"),
        F.count_if(done & (F.abs(F.col("score") - 1) < 1e-12)).alias("full_score"),
        F.count_if(F.col("mode") == "fallback").alias("fallbacks"),
        F.count_if(F.col("result") == "verification_error").alias("verification_errors"),
    )
