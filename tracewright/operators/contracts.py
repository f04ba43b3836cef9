"""Contracts between tables: references, verdicts, sources of parameters, allowlists, scores, access and graphs.

Each function returns the rows that break a contract, or a verdict per key. Joins are equi joins on keys; a null key
meets nothing. Empty tables break nothing, repeated rows are reported as often as they break, unless counts are said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_files(rows: DataFrame, files: DataFrame, keys: list[str], references: str) -> DataFrame:
    """(keys, path) of the files that rows name, in an array, and that aren't there."""
    named = rows.select(*keys, F.explode(F.array_distinct(references)).alias("path")).where("path IS NOT NULL")
    return named.join(files.select("path").distinct(), "path", "left_anti").select(*keys, "path")


def uncovered_files(files: DataFrame, patterns: list[str]) -> DataFrame:
    """Files that no pattern of the layout covers."""
    covered = F.lit(False)
    for p in patterns:
        covered = covered | F.col("path").rlike(p)
    return files.where(~covered)


def verdict_issues(verdicts: DataFrame, requirements: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Per key what is wrong with a verdict: (key, requirement, quote, passed, outcome) rows against (key, requirement).

    Every requirement is judged once and no other is; quotes stand in the text; the outcome passes if all rows do.
    """
    judged = verdicts.groupBy(key, "requirement").agg(F.count("*").alias("times"))
    both = requirements.select(key, "requirement").distinct().withColumn("asked", F.lit(True)).join(judged, [key, "requirement"], "full")
    coverage = both.groupBy(key).agg(
        F.count_if(F.col("times").isNull()).alias("unjudged"),
        F.count_if(F.col("asked").isNull()).alias("unasked"),
        F.count_if(F.col("times") > 1).alias("repeated"),
    )
    all_passed = verdicts.groupBy(key).agg(F.bool_and("passed").alias("all_passed"))
    content = verdicts.join(all_passed, key).join(texts, key, "left").groupBy(key).agg(
        F.count_if(F.coalesce(~F.contains("text", "quote"), F.lit(True))).alias("misquoted"),
        F.bool_or((F.col("outcome") == "pass") != F.col("all_passed")).alias("wrong_outcome"),
    )
    return coverage.join(content, key, "left").withColumns({"misquoted": F.coalesce("misquoted", F.lit(0)), "wrong_outcome": F.coalesce("wrong_outcome", F.lit(False))})


def ancestors(pointer: Column) -> Column:
    """A JSON pointer and those above it, down to the root."""
    parts = F.split(pointer, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def leaf_sources(leaves: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pointer, sources) of the leaves that not exactly one source covers; a source covers all below its pointer."""
    above = leaves.select(*keys, "pointer", F.explode(ancestors(F.col("pointer"))).alias("above"))
    found = above.join(sources.select(*keys, F.col("pointer").alias("above"), F.lit(1).alias("hit")), [*keys, "above"], "left")
    return found.groupBy(*keys, "pointer").agg(F.count("hit").alias("sources")).where("sources <> 1")


def allowlist_issues(requests: DataFrame, key: str, tools: str, allowed: str) -> DataFrame:
    """(key, missing, extra) of the requests whose tools are not the allowed set."""
    text = lambda c: F.array_join(F.array_sort(c), ",")
    sets = requests.select(key, text(F.array_except(allowed, tools)).alias("missing"), text(F.array_except(tools, allowed)).alias("extra"))
    return sets.where("missing <> '' OR extra <> ''")


def score_issues(records: DataFrame, key: str, parts: dict[str, float], total: str, route: str, thresholds: list[tuple[float, str]], otherwise: str) -> DataFrame:
    """Records whose total isn't the weighted sum of its parts, or whose route isn't the first threshold it reaches."""
    weighted = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * w for c, w in parts.items()), F.lit(0.0))
    named = F.lit(otherwise)
    for least, name in sorted(thresholds):
        named = F.when(weighted >= least, name).otherwise(named)
    rows = records.select(key, total, route, weighted.alias("recomputed"), named.alias("expected_route"))
    return rows.where((F.abs(F.col(total) - F.col("recomputed")) > 1e-9) | F.col(total).isNull() | ~F.col(route).eqNullSafe(F.col("expected_route")))


def access_issues(changes: DataFrame, access: DataFrame, asset: str = "asset") -> DataFrame:
    """Changed assets that are read-only or not declared."""
    joined = changes.select(asset).distinct().join(access, asset, "left")
    reason = F.when(F.col("access").isNull(), "undeclared").when(F.col("access") == "read_only", "read only")
    return joined.select(asset, reason.alias("reason")).where("reason IS NOT NULL")


def history_issues(history: DataFrame, group: str, environment: str, task: str) -> DataFrame:
    """Per group whether it mixes environments or repeats a task."""
    found = history.groupBy(group).agg(F.count_distinct(environment).alias("environments"), (F.count("*") - F.count_distinct(task)).alias("repeated_tasks"))
    return found.where("environments > 1 OR repeated_tasks > 0")


def one_way_links(forward: DataFrame, backward: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, side) of the links told by one side only."""
    there = lambda df: df.select(a, b).distinct()
    only = lambda x, y, side: there(x).join(there(y), [a, b], "left_anti").withColumn("side", F.lit(side))
    return only(forward, backward, "forward").unionByName(only(backward, forward, "backward"))


def ordered_pairs(tools: DataFrame, group: str, name: str) -> DataFrame:
    """Every ordered pair of different names of a group, exploded from the group's array: groups are tool sets, small."""
    sets = tools.groupBy(group).agg(F.array_sort(F.collect_set(name)).alias("names"))
    first = sets.select(group, F.explode("names").alias("from_tool"), "names")
    return first.select(group, "from_tool", F.explode("names").alias("to_tool")).where("from_tool <> to_tool")


def graph_decision_issues(decisions: DataFrame, tools: DataFrame, group: str, name: str) -> DataFrame:
    """(group, from_tool, to_tool, issue): pairs judged never or twice, unknown pairs, weights outside 0 to 3, and
    prerequisites without a positive weight."""
    told = decisions.groupBy(group, "from_tool", "to_tool").agg(F.count("*").alias("times"), F.min("weight").alias("lo"), F.max("weight").alias("hi"), F.bool_or("prerequisite").alias("needed"))
    pairs = ordered_pairs(tools, group, name).withColumn("known", F.lit(True))
    both = pairs.join(told, [group, "from_tool", "to_tool"], "full")
    checks = ((F.col("times").isNull(), "not judged"), (F.col("known").isNull(), "unknown pair"), (F.col("times") > 1, "judged twice"), ((F.col("lo") < 0) | (F.col("hi") > 3), "weight outside 0 to 3"), (F.col("needed") & (F.col("hi") <= 0), "prerequisite without edge"))
    issues = F.array_compact(F.array(*(F.when(bad, F.lit(issue)) for bad, issue in checks)))
    return both.select(group, "from_tool", "to_tool", F.explode(issues).alias("issue"))


def edge_issues(edges: DataFrame, known: DataFrame, a: str = "from_tool", b: str = "to_tool") -> DataFrame:
    """(a, b, issue) of edges to themselves, told twice, of a weight outside 1 to 3, or between unknown tools."""
    names = known.select(F.col("name").alias("tool")).distinct()
    told = edges.groupBy(a, b).agg(F.count("*").alias("times"), F.min("weight").alias("lo"), F.max("weight").alias("hi"))
    for side in (a, b):
        told = told.join(names.select(F.col("tool").alias(side), F.lit(True).alias(f"known_{side}")), side, "left")
    checks = ((F.col(a) == F.col(b), "self edge"), (F.col("times") > 1, "told twice"), ((F.col("lo") < 1) | (F.col("hi") > 3), "weight outside 1 to 3"), (F.col(f"known_{a}").isNull() | F.col(f"known_{b}").isNull(), "unknown tool"))
    return told.select(a, b, F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(issue)) for bad, issue in checks)))).alias("issue"))


def partition_claims(claims: DataFrame, items: DataFrame, group: str, item: str) -> DataFrame:
    """The first member of each claimed class, for groups whose claims cover every item exactly once; else all items.

    ``claims``: (group, class, item); ``items``: (group, item).
    """
    told = claims.groupBy(group, item).agg(F.count("*").alias("times"))
    both = items.join(told, [group, item], "full").join(items.withColumn("there", F.lit(True)), [group, item], "left")
    sound = both.groupBy(group).agg(F.bool_and((F.coalesce("times", F.lit(0)) == 1) & F.coalesce("there", F.lit(False))).alias("sound"))
    firsts = claims.groupBy(group, "class").agg(F.min(item).alias(item)).select(group, item)
    kept = firsts.join(sound.where("sound"), group, "left_semi")
    return kept.unionByName(items.select(group, item).join(sound.where("sound"), group, "left_anti"))


def first_chains(chains: DataFrame, chain: str, order: str) -> DataFrame:
    """Each distinct chain once, at its first place."""
    return chains.groupBy(chain).agg(F.min(order).alias(order))


def first_urls(registry: DataFrame, cited: DataFrame, key: str, order: str) -> DataFrame:
    """(key, origin): registered URLs once each, the first wins, and cited ones that no entry has."""
    first = registry.withColumn("tw_place", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("tw_place = 1").select(key, order)
    fresh = cited.select(key).where(F.col(key).rlike("^https?://")).distinct().join(first, key, "left_anti")
    return first.withColumn("origin", F.lit("registered")).unionByName(fresh.withColumns({order: F.lit(None).cast(first.schema[order].dataType), "origin": F.lit("cited")}))
