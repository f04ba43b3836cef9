"""Views of tool graphs and their tasks for readers: graphs checked again, tasks projected and counted.

A bundle is a row with nested values: tools, edges, prerequisites, tasks. All checks and projections are Columns over it, so
nothing is shuffled. ``view_issues`` tells what bars a view; ``packed_views`` makes the views of the others. Null lists are
empty, but a task's null chain and a verdict without errors are issues; equal bundles give equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.issues import ISSUES, at_path, found, holds, issue, listed, of_each, repeated, texts

EDGES = "array<struct<from_tool:string,to_tool:string,weight:int,reason:string>>"
PREREQUISITES = "array<struct<to_tool:string,any_of:array<struct<all_of:array<string>,reason:string>>>>"
TASKS = "array<struct<task_id:string,chain:array<string>,score:double,validation:struct<passed:boolean,errors:array<string>>,execution:struct<success:boolean,calls:array<string>,attempts:array<struct<failed_tool:string,failure_kind:string>>>>>"
#: Weights that an edge may have.
WEIGHTS = (1, 2, 3)


def _blank(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def issues_of(tools: Column, edges: Column, prerequisites: Column, tasks: Column) -> Column:
    """All issues of a bundle's graph and tasks, in their order."""
    names, links = texts(tools), listed(edges, EDGES)
    pairs = F.transform(links, lambda e: F.concat_ws("\x1f", F.coalesce(e["from_tool"], F.lit("")), F.coalesce(e["to_tool"], F.lit(""))))

    def of_edge(e: Column, i: Column) -> Column:
        ends = F.concat_ws(">", e["from_tool"], e["to_tool"])
        first = F.array_position(pairs, F.get(pairs, i)) == i + 1
        return F.concat(
            found(~holds(names, e["from_tool"]) | ~holds(names, e["to_tool"]), issue("unknown_tool", at_path("/edges/", i), ends)),
            found(~F.coalesce(e["weight"].isin(*WEIGHTS), F.lit(False)), issue("invalid_weight", at_path("/edges/", i), e["weight"].cast("string"))),
            found(~first, issue("repeated_edge", at_path("/edges/", i), ends)),
        )

    def of_prerequisite(p: Column, i: Column) -> Column:
        options = listed(p["any_of"], "array<struct<all_of:array<string>,reason:string>>")

        def of_option(a: Column, j: Column) -> Column:
            needs = texts(a["all_of"])
            bad = (F.size(needs) == 0) | (F.size(F.array_except(needs, names)) > 0) | (F.size(repeated(needs)) > 0) | _blank(a["reason"])
            return found(bad, issue("invalid_alternative", at_path("/prerequisites/", i, "/any_of/", j), F.array_join(needs, ",", "null")))

        return F.concat(found(~holds(names, p["to_tool"]) | (F.size(options) == 0), issue("invalid_prerequisite", at_path("/prerequisites/", i), p["to_tool"])), of_each(options, of_option))

    def of_task(t: Column, i: Column) -> Column:
        passed, verdict = t["validation"]["passed"], t["validation"].isNotNull()
        return F.concat(
            found(F.coalesce(t["task_id"], F.lit("")) == "", issue("no_task_id", at_path("/tasks/", i), F.lit(""))),
            found(t["chain"].isNull() | F.exists(t["chain"], F.isnull), issue("invalid_chain", at_path("/tasks/", i), t["task_id"])),
            found(verdict & (passed.isNull() | t["validation"]["errors"].isNull()), issue("invalid_verdict", at_path("/tasks/", i), t["task_id"])),
            found((F.size(texts(t["chain"])) == 0) & ~passed.eqNullSafe(False), issue("empty_chain", at_path("/tasks/", i), t["task_id"])),
        )

    return F.concat(of_each(links, of_edge), of_each(listed(prerequisites, PREREQUISITES), of_prerequisite), of_each(listed(tasks, TASKS), of_task))


def failed_tool(task: Column) -> Column:
    """The tool that the last attempt says failed, if the chain has it; else, of a failed run, the one after its calls."""
    attempts = F.coalesce(task["execution"]["attempts"], F.array().cast("array<struct<failed_tool:string,failure_kind:string>>"))
    last, calls = F.get(attempts, F.size(attempts) - 1)["failed_tool"], F.size(texts(task["execution"]["calls"]))
    return F.when(holds(task["chain"], last), last).when(task["execution"]["success"].eqNullSafe(False), F.get(task["chain"], calls))


def _task_view(t: Column) -> Column:
    attempts = t["execution"]["attempts"]
    n = F.greatest(F.coalesce(F.size(attempts), F.lit(0)), F.lit(0))
    return F.struct(t["task_id"].alias("task_id"), t["chain"].alias("chain"), t["score"].alias("score"), t["validation"]["passed"].alias("passed"), texts(t["validation"]["errors"]).alias("errors"), t["execution"]["success"].alias("success"), n.alias("attempts"), failed_tool(t).alias("failed_tool"), F.get(attempts, n - 1)["failure_kind"].alias("failure_kind"))


def _issues(df: DataFrame) -> DataFrame:
    return df.withColumn("tw_issues", issues_of(F.col("tools"), F.col("edges"), F.col("prerequisites"), F.col("tasks")).cast(ISSUES))


def view_issues(bundles: DataFrame, key: str) -> DataFrame:
    """(key, code, path, detail) of bundles (key, tools, edges, prerequisites, tasks)."""
    return _issues(bundles).select(key, F.explode("tw_issues").alias("i")).select(key, "i.*")


def packed_views(bundles: DataFrame, key: str) -> DataFrame:
    """(key, tools, edges, prerequisites, tasks, counts) of the bundles without issues: edges with ids by their place, tasks cut
    down to what readers see, counts of tools, edges and tasks passed, rejected and pending."""
    rows = _issues(bundles).where(F.size("tw_issues") == 0)
    tasks = F.transform(listed(F.col("tasks"), TASKS), _task_view)
    edges = F.transform(listed(F.col("edges"), EDGES), lambda e, i: F.struct(F.concat(F.lit("base-"), i.cast("string")).alias("id"), e["from_tool"].alias("source"), e["to_tool"].alias("target"), e["weight"].alias("weight"), F.coalesce(e["reason"], F.lit("")).alias("reason")))
    out = rows.select(key, texts(F.col("tools")).alias("tools"), edges.alias("edges"), listed(F.col("prerequisites"), PREREQUISITES).alias("prerequisites"), tasks.alias("tasks"))
    of = lambda passed: F.size(F.filter("tasks", lambda t: t["passed"].eqNullSafe(passed)))
    return out.withColumn("counts", F.struct(F.size("tools").alias("tools"), F.size("edges").alias("edges"), F.size("tasks").alias("tasks"), of(F.lit(True)).alias("passed"), of(F.lit(False)).alias("rejected"), of(F.lit(None).cast("boolean")).alias("pending")))
