"""States of record sets and files: manifests, composite differences, replays, integrity of receipts.

A state is a table (state, asset, key, digest): one row per record or file. Differences are full outer joins on keys, so
both sides are shuffled once; digests of assets are counts and sums of row hashes, so they need no order. Null keys count
as one key, empty states differ from nothing in every row, repeated rows of one key are told apart by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.nullsafe import sides


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``ordinal``: the number of a row among those with equal keys."""
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def state_manifest(rows: DataFrame, state: list[str], asset: str, digest: str) -> DataFrame:
    """(state, asset, n, digest): the rows of each asset, and a digest of two sums over the rows' hexadecimal digests."""
    each = rows.groupBy(*state, asset).agg(F.count("*").alias("n"), *(F.sum(F.conv(F.substring(digest, a, 8), 16, 10).cast("long")).alias(f"tw_{a}") for a in (1, 9)))
    return each.select(*state, asset, "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("tw_1").cast("string"), F.col("tw_9").cast("string")), 256).alias("digest"))


def digest_of_digests(manifest: DataFrame, state: list[str], asset: str) -> DataFrame:
    """One digest per state over its assets' names and digests; assets are few."""
    parts = F.array_sort(F.collect_list(F.concat_ws("=", asset, "digest")))
    return manifest.groupBy(*state).agg(F.count("*").alias("assets"), F.sha2(F.array_join(parts, "\n"), 256).alias("digest"))


def ordered_digest(rows: DataFrame, group: list[str], order: str, digest: str, chunk: int = 4096) -> DataFrame:
    """(group, n, digest) that depends on the order of rows: digests of runs of ``chunk`` rows, then of those in order.

    ``order`` numbers a group's rows from 0 without gaps, so no task holds more than a run, or the digests of the runs.
    """
    joined = lambda by: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, "tw_digest"))), lambda x: x["tw_digest"]), ","), 256)
    runs = rows.select(*group, F.col(order).alias("tw_place"), (F.col(order) / chunk).cast("long").alias("tw_run"), F.col(digest).alias("tw_digest"))
    runs = runs.groupBy(*group, "tw_run").agg(F.count("*").alias("n"), joined("tw_place").alias("tw_digest"))
    return runs.groupBy(*group).agg(F.sum("n").alias("n"), joined("tw_run").alias("digest"))


def state_diff(before: DataFrame, after: DataFrame, asset: str, key: str, digest: str) -> DataFrame:
    """(asset, key, change) of the rows that differ: inserted, updated or deleted. Null assets, keys and digests are
    values like others."""
    both = sides(before.select(asset, key, digest), after.select(asset, key, digest), [asset, key])
    change = F.when(~F.col("tw_in_a"), "inserted").when(~F.col("tw_in_b"), "deleted").when(~F.col(f"tw_a.{digest}").eqNullSafe(F.col(f"tw_b.{digest}")), "updated")
    return both.select(asset, key, change.alias("change")).where("change IS NOT NULL")


def changed_assets(diff: DataFrame, declared: DataFrame, asset: str) -> DataFrame:
    """Per changed asset the counts of changes and whether it was declared (composite difference)."""
    counts = diff.groupBy(asset).agg(*(F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "updated", "deleted")))
    return counts.join(declared.select(asset).distinct().withColumn("declared", F.lit(True)), asset, "left").withColumn("declared", F.coalesce("declared", F.lit(False)))


def comparable_digest(path: Column, digest: Column, suffixes: tuple[str, ...]) -> Column:
    """A digest to compare by: null for containers whose bytes vary with the same content, told by their suffix."""
    return F.when(~F.lower(path).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"), digest)


def replay_stability(runs: DataFrame, case: str, run: str, component: str, digest: str) -> DataFrame:
    """(case, component, runs, kinds, stable): components of cases whose runs all gave the same."""
    counts = runs.groupBy(case, component).agg(F.count_distinct(run).alias("runs"), F.count_distinct(F.coalesce(digest, F.lit(""))).alias("kinds"))
    total = runs.groupBy(case).agg(F.count_distinct(run).alias("of_runs"))
    return counts.join(total, case).select(case, component, "runs", "kinds", ((F.col("kinds") == 1) & (F.col("runs") == F.col("of_runs"))).alias("stable"))


def first_difference(left: DataFrame, right: DataFrame, keys: list[str], order: str = "pointer") -> DataFrame:
    """Per key the least pointer at which two flattened values differ, and both values; none where they agree."""
    both = sides(left.select(*keys, order, "value"), right.select(*keys, order, "value"), [*keys, order]).withColumns({"a": F.col("tw_a.value"), "b": F.col("tw_b.value")})
    differ = both.where(~F.col("a").eqNullSafe(F.col("b")) | (F.col("tw_in_a") != F.col("tw_in_b")))
    return differ.groupBy(*keys).agg(F.min(F.struct(order, "a", "b")).alias("first")).select(*keys, F.col(f"first.{order}").alias(order), "first.a", "first.b")


def receipt_integrity(files: DataFrame, receipts: DataFrame) -> DataFrame:
    """(path, status) of files and receipts: ok, mismatch, no receipt, or no file. Both have (path, sha256); a null digest
    proves nothing, so it is a mismatch."""
    both = sides(files.select("path", "sha256"), receipts.select("path", "sha256"), ["path"])
    status = F.when(~F.col("tw_in_b"), "no receipt").when(~F.col("tw_in_a"), "no file").when(F.col("tw_a.sha256") == F.col("tw_b.sha256"), "ok").otherwise("mismatch")
    return both.select("path", status.alias("status"))


def union_by_priority(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of the first frame, then of each next one those whose key no frame before has."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df.join(out.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)
    return out


def presence_audit(selected: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """(key, state): selected symbols that the index has or lacks, and all of the index that were not selected."""
    both = sides(selected.select(key).distinct(), index.select(key).distinct(), [key])
    return both.select(key, F.when(~F.col("tw_in_b"), "missing").when(~F.col("tw_in_a"), "unselected").otherwise("present").alias("state"))


def evidence_subset(reviews: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Seeds with their review, and whether it cites only retained evidence; ``evidence`` and ``retained`` are arrays."""
    joined = seeds.join(reviews.select(key, "evidence", F.lit(True).alias("reviewed")), key, "left")
    foreign = F.size(F.array_except(F.coalesce("evidence", F.array().cast("array<string>")), "retained"))
    return joined.select(key, F.coalesce("reviewed", F.lit(False)).alias("reviewed"), foreign.cast("long").alias("foreign_evidence"))


def same_multisets(a: DataFrame, b: DataFrame, group: str) -> DataFrame:
    """(group, only_a, only_b): how many rows each side has beyond the other; both zero where the multisets are equal."""
    columns = [c for c in a.columns if c != group]
    both = a.withColumn("tw_n", F.lit(1)).unionByName(b.select(a.columns).withColumn("tw_n", F.lit(-1)))
    sums = both.groupBy(group, *columns).agg(F.sum("tw_n").alias("n"))
    return sums.groupBy(group).agg(F.sum(F.greatest("n", F.lit(0))).alias("only_a"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("only_b"))


def alias_join(bindings: DataFrame, cases: DataFrame, aliases: list[str], key: str) -> DataFrame:
    """(key, binding, n) of cases by any of their bindings' names; ``binding`` is null where several match."""
    named = bindings.select("binding", F.explode(F.array_distinct(F.array(*aliases))).alias(key)).where(F.col(key).isNotNull()).distinct()
    found = cases.select(key).distinct().join(named, key, "left").groupBy(key).agg(F.count("binding").alias("n"), F.min("binding").alias("binding"))
    return found.select(key, F.when(F.col("n") == 1, F.col("binding")).alias("binding"), "n")


def cited_calls(citations: DataFrame, calls: DataFrame, required: DataFrame, case: str) -> DataFrame:
    """Per case of (case, call_id, tool) citations: those without a call, those of tools not allowed, required tools not cited.

    ``calls``: (case, call_id, tool, allowed); ``required``: (case, tool).
    """
    joined = citations.select(case, "call_id").join(calls.select(case, "call_id", "tool", "allowed"), [case, "call_id"], "left")
    cited = joined.groupBy(case).agg(F.count_if(F.col("tool").isNull()).alias("unknown"), F.count_if(~F.col("allowed")).alias("forbidden"))
    open_tools = required.select(case, "tool").distinct().join(joined.select(case, "tool"), [case, "tool"], "left_anti").groupBy(case).agg(F.count("*").alias("uncovered"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("unknown", "forbidden", "uncovered")}
    return cited.join(open_tools, case, "full").withColumns(zero)
