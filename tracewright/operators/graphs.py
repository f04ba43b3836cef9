"""Tool graphs: edges, roots, prerequisites, chain scores, bounded enumeration, seeded walks and diverse selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions.text import overlap
from tracewright.session import written

#: Turns of a selection between writes, so that plans stay short.
WRITE_TURNS = 5


def first_definitions(edges: DataFrame, order: str) -> DataFrame:
    """One row for each (from_tool, to_tool), the one defined first; no edge leads to its own tool."""
    place = F.row_number().over(Window.partitionBy("from_tool", "to_tool").orderBy(order))
    return edges.where("from_tool <> to_tool").withColumn("tw_place", place).where("tw_place = 1").drop("tw_place")


def roots(tools: DataFrame, edges: DataFrame, weight: int) -> DataFrame:
    """Tools without an incoming edge of the weight or more."""
    return tools.select("tool").distinct().join(edges.where(F.col("weight") >= weight).select(F.col("to_tool").alias("tool")), "tool", "left_anti")


def prerequisites_met(any_of: Column, visited: Column) -> Column:
    """``any_of``: array of arrays, one of which must have been visited as a whole; null or empty: nothing is needed."""
    return F.coalesce(F.size(any_of) == 0, F.lit(True)) | F.coalesce(F.exists(any_of, lambda all_of: F.size(F.array_except(all_of, visited)) == 0), F.lit(False))


def canonical_alternatives(any_of: Column) -> Column:
    """Alternatives as sets, each once."""
    return F.array_distinct(F.transform(any_of, lambda a: F.array_sort(F.array_distinct(a))))


def enumerate_chains(edges: DataFrame, starts: DataFrame, length: int) -> DataFrame:
    """All chains of up to ``length`` tools without repeats, from ``starts`` (tool), along the edges: (chain, score).

    Meant for graphs of tools, a few hundred at most; the number of chains grows with the power of the degree.
    """
    step = starts.select(F.array("tool").alias("chain"), F.lit(0).cast("long").alias("score"))
    out = step
    for _ in range(length - 1):
        joined = step.join(edges, F.element_at("chain", -1) == F.col("from_tool")).where("NOT array_contains(chain, to_tool)")
        step = joined.select(F.concat("chain", F.array("to_tool")).alias("chain"), (F.col("score") + F.col("weight")).alias("score"))
        out = out.unionByName(step)
    return out


def sampled_walks(spark: SparkSession, edges: DataFrame, n: int, seed: int, least: int, most: int, tau: float = 0.4, max_visits: int = 2, prerequisites: DataFrame | None = None) -> DataFrame:
    """(walk, chain): distinct chains of ``least`` to ``most`` tools among ``n`` seeded weighted walks, each by its first walk.

    Walk k depends on (seed, k) alone, however the rows are dealt. It starts at a root, and goes on to tools visited
    fewer than ``max_visits`` times whose prerequisites are met, until none is open; from ``least`` tools on it stops
    with probability tau / (tau + open tools). The visits bound it, so lengths are filtered afterwards and no walk is
    cut. ``prerequisites``: (tool, any_of), roots are the tools without; if not given, roots are the tools without an
    incoming edge of weight 3. Edges and prerequisites are broadcast: they are a tool graph of bounded size, checked here.
    """
    rows = edges.orderBy("from_tool", "to_tool").limit(100_001).collect()
    needs = prerequisites.orderBy("tool").limit(100_001).collect() if prerequisites is not None else []
    if max(len(rows), len(needs)) > 100_000:
        raise ValueError("walks are for tool graphs of at most 100,000 edges and prerequisites")
    out: dict[str, tuple[list[str], list[float]]] = {}
    for r in rows:
        names, weights = out.setdefault(r.from_tool, ([], []))
        names.append(r.to_tool)
        weights.append(float(r.weight))
    needed = {r.tool: [set(a) for a in r.any_of] for r in needs if r.any_of}
    later = set(needed) if prerequisites is not None else {r.to_tool for r in rows if r.weight >= 3}
    starts = sorted({x for r in rows for x in (r.from_tool, r.to_tool)} - later)
    if rows and not starts:
        raise ValueError("the tool graph has no root to start from")
    shared = spark.sparkContext.broadcast((out, needed, starts))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph, alternatives, first = shared.value
        for batch in batches:
            chains = []
            for k in batch["id"]:
                rng = np.random.Generator(np.random.PCG64([seed, int(k)]))
                chain = [first[rng.integers(len(first))]] if first else []
                visits = dict.fromkeys(chain, 1)
                while chain:
                    met = lambda x: x not in alternatives or any(a <= visits.keys() for a in alternatives[x])
                    names, weights = graph.get(chain[-1], ([], []))
                    options = [(x, w) for x, w in zip(names, weights, strict=True) if visits.get(x, 0) < max_visits and met(x)]
                    if not options or (len(chain) >= least and rng.random() < tau / (tau + len(options))):
                        break
                    share = np.array([w for _, w in options])
                    chain.append(options[rng.choice(len(options), p=share / share.sum())][0])
                    visits[chain[-1]] = visits.get(chain[-1], 0) + 1
                chains.append(chain)
            yield pd.DataFrame({"walk": batch["id"], "chain": chains})

    walks = spark.range(n).mapInPandas(walk, "walk long, chain array<string>")
    return walks.where(F.size("chain").between(least, most)).groupBy("chain").agg(F.min("walk").alias("walk")).select("walk", "chain")


def chain_scores(chains: DataFrame, edges: DataFrame, key: str, alpha: float = 1.0) -> DataFrame:
    """(key, n_edges, score, eligibility): summed weights of adjacent pairs, and their mean plus alpha * ln(length)."""
    pairs = chains.select(key, F.size("chain").alias("tw_n"), F.posexplode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("chain") - 1, F.lit(1))), lambda i: F.struct(F.try_element_at("chain", i).alias("from_tool"), F.try_element_at("chain", i + 1).alias("to_tool")))).alias("tw_at", "tw_pair"))
    weighed = pairs.select(key, "tw_n", "tw_pair.from_tool", "tw_pair.to_tool").join(edges.select("from_tool", "to_tool", "weight"), ["from_tool", "to_tool"], "left")
    sums = weighed.groupBy(key).agg(F.max("tw_n").alias("tw_n"), F.coalesce(F.sum("weight"), F.lit(0)).cast("long").alias("score"))
    n = F.greatest(F.col("tw_n") - 1, F.lit(0))
    return sums.select(key, n.cast("long").alias("n_edges"), "score", F.when(n > 0, F.col("score") / n + alpha * F.log(F.col("tw_n").cast("double"))).otherwise(F.lit(0.0)).alias("eligibility"))


def diverse_selection(chains: DataFrame, key: str, score: str, count: int, penalty: float) -> DataFrame:
    """Greedy choice by score minus penalty times the largest overlap with what is chosen: (key, turn, gain).

    All chains take part. Each of the ``count`` turns is one pass over them that brings their largest overlap up to date
    with the chain just chosen and takes the best one; ties go by score, length and chain, then to the least key. Every
    ``WRITE_TURNS`` turns the table is written to the shared folder. The driver holds the chosen chains alone.
    """
    tools = F.array_distinct("chain")
    left = written(chains.select(F.col(key).alias("tw_key"), "chain", tools.alias("tw_tools"), F.col(score).cast("double").alias("tw_score"), F.lit(0.0).alias("tw_worst")), "chains")
    out: list[tuple] = []
    while len(out) < count:
        gain = F.col("tw_score") - penalty * F.col("tw_worst")
        best = left.withColumn("tw_gain", gain).orderBy(F.desc("tw_gain"), F.desc("tw_score"), F.size("chain").desc(), F.desc("chain"), "tw_key").limit(1).collect()
        if not best:
            break
        out.append((best[0]["tw_key"], len(out) + 1, best[0]["tw_gain"]))
        chosen = F.array(*map(F.lit, best[0]["tw_tools"])).cast("array<string>")
        left = left.where(F.col("tw_key") != F.lit(best[0]["tw_key"])).withColumn("tw_worst", F.greatest("tw_worst", overlap(F.col("tw_tools"), chosen)))
        if len(out) % WRITE_TURNS == 0 and len(out) < count:
            left = written(left, "chains")
    kind = dict(chains.dtypes)[key]
    return chains.sparkSession.createDataFrame(out, f"{key} {kind}, turn int, gain double")
