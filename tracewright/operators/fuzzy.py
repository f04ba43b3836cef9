"""Fuzzy duplicates of names: pairs whose Ratcliff-Obershelp ratio reaches a threshold, without comparing all pairs.

The ratio is 2 m / (a + b) for m matching characters, and these are a common subsequence, so two names with a ratio of
``least`` differ by at most k = (1 - least) (a + b) insertions and deletions. If the shorter one is cut into k + 1 pieces,
one of them stands unchanged in the longer one, at most k places away. Pieces are keys of a join, so only names that share
a piece near its place meet; a bound by the multisets of characters comes next, and the ratio itself, as Python's difflib
computes it, last. Nothing is lost by either filter.

Equal names are one. Null and empty names match nothing; a name too short for a piece of one character per allowed edit
is keyed by its length alone. A piece that very many names hold makes as many candidates as these have pairs: measure
with ``candidates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normal_name(name):
    """Lower-case ASCII words and numbers, without the words that tell nothing."""
    words = F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]+)"), 1)
    return F.array_join(F.filter(words, lambda w: ~w.isin(*EMPTY_WORDS)), " ")


#: Words that a normal name leaves out.
EMPTY_WORDS = ("mcp", "server", "tool", "tools", "official", "integration")


def _longest(n: int, least: float) -> int:
    return int(n * (2 - least) / least + 1e-9)


def _pieces(n: int, least: float) -> list[tuple[int, int]]:
    """(start, size) of the pieces of a name of n characters that the longest partner may still match."""
    k = int((1 - least) * (n + _longest(n, least)) + 1e-9)
    parts = min(k + 1, n)
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] if k + 1 <= n else []


def _keyed(least: float, short: bool):
    """For mapInPandas over (name): keys of a name as the shorter or as the longer one of a pair."""

    def keys(name: str) -> Iterator[tuple]:
        n = len(name)
        if short:
            pieces = _pieces(n, least)
            yield from ((n, k, name[a : a + size]) for k, (a, size) in enumerate(pieces))
            if not pieces:
                yield (n, -1, "")
            return
        for m in range(max(1, -(-int(n * least * 1e9) // int((2 - least) * 1e9))), n + 1):
            k = int((1 - least) * (n + m) + 1e-9)
            pieces = _pieces(m, least)
            if not pieces:
                yield (m, -1, "")
            for at, (a, size) in enumerate(pieces):
                yield from ((m, at, part) for part in {name[b : b + size] for b in range(max(0, a - k), min(n - size, a + k) + 1)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(name, *key) for name in frame["name"] for key in keys(name)]
            yield pd.DataFrame(rows, columns=["name", "n", "at", "piece"])

    return run


def candidates(names: DataFrame, name: str, least: float = 0.9) -> DataFrame:
    """(a, b) of distinct names, a not longer than b, that share a piece and could reach the ratio by their characters."""
    every = names.select(F.col(name).alias("name")).where("name <> ''").distinct()
    schema = "name string, n int, at int, piece string"
    a = every.mapInPandas(_keyed(least, True), schema).withColumnRenamed("name", "a")
    b = every.mapInPandas(_keyed(least, False), schema).withColumnRenamed("name", "b")
    ordered = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    met = a.join(b, ["n", "at", "piece"]).where(ordered).select("a", "b").distinct()
    counted = lambda c: F.transform(F.array_distinct(F.split(F.col(c), "")), lambda x: F.struct(x.alias("x"), F.size(F.filter(F.split(F.col(c), ""), lambda y: y == x)).alias("n")))
    shared = F.aggregate(counted("a"), F.lit(0), lambda total, x: total + F.least(x["n"], F.length("b") - F.length(F.replace(F.col("b"), x["x"], F.lit("")))))
    return met.where(2 * shared >= least * (F.length("a") + F.length("b")) - 1e-9)


def similar_names(names: DataFrame, name: str, least: float = 0.9) -> DataFrame:
    """(a, b, ratio) of distinct names, a before b, with a ratio of ``least`` or more in either direction; the larger one."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([max(SequenceMatcher(None, x, y).ratio(), SequenceMatcher(None, y, x).ratio()) for x, y in zip(a, b, strict=True)], dtype="float64")

    pairs = candidates(names, name, least).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.withColumn("ratio", ratio("a", "b")).where(F.col("ratio") >= least)
