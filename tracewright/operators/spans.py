"""Spans of texts, and pairs of similar short texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import char_grams

SENTENCE = "[^.!?]+[.!?]"


def sentence_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, quote) of each sentence, in order."""
    return docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(f"({SENTENCE})"), 1)).alias("place", "quote"))


def located(docs: DataFrame, quotes: DataFrame, key: str, text: str) -> DataFrame:
    """(key, quote, start, end) of the first place of each quote, counted in characters from 0; none where it isn't there."""
    at = F.instr(F.col(text), F.col("quote"))
    found = quotes.join(docs.select(key, text), key).where((F.length("quote") > 0) & (at > 0))
    return found.select(key, "quote", (at - 1).alias("start"), (at - 1 + F.length("quote")).alias("end"))


def uncovered(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_spans, uncovered): the non-space characters of a text that no span (key, start, end) covers.

    Overlapping and repeated spans count once: they are merged, and the gaps between them are looked at.
    """
    visible = lambda c: F.length(F.regexp_replace(c, r"[ \t\r\n\f\x0B]", ""))
    merged = merged_intervals(found.select(key, "start", "end"), key, "start", "end").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = docs.select(key, text).join(merged, key, "left").join(found.groupBy(key).agg(F.count("*").alias("n_spans")), key, "left")
    pieces = F.transform("spans", lambda s: F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]))
    covered = F.coalesce(visible(F.array_join(pieces, "")), F.lit(0))
    return joined.select(key, F.coalesce("n_spans", F.lit(0)).alias("n_spans"), (visible(F.col(text)) - covered).cast("long").alias("uncovered"))


def merged_intervals(found: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Overlapping or touching intervals of a key as one: (key, start, end)."""
    order = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.withColumn("tw_new", (reach.isNull() | (F.col(start) > reach)).cast("int"))
    islands = opened.withColumn("tw_island", F.sum("tw_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "tw_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("tw_island")


def similar_pairs(names: DataFrame, key: str, text: str, n: int, least: float) -> DataFrame:
    """(a, b, shared, united) of texts whose character n-gram sets have a Jaccard similarity of ``least`` or more.

    Grams are ordered rare first; two similar sets share one among the first size - ceil(least * size) + 1 of each, so
    only those are joined, and the sets are compared afterwards.
    """
    sets = names.select(F.col(key).alias("id"), char_grams(F.col(text), n).alias("grams")).where("size(grams) > 0")
    grams = sets.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count("*").alias("f"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("f", "gram"))
    prefix = grams.join(frequency.where("f > 1"), "gram").withColumn("place", place).where(f"place <= n - ceil({least} * n) + 1").select("id", "n", "gram")
    other = prefix.select(F.col("id").alias("b"), F.col("n").alias("b_n"), "gram")
    pairs = prefix.join(other, "gram").where(f"id < b AND least(n, b_n) >= {least} * greatest(n, b_n)").select(F.col("id").alias("a"), "b").distinct()
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("tw_x")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("tw_y")), "b")
    shared = F.size(F.array_intersect("tw_x", "tw_y")).cast("long")
    measured = joined.select("a", "b", shared.alias("shared"), (F.size("tw_x") + F.size("tw_y") - shared).alias("united"))
    return measured.where(F.col("shared") >= least * F.col("united"))
