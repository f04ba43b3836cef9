"""Exact, number-only and near duplicates among texts."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tracewright.functions import gram_windows
from tracewright.functions.text import char_grams
from tracewright.session import written

GRAM = 5
#: Texts, and characters of each, of the sample that tells which windows are common; most of these.
SAMPLE, COMMON = 4096, 1 << 17
#: Near duplicates reach one of these, both texts being of the length.
JACCARD, CONTAINMENT, LEAST_CHARS = 0.78, 0.94, 60
#: Grams of a window, the first number that will do: for texts of about one size, and for smaller ones within larger.
WIDTHS, WITHIN = (6, 5, 4), (8, 6, 4)
#: Partitions in which windows meet walks, for each that shuffles have: walks are many times their texts, and sorted.
FINER = 4


@F.pandas_udf(StringType())
def normal_form(text: pd.Series) -> pd.Series:
    """NFKC, case folded, letters, digits and # alone; null stays null."""
    return text.map(lambda t: "".join(c for c in unicodedata.normalize("NFKC", t).casefold() if c.isalnum() or c == "#"), na_action="ignore")


def ascii_form(text: Column) -> Column:
    """Lower case without ASCII white space and punctuation: what SQL can follow.

    Its lower case maps one character to one; Java's own looks around for a final sigma and gives two for a dotted I.
    """
    return F.regexp_replace(F.lower(F.translate(text, "\u03a3\u0130", "\u03c3i")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", "")


def duplicate_classes(df: DataFrame, key: str, text: str, form: Callable[[Column], Column] = normal_form, digits: str = r"\p{Nd}+", nulls_alike: bool = False) -> DataFrame:
    """(key, exact_id, number_id): the smallest key with the same form, and with the same form up to numbers; both null where
    the text is null, unless nulls are alike and make a class of their own."""
    forms = df.select(key, form(F.col(text)).alias("tw_form"))
    hashed = forms.select(key, F.sha2("tw_form", 256).alias("tw_e"), F.sha2(F.regexp_replace("tw_form", digits, "#"), 256).alias("tw_n"))
    if nulls_alike:  # no digest is empty
        hashed = hashed.fillna("", ["tw_e", "tw_n"])
    exact = hashed.groupBy("tw_e").agg(F.min(key).alias("exact_id"), F.min("tw_n").alias("tw_n"))
    numbers = exact.groupBy("tw_n").agg(F.min("exact_id").alias("number_id"))
    return hashed.drop("tw_n").join(exact.join(numbers, "tw_n").drop("tw_n"), "tw_e", "left").select(key, "exact_id", "number_id")


def _common_windows(forms: DataFrame) -> gram_windows.Common:
    """The windows that most texts of a sample hold, ``COMMON`` at most, and how many; this orders windows only and bars none."""
    sample = forms.select("id", F.substring("form", 1, SAMPLE).alias("form"), F.xxhash64("form").alias("h")).orderBy("h", "id").limit(SAMPLE).drop("h")
    keys = sample.mapInArrow(gram_windows.plain_keys(GRAM, gram_windows.HEADS[0]), gram_windows.KEYS)
    rows = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(COMMON).toArrow()
    found, n = rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(found)
    return found[order], n[order]


def _marked_bits(windows: DataFrame) -> np.ndarray:
    """The bits that windows and what they begin with mark: 32 MB, however many they are."""
    keys = windows.select(F.explode(F.array("key", "next", "head", "body")).alias("key")).where("key IS NOT NULL")
    words = keys.groupBy(F.expr(gram_windows.marked_word("key")).alias("word")).agg(F.expr(f"bit_or({gram_windows.marked_bits('key')})").alias("bits"))
    words = written(words, "near-bits", drop_shuffles=True).toArrow()
    table = np.zeros(1 << gram_windows.WORD_BITS, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def near_duplicates(df: DataFrame, key: str, text: str, form: Callable[[Column], Column] = normal_form) -> DataFrame:
    """(a, b, shared, size_a, size_b) of distinct forms (each by its smallest key) that are near duplicates.

    With Jaccard j the overlap of sets of s and t grams is at least j / (1 + j) of s + t, with containment c at least c of
    the smaller. So of a set at most some m grams are missing in a larger near duplicate, and of k windows of successive
    grams, no gram in two of them, k - m are whole in it: the smaller text gives windows, rare ones first, the larger all
    walks over its grams. Of texts that meet often enough, those whose marks leave it open are compared exactly. All joins
    are merges: Spark takes walks and sets for as small as the file of their texts, and would broadcast them.
    """
    forms = df.select(F.col(key).alias("id"), form(F.col(text)).alias("form")).where(f"length(form) >= {LEAST_CHARS}")
    forms = written(forms.groupBy("form").agg(F.min("id").alias("id")).select("id", "form"), "near-forms", drop_shuffles=True)
    # few bytes of text are much work here: the number of partitions is told
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = forms.repartition(parts, "id")
    common = _common_windows(forms)
    alike = dealt.mapInArrow(gram_windows.window_keys(GRAM, WIDTHS, 2 * JACCARD / (1 + JACCARD), common, True), gram_windows.KEYS)
    within = dealt.mapInArrow(gram_windows.window_keys(GRAM, WITHIN, CONTAINMENT, common), gram_windows.KEYS)
    small = written(alike.withColumn("within", F.lit(False)).unionAll(within.withColumn("within", F.lit(True))), "near-windows", drop_shuffles=True)
    widths = sorted((r.within, r.width) for r in small.select("within", "width").distinct().collect())
    walk_keys = gram_windows.walk_keys(GRAM, *(w for k, w in widths if k), alike=tuple(w for k, w in widths if not k), bits=_marked_bits(small))
    walks = dealt.mapInArrow(walk_keys, gram_windows.KEYS).select("id", "n", "key")
    own = small.selectExpr("id AS s", "n AS s_n", "place", "keys", "within", "explode(array(key, next)) AS key").where("key IS NOT NULL")
    # how many grams of s may be missing, by either rule
    by_jaccard, by_containment = f"s_n - ceil({JACCARD / (1 + JACCARD)} * (s_n + n) - 1e-6)", f"s_n - ceil({CONTAINMENT} * s_n - 1e-6)"
    both = own.repartition(FINER * parts, "key").join(walks.repartition(FINER * parts, "key").hint("merge"), "key").where("s <> id AND (n > s_n OR (n = s_n AND s < id))")
    both = both.where(f"within = ({by_jaccard} <= {by_containment}) AND place <= greatest({by_jaccard}, {by_containment}) + {gram_windows.SPARE}")
    both = both.withColumn("missing", F.expr(f"greatest({by_jaccard}, {by_containment})"))
    both = both.select("s", "id", "missing", F.expr(f"least(keys - missing, {gram_windows.SPARE + 1})").alias("whole"))
    met = written(both.groupBy("s", "id", "missing", "whole").agg(F.count("*").alias("n")).where("n >= whole").select("s", "id", "missing"), "near-met", drop_shuffles=True)
    bits = written(dealt.mapInArrow(gram_windows.marks(GRAM), gram_windows.MARKS), "near-marks", drop_shuffles=True)
    met = met.join(bits.selectExpr("id AS s", *gram_windows.marks_as("s_")).hint("merge"), "s").join(bits.selectExpr("id", *gram_windows.marks_as("t_")).hint("merge"), "id")
    close = met.where(f"{gram_windows.lacking('s_', 't_')} <= missing")
    pairs = written(close.select(F.least("s", "id").alias("a"), F.greatest("s", "id").alias("b")), "near-pairs", drop_shuffles=True)
    members = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = written(dealt.join(members.hint("merge"), "id", "left_semi").select("id", char_grams(F.col("form"), GRAM).alias("grams")), "near-sets", drop_shuffles=True)
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("tw_x")).hint("merge"), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("tw_y")).hint("merge"), "b")
    measured = joined.select("a", "b", F.size(F.array_intersect("tw_x", "tw_y")).cast("long").alias("shared"), F.size("tw_x").cast("long").alias("size_a"), F.size("tw_y").cast("long").alias("size_b"))
    return measured.where(f"shared >= {JACCARD} * (size_a + size_b - shared) OR shared >= {CONTAINMENT} * least(size_a, size_b)")
