"""Full joins in which null keys are equal and presence is told apart from null values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sides(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The keys, ``tw_a`` and ``tw_b`` (structs of the other columns of each side), and ``tw_in_a`` and ``tw_in_b``.

    A row without a partner has a null struct and false; a partner whose columns are all null has a struct of nulls.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        return df.select(*(F.col(c).alias(f"tw_{tag}_{k}") for k, c in enumerate(keys)), F.struct(*rest, F.lit(True).alias("tw_there")).alias(f"tw_{tag}"))

    a, b = side(before, "a"), side(after, "b")
    same = [F.col(f"tw_a_{k}").eqNullSafe(F.col(f"tw_b_{k}")) for k in range(len(keys))]
    both = a.join(b, same, "full")
    return both.select(*(F.coalesce(f"tw_a_{k}", f"tw_b_{k}").alias(c) for k, c in enumerate(keys)), "tw_a", "tw_b", F.col("tw_a").isNotNull().alias("tw_in_a"), F.col("tw_b").isNotNull().alias("tw_in_b"))
