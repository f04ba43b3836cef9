"""Record sets with declared keys: pages, lookups and mutations that give a new version of the set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _known(df: DataFrame, names) -> None:
    if unknown := [n for n in names if n not in df.columns]:
        raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")


def matches(df: DataFrame, equal: dict) -> Column:
    """All fields equal their values; None asks for null. A boolean never matches a number."""
    _known(df, equal)
    kinds = dict(df.dtypes)
    for name, value in equal.items():
        if value is not None and isinstance(value, bool) != (kinds[name] == "boolean"):
            raise TypeError(f"{name} is {kinds[name]}, not {type(value).__name__}")
    return reduce(Column.__and__, (F.col(k).eqNullSafe(F.lit(v)) for k, v in equal.items()), F.lit(True))


def page(df: DataFrame, equal: dict, order_by: str, keys: list[str], descending: bool = False, limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of the matching rows: nulls first ascending and last descending, ties by key."""
    _known(df, [order_by, *keys])
    first = F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_first()
    return df.where(matches(df, equal)).orderBy(first, *keys).offset(offset).limit(limit)


def get(df: DataFrame, key: dict, keys: list[str]) -> DataFrame:
    """The row with the whole declared key; more than one row is an error when the result is read."""
    if sorted(key) != sorted(keys):
        raise ValueError(f"the key is ({', '.join(keys)})")
    found = df.where(matches(df, key)).limit(2)
    alone = found.agg(F.count("*").alias("tw_n")).select(F.when(F.col("tw_n") > 1, F.raise_error(F.lit("the key is not unique"))).otherwise(F.lit(True)).alias("tw_alone"))
    return found.crossJoin(F.broadcast(alone)).where("coalesce(tw_alone, true)").drop("tw_alone")  # two rows at most, and one


def create(df: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The set with complete new rows; a key that is there already, or twice among the new rows, is an error when read."""
    if set(rows.columns) != set(df.columns):
        raise ValueError("a new row needs every field")
    taken = df.select(*keys, F.lit(1).alias("tw_old")).unionByName(rows.select(*keys, F.lit(0).alias("tw_old")))
    counts = taken.join(rows.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("tw_count"))
    checked = rows.join(counts, keys, "left").where(F.when(F.col("tw_count") > 1, F.raise_error(F.lit("the key exists"))).otherwise(F.lit(True)))
    return df.unionByName(checked.select(df.columns))


def update(df: DataFrame, key: dict, changes: dict, keys: list[str]) -> DataFrame:
    """The set with some fields of one row changed."""
    if sorted(key) != sorted(keys) or not changes or set(changes) & set(keys):
        raise ValueError("an update needs the whole key and changes to other fields")
    _known(df, changes)
    kinds = dict(df.dtypes)
    hit = matches(df, key)
    return df.withColumns({k: F.when(hit, F.lit(v).cast(kinds[k])).otherwise(F.col(k)) for k, v in changes.items()})


def delete(df: DataFrame, key: dict, keys: list[str], referencing: list[tuple[DataFrame, list[str]]] = ()) -> DataFrame:
    """The set without one row; a referencing row elsewhere makes reading the result an error."""
    if sorted(key) != sorted(keys):
        raise ValueError(f"the key is ({', '.join(keys)})")
    rest = df.where(~matches(df, key))
    for other, fields in referencing:
        used = other.where(matches(other, {f: key[k] for f, k in zip(fields, keys, strict=True)})).limit(1)
        guard = used.agg(F.count("*").alias("tw_n")).select(F.when(F.col("tw_n") > 0, F.raise_error(F.lit("the row is referenced"))).otherwise(F.lit(True)).alias("tw_free"))
        rest = rest.crossJoin(F.broadcast(guard)).where("coalesce(tw_free, true)").drop("tw_free")  # one row
    return rest
