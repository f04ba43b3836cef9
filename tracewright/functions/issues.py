"""Columns that gather issues (code, path, detail) of nested values, without an explode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ISSUES = "array<struct<code:string,path:string,detail:string>>"


def listed(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def texts(c: Column) -> Column:
    return listed(c, "array<string>")


def issue(code: str, path: Column, detail: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), path.alias("path"), F.coalesce(detail, F.lit("")).alias("detail"))


def found(bad: Column, issue: Column) -> Column:
    """The issue, made only where it is found, as a list of one, or an empty one; a test that is null finds nothing."""
    return F.when(bad, F.array(issue)).otherwise(F.array().cast(ISSUES))


def of_each(items: Column, issues: Callable[[Column, Column], Column]) -> Column:
    """All issues of ``issues(item, number)``."""
    return F.flatten(F.transform(items, issues))


def at_path(*parts: str | Column) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def repeated(values: Column) -> Column:
    """The values that occur more than once, once each and in order."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: F.size(F.filter(values, lambda w: w.eqNullSafe(v))) > 1)))


def holds(names: Column, name: Column) -> Column:
    return F.coalesce(F.array_contains(names, name), F.lit(False))


def bad_value(bad: Callable[[Column], Column], code: str, member: str) -> Callable[[Column, Column], Column]:
    """The issue of a value of the list ``member`` that is bad."""
    return lambda value, i: found(bad(value), issue(code, at_path(f"/{member}/", i), value))
