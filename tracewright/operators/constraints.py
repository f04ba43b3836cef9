"""Declared field constraints as predicates over whole tables: one row for each issue."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import formats

#: Declared types and the Spark types that hold them.
KINDS = {"string": ("string",), "integer": ("tinyint", "smallint", "int", "bigint"), "number": ("float", "double", "tinyint", "smallint", "int", "bigint"), "boolean": ("boolean",)}


@dataclass(frozen=True)
class Field:
    kind: str
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    enum: tuple = field(default=())
    format: str | None = None
    multiple_of: float | None = None
    const: object = None


def lint(fields: dict[str, Field]) -> list[str]:
    """What is wrong with the declaration itself."""
    out = []
    for name, f in fields.items():
        if f.kind not in KINDS:
            out.append(f"{name}: unknown type {f.kind}")
        if f.minimum is not None and f.maximum is not None and f.minimum > f.maximum:
            out.append(f"{name}: minimum over maximum")
        if f.min_length is not None and f.max_length is not None and f.min_length > f.max_length:
            out.append(f"{name}: min_length over max_length")
        if f.format is not None and f.format not in formats.FORMATS:
            out.append(f"{name}: unknown format {f.format}")
        if f.kind != "string" and (f.format or f.pattern or f.min_length is not None or f.max_length is not None):
            out.append(f"{name}: text keywords on {f.kind}")
    return out


def schema_issues(df: DataFrame, fields: dict[str, Field]) -> list[str]:
    """Undeclared, missing and mistyped columns."""
    kinds = dict(df.dtypes)
    out = [f"{c}: undeclared" for c in kinds if c not in fields] + [f"{c}: missing" for c in fields if c not in kinds]
    return out + [f"{c}: {kinds[c]} is no {f.kind}" for c, f in fields.items() if c in kinds and kinds[c] not in KINDS[f.kind]]


def _failures(name: str, f: Field) -> list[tuple[str, Column]]:
    c = F.col(name)
    out = [] if f.nullable else [("null", c.isNull())]
    for label, bound, bad in (("minimum", f.minimum, lambda b: c < b), ("maximum", f.maximum, lambda b: c > b), ("min_length", f.min_length, lambda b: F.length(c) < b), ("max_length", f.max_length, lambda b: F.length(c) > b), ("pattern", f.pattern, lambda b: ~c.rlike(b))):
        if bound is not None:
            out.append((label, bad(bound)))
    if f.format is not None:
        out.append(("format", ~formats.has_format(c, f.format)))
    if f.multiple_of is not None:
        out.append(("multiple_of", F.abs(c / f.multiple_of - F.round(c / f.multiple_of)) > 1e-9))
    if f.const is not None:
        out.append(("const", c != F.lit(f.const)))
    if f.kind == "number":
        out.append(("finite", F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))))
    if f.enum:
        out.append(("enum", ~c.isin(*f.enum)))
    return out


def row_issues(df: DataFrame, keys: list[str], fields: dict[str, Field]) -> DataFrame:
    """(keys, field, rule) of every value that breaks its declaration; all rules are tested in one pass."""
    issues = [F.when(bad, F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"))) for name, f in fields.items() for rule, bad in _failures(name, f)]
    found = df.select(*keys, F.explode(F.array_compact(F.array(*issues))).alias("tw_issue"))
    return found.select(*keys, "tw_issue.field", "tw_issue.rule")


def first_of(checks: list[tuple[Column, str]]) -> Column:
    """The reason of the first check that holds, else null."""
    return reduce(lambda found, check: found.when(*check), checks[1:], F.when(*checks[0])) if checks else F.lit(None).cast("string")


def violations(value: Column, schema: dict, path: Column | None = None) -> Column:
    """Every (path, rule) at which a typed nested value breaks a declared schema, as an array.

    Keywords: nullable; minimum, maximum, multipleOf; minLength, maxLength, pattern, format; enum, const; items,
    minItems, maxItems, uniqueItems; properties. A null that is allowed breaks nothing below it; paths are JSON pointers.
    """
    path = F.lit("") if path is None else path
    null = value.isNull()
    rules: list[tuple[str, Column]] = []
    for word, bad in (
        ("minimum", lambda b: value < b),
        ("maximum", lambda b: value > b),
        ("multipleOf", lambda b: F.abs(value / b - F.round(value / b)) > 1e-9),
        ("minLength", lambda b: F.length(value) < b),
        ("maxLength", lambda b: F.length(value) > b),
        ("pattern", lambda b: ~value.rlike(b)),
        ("format", lambda b: ~formats.has_format(value, b)),
        ("enum", lambda b: ~value.isin(*b)),
        ("const", lambda b: value != F.lit(b)),
        ("minItems", lambda b: F.size(value) < b),
        ("maxItems", lambda b: F.size(value) > b),
        ("uniqueItems", lambda b: F.size(F.array_distinct(value)) < F.size(value) if b else F.lit(False)),
    ):
        if word in schema:
            rules.append((word, bad(schema[word])))
    if not schema.get("nullable", False):
        rules.append(("null", null))
    issue = lambda rule: F.struct(path.alias("path"), F.lit(rule).alias("rule"))
    kind = "array<struct<path:string,rule:string>>"
    parts = [F.array_compact(F.array(*(F.when(bad, issue(rule)) for rule, bad in rules))).cast(kind) if rules else F.array().cast(kind)]
    for name, below in schema.get("properties", {}).items():
        parts.append(violations(value.getField(name), below, F.concat(path, F.lit("/" + name.replace("~", "~0").replace("/", "~1")))))
    if "items" in schema:
        each = F.transform(value, lambda x, k: violations(x, schema["items"], F.concat(path, F.lit("/"), k.cast("string"))))
        parts.append(F.coalesce(F.flatten(each), F.array().cast(kind)))
    found = F.concat(*parts) if len(parts) > 1 else parts[0]
    return F.when(null, parts[0]).otherwise(found)


def first_violation(value: Column, schema: dict) -> Column:
    """The violation with the least path (then rule), null where the value is valid."""
    return F.array_min(violations(value, schema))
