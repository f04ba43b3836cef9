"""JSON Schema (2020-12) compiled to one Column over a variant, and a schema's own nodes.

A schema becomes an expression: no Python runs per row. Errors come in the order in which a validator that walks the
schema's members one after another finds them, so the first error is the first element.

Keywords: type, enum, const, nullable; minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf; minLength,
maxLength, pattern, format; items, prefixItems, contains, minContains, maxContains, minItems, maxItems, uniqueItems;
properties, patternProperties, additionalProperties, required, propertyNames, minProperties, maxProperties,
dependentRequired, dependentSchemas; anyOf, oneOf, allOf, not, if, then, else; $ref into the same document. Others bar
nothing. Numbers are compared as doubles. A reference that leads to itself is followed ``DEEPEST`` times on one way; a
container below that is an error of its own. Formats are those of ``functions.formats``.

A null column has the error ``document``; JSON's null is a value. Empty containers are valid unless a keyword says
otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions import formats
from tracewright.functions.pointers import pointer_tokens

ERRORS = "array<struct<path:string,rule:string>>"
DEEPEST = 3
_OF_TEXT, _OF_ITEMS, _OF_MEMBERS = ("minLength", "maxLength", "pattern", "format"), ("minItems", "maxItems", "uniqueItems"), ("minProperties", "maxProperties")
_LOOKS_AT = {
    **dict.fromkeys(("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"), "number"),
    **dict.fromkeys(_OF_TEXT, "text"),
    **dict.fromkeys((*_OF_ITEMS, "items", "prefixItems", "contains"), "items"),
    **dict.fromkeys((*_OF_MEMBERS, "required", "properties", "patternProperties", "additionalProperties", "propertyNames", "dependentRequired", "dependentSchemas"), "members"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    The value is the start of an empty aggregation and ``body`` its end. As the one element of a transformed list it would be
    right too, but such a list's type is derived from all of ``body`` anew, by each rule of the planner and for each row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def _facts(v: Column, needs: set[str], body: Callable[[Column], Column]) -> Column:
    """``body`` of what keywords ask of a value: its members, items, type name, number and text, each computed once and only
    if needed. Values that are no containers have short type names; those of containers are not looked at where it is known."""
    get = lambda x, kind: F.try_variant_get(x, "$", kind)
    held = [k for k in ("members", "items") if k in needs]
    scalars = [k for k in ("number", "text") if k in needs]
    named = "name" in needs or len(scalars) > 1

    def with_scalars(x: Column) -> Column:
        if not scalars:
            return body(x)
        name = x["name"] if named else _name(x, held)
        of = {"number": F.when(name.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), get(x["v"], "double")), "text": F.when(name == "STRING", get(x["v"], "string"))}
        kept = ["v", *held, *(["name"] if named else [])]
        return _let(F.struct(*(x[k].alias(k) for k in kept), *(of[k].alias(k) for k in scalars)), body)

    def with_name(x: Column) -> Column:
        if not named:
            return with_scalars(x)
        return _let(F.struct(*(x[k].alias(k) for k in ("v", *held)), _name(x, held).alias("name")), with_scalars)

    kinds = {"members": "map<string,variant>", "items": "array<variant>"}
    return _let(F.struct(v.alias("v"), *(get(v, kinds[k]).alias(k) for k in held)), with_name)


def _name(x: Column, held: list[str]) -> Column:
    """The name of a value's type, empty for a container that is known to be one."""
    name = F.schema_of_variant(x["v"])
    return F.when(reduce(Column.__or__, (x[k].isNotNull() for k in held)), "").otherwise(name) if held else name


def _same(x: Column, wanted: Any) -> Column:
    """Whether a value with facts ``x`` equals a JSON value; 1 and 1.0 are equal, 1 and true are not."""
    if isinstance(wanted, bool):
        return F.to_json(x["v"]) == json.dumps(wanted)
    if isinstance(wanted, int | float):
        return F.coalesce(x["number"] == float(wanted), F.lit(False))
    if isinstance(wanted, str):
        return F.coalesce(x["text"] == wanted, F.lit(False))
    return F.to_json(x["v"]) == F.to_json(F.parse_json(F.lit(json.dumps(wanted))))


def _typed(x: Column, names: list[str]) -> Column:
    tests = {
        "object": lambda: x["members"].isNotNull(),
        "array": lambda: x["items"].isNotNull(),
        "string": lambda: x["text"].isNotNull(),
        "number": lambda: x["number"].isNotNull(),
        "integer": lambda: F.coalesce(x["number"] == F.floor(x["number"]), F.lit(False)),
        "boolean": lambda: x["name"] == "BOOLEAN",
        "null": lambda: x["name"] == "VOID",
    }
    return reduce(Column.__or__, (tests[n]() if n in tests else F.lit(False) for n in names), F.lit(False))


_FACT_OF_TYPE = {"object": "members", "array": "items", "string": "text", "number": "number", "integer": "number", "boolean": "name", "null": "name"}


def _found(schema: dict, pointer: str) -> Any:
    for token in pointer_tokens(pointer):
        schema = schema[int(token)] if isinstance(schema, list) else schema[token]
    return schema


def _either_null(schema: dict) -> dict:
    return {"anyOf": [{k: v for k, v in schema.items() if k != "nullable"}, {"type": "null"}]}


def _escaped(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


class _Compiler:
    def __init__(self, root: Any):
        self.root = root

    def errors(self, value: Column, schema: Any, path: Column, way: tuple[str, ...] = ()) -> Column:
        """All errors of a variant, in order."""
        if isinstance(schema, bool) or not schema:
            return self.of_facts(value, schema, path, way)
        return _facts(value, self.needs(schema, way), lambda x: self.of_facts(x, schema, path, way))

    def of_facts(self, x: Column, schema: Any, path: Column, way: tuple[str, ...]) -> Column:
        """All errors of a value whose facts, as far as the schema needs them, are ``x``."""
        if schema is True or schema == {}:
            return F.array().cast(ERRORS)
        if schema is False:
            return self.issue(path, "false")
        if schema.get("nullable"):
            return self.of_facts(x, _either_null(schema), path, way)
        parts = [part for word in schema if (part := self.keyword(word, x, schema, path, way)) is not None]
        return F.concat(*(p.cast(ERRORS) for p in parts)) if len(parts) > 1 else parts[0].cast(ERRORS) if parts else F.array().cast(ERRORS)

    def needs(self, schema: Any, way: tuple[str, ...]) -> set[str]:
        """The facts of a value that a schema's keywords look at, those of schemas for the same value included."""
        if isinstance(schema, bool):
            return set()
        if schema.get("nullable"):
            return self.needs(_either_null(schema), way)
        found: set[str] = set()
        for word, arg in schema.items():
            if word == "type":
                found |= {_FACT_OF_TYPE[n] for n in ([arg] if isinstance(arg, str) else arg) if n in _FACT_OF_TYPE}
            elif word in ("enum", "const"):
                values = arg if word == "enum" else [arg]
                found |= {"text" for v in values if isinstance(v, str)} | {"number" for v in values if isinstance(v, int | float) and not isinstance(v, bool)}
            elif word in _LOOKS_AT:
                found.add(_LOOKS_AT[word])
            if word in ("anyOf", "oneOf", "allOf"):
                found = found.union(*(self.needs(s, way) for s in arg))
            elif word in ("not", "if"):
                found = found.union(*(self.needs(s, way) for s in ((arg,) if word == "not" else (arg, schema.get("then", True), schema.get("else", True)))))
            elif word == "dependentSchemas":
                found = found.union(*(self.needs(s, way) for s in arg.values()))
            elif word == "$ref":
                found |= {"members", "items"} if way.count(arg) >= DEEPEST else self.needs(_found(self.root, arg.removeprefix("#")), (*way, arg))
        return found

    def issue(self, path: Column, rule: str) -> Column:
        return F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(ERRORS)

    def when(self, bad: Column, path: Column, rule: str) -> Column:
        return F.when(bad, self.issue(path, rule)).otherwise(F.array().cast(ERRORS))

    def valid(self, x: Column, schema: Any, way: tuple[str, ...]) -> Column:
        return F.size(self.of_facts(x, schema, F.lit(""), way)) == 0

    def matching(self, members: Column, pattern: str) -> Column:
        return F.filter(F.map_entries(members), lambda e: e["key"].rlike(pattern))

    def each(self, entries: Column, schema: Any, path: Column, way: tuple[str, ...]) -> Column:
        """Errors of the values of map entries."""
        return F.flatten(F.transform(entries, lambda e: self.errors(e["value"], schema, F.concat(path, F.lit("/"), _escaped(e["key"])), way)))

    def keyword(self, word: str, x: Column, schema: dict, path: Column, way: tuple[str, ...]) -> Column | None:
        arg, bad = schema[word], lambda test: self.when(F.coalesce(test, F.lit(False)), path, word)
        number, text, items, members = x["number"], x["text"], x["items"], x["members"]
        within = lambda test, found: F.when(test, found).otherwise(F.array().cast(ERRORS))
        simple: dict[str, Callable[[], Column]] = {
            "type": lambda: ~_typed(x, [arg] if isinstance(arg, str) else arg),
            "enum": lambda: ~reduce(Column.__or__, (_same(x, v) for v in arg), F.lit(False)),
            "const": lambda: ~_same(x, arg),
            "minimum": lambda: number < float(arg),
            "maximum": lambda: number > float(arg),
            "exclusiveMinimum": lambda: number <= float(arg),
            "exclusiveMaximum": lambda: number >= float(arg),
            "multipleOf": lambda: F.abs(number / float(arg) - F.round(number / float(arg))) > 1e-9,
            "minLength": lambda: F.length(text) < arg,
            "maxLength": lambda: F.length(text) > arg,
            "pattern": lambda: ~text.rlike(arg),
            "format": lambda: ~formats.has_format(text, arg),
            "minItems": lambda: F.size(items) < arg,
            "maxItems": lambda: F.size(items) > arg,
            "uniqueItems": lambda: (F.size(F.array_distinct(F.transform(items, lambda i: F.to_json(i)))) < F.size(items)) if arg else F.lit(False),
            "minProperties": lambda: F.size(members) < arg,
            "maxProperties": lambda: F.size(members) > arg,
            "not": lambda: self.valid(x, arg, way),
            "anyOf": lambda: ~reduce(Column.__or__, (self.valid(x, s, way) for s in arg)),
            "oneOf": lambda: reduce(Column.__add__, (self.valid(x, s, way).cast("int") for s in arg)) != 1,
        }
        if word in simple:
            # a keyword bars only values of its own kind
            about = next((facts for facts, words in ((text, _OF_TEXT), (items, _OF_ITEMS), (members, _OF_MEMBERS)) if word in words), None)
            return bad(simple[word]() if about is None else about.isNotNull() & simple[word]())
        if word == "allOf":
            return F.concat(*(self.of_facts(x, s, path, way) for s in arg))
        if word == "if":
            then, other = (self.of_facts(x, schema.get(k, True), path, way) for k in ("then", "else"))
            return F.when(self.valid(x, arg, way), then).otherwise(other)
        if word == "$ref":
            if way.count(arg) >= DEEPEST:
                return self.when(members.isNotNull() | items.isNotNull(), path, "depth")
            return self.of_facts(x, _found(self.root, arg.removeprefix("#")), path, (*way, arg))
        if word == "required":
            return within(members.isNotNull(), F.transform(F.filter(F.array(*map(F.lit, arg)).cast("array<string>"), lambda n: ~F.map_contains_key(members, n)), lambda n: F.struct(path.alias("path"), F.lit(word).alias("rule"))))
        if word == "dependentRequired":
            tests = [self.when(F.map_contains_key(members, F.lit(k)) & ~reduce(Column.__and__, (F.map_contains_key(members, F.lit(n)) for n in names), F.lit(True)), path, word) for k, names in arg.items()]
            return within(members.isNotNull(), F.concat(*tests)) if tests else None
        if word == "dependentSchemas":
            tests = [F.when(F.map_contains_key(members, F.lit(k)), self.of_facts(x, s, path, way)).otherwise(F.array().cast(ERRORS)) for k, s in arg.items()]
            return within(members.isNotNull(), F.concat(*tests)) if tests else None
        if word == "properties":
            at = lambda name: F.concat(path, F.lit("/" + name.replace("~", "~0").replace("/", "~1")))
            tests = [F.when(F.map_contains_key(members, F.lit(name)), self.errors(F.try_element_at(members, F.lit(name)), s, at(name), way)).otherwise(F.array().cast(ERRORS)) for name, s in arg.items()]
            return within(members.isNotNull(), F.concat(*tests)) if tests else None
        if word == "patternProperties":
            tests = [self.each(self.matching(members, p), s, path, way) for p, s in arg.items()]
            return within(members.isNotNull(), F.concat(*tests)) if tests else None
        if word == "additionalProperties":
            known, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
            other = lambda e: ~(e["key"].isin(*known) if known else F.lit(False)) & ~reduce(Column.__or__, (e["key"].rlike(p) for p in patterns), F.lit(False))
            rest = F.filter(F.map_entries(members), other)
            return bad(F.size(rest) > 0) if arg is False else within(members.isNotNull(), self.each(rest, arg, path, way))
        if word == "propertyNames":
            names = F.transform(F.map_keys(members), lambda k: self.errors(F.parse_json(F.to_json(F.array(k))), {"items": arg}, path, way))
            return within(members.isNotNull(), F.transform(F.flatten(names), lambda e: F.struct(path.alias("path"), e["rule"].alias("rule"))))
        if word == "prefixItems":
            tests = [F.when(F.size(items) > k, self.errors(F.get(items, k), s, F.concat(path, F.lit(f"/{k}")), way)).otherwise(F.array().cast(ERRORS)) for k, s in enumerate(arg)]
            return within(items.isNotNull(), F.concat(*tests)) if tests else None
        if word == "items":
            skip = len(schema.get("prefixItems", []))
            test = lambda i, k: F.when(k >= skip, self.errors(i, arg, F.concat(path, F.lit("/"), k.cast("string")), way)).otherwise(F.array().cast(ERRORS))
            return within(items.isNotNull(), F.flatten(F.transform(items, test)))
        if word == "contains":
            hits = F.size(F.filter(items, lambda i: F.size(self.errors(i, arg, F.lit(""), way)) == 0))
            return bad((hits < schema.get("minContains", 1)) | (hits > schema["maxContains"] if "maxContains" in schema else F.lit(False)))
        return None


def schema_errors(document: Column, schema: dict | bool) -> Column:
    """Every (path, rule) at which a variant breaks a schema, as an array in the validator's order."""
    found = _Compiler(schema).errors(document, schema, F.lit(""))
    return F.when(document.isNull(), F.array(F.struct(F.lit("").alias("path"), F.lit("document").alias("rule"))).cast(ERRORS)).otherwise(found)


def first_error(document: Column, schema: dict | bool) -> Column:
    """The first (path, rule), null for a valid document."""
    return F.get(schema_errors(document, schema), 0)
