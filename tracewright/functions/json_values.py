"""JSON text as values: canonical form, leaves, search, extraction from free text, summaries, bounded results.

Recursion over JSON of unknown shape is outside Column expressions, so these are small helpers in Arrow UDFs, a batch of
texts at a time. Nulls and texts that are no JSON give null (or no rows); empty tables give empty results.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$")
_THINK = re.compile(r"<think>.*?</think>", re.S)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("?)|[{}\[\]]', re.S)
_CLOSING = {"{": "}", "[": "]"}
#: What no JSON gives; a singleton, so that it stays itself in a worker.
MISSING = ...


def _refused(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def parsed(text: str | None) -> Any:
    """The value of strict JSON (no NaN, no infinities), or ``MISSING``."""
    if text is None:
        return MISSING
    try:
        return json.loads(text, parse_constant=_refused)
    except (ValueError, RecursionError):
        return MISSING


def canonical(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _udf(kind: str, of: Callable[[Any], Any], reads: Callable[[str | None], Any] = parsed) -> Callable[[Column], Column]:
    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        values = (reads(x) for x in texts.to_pylist())
        return pa.array([None if v is MISSING else of(v) for v in values], pa.int64() if kind == "long" else pa.string())

    return run


def canonical_json(text: Column) -> Column:
    """Sorted keys, no spaces, characters unescaped; numbers as written by the type they have (1 and 1.0 differ)."""
    return _udf("string", canonical)(text)


def type_name(text: Column) -> Column:
    """object, array, string, integer, number, boolean or null."""
    names = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}
    return _udf("string", lambda v: names[type(v)])(text)


def pointers(value: Any, at: str = "") -> Iterator[tuple[str, Any]]:
    """(pointer, value) of every leaf; empty containers are leaves."""
    stack = [(at, value)]
    while stack:
        at, value = stack.pop()
        if isinstance(value, dict) and value:
            stack += [(f"{at}/{k.replace('~', '~0').replace('/', '~1')}", v) for k, v in reversed(value.items())]
        elif isinstance(value, list) and value:
            stack += [(f"{at}/{k}", v) for k, v in reversed(list(enumerate(value)))]
        else:
            yield at, value


def leaves(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, pointer, value) of every leaf of a JSON column; ``value`` is canonical JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, values = [], [], []
            for k, x in enumerate(batch.column(len(keys)).to_pylist()):
                value = parsed(x)
                for pointer, leaf in pointers(value) if value is not MISSING else ():
                    rows.append(k)
                    at.append(pointer)
                    values.append(canonical(leaf))
            own = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(at, pa.string()), pa.array(values, pa.string())], names=[*keys, "pointer", "value"])

    chosen = df.select(*keys, F.col(text).cast("string"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keys)]]
    return chosen.mapInArrow(run, ", ".join([*kinds, "pointer string, value string"]))


def pointers_to(leaf_rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, value, pointers): where each wanted (keys, value) stands among the leaves."""
    found = leaf_rows.join(wanted.select(*keys, "value").distinct(), [*keys, "value"])
    return found.groupBy(*keys, "value").agg(F.array_join(F.array_sort(F.collect_list("pointer")), ",").alias("pointers"))


def first_object(text: str | None) -> Any:
    """The first JSON object in free text, or ``MISSING``.

    Thoughts and fences go; text around the object too. Missing closing marks at the end are added and raw control
    characters in strings allowed; nothing else is mended, and an array on top is no object.
    """
    if text is None:
        return MISSING
    body = _FENCE.sub("", _THINK.sub("", text).strip())
    start = body.find("{")
    if body.startswith("[") or start < 0:
        return MISSING
    opened: list[str] = []
    end, tail = len(body), ""
    for token in _TOKEN.finditer(body, start):
        mark = token[0]
        if mark in _CLOSING:
            opened.append(_CLOSING[mark])
        elif mark[0] == '"':
            tail = "" if token[1] else '"'
        elif not opened or opened.pop() != mark:
            return MISSING
        elif not opened:
            end = token.end()
            break
    try:
        value = json.loads(body[start:end] + tail + "".join(reversed(opened)), strict=False, parse_constant=_refused)
    except (ValueError, RecursionError):
        return MISSING
    return value if isinstance(value, dict) else MISSING


def object_in_text(text: Column) -> Column:
    """The first JSON object of free text in canonical form; null where there is none."""
    return _udf("string", canonical, first_object)(text)


def first_value(text: str | None) -> Any:
    """The first JSON object or array that stands in a text as such, or ``MISSING``."""
    decoder = json.JSONDecoder(parse_constant=_refused)
    for at in re.finditer(r"[{\[]", text or ""):
        try:
            return decoder.raw_decode(text, at.start())[0]
        except (ValueError, RecursionError):
            continue
    return MISSING


def value_in_text(text: Column) -> Column:
    return _udf("string", canonical, first_value)(text)


def summed(text: Column, names: tuple[str, ...]) -> Column:
    """Canonical JSON of the sums of integers stored under these names anywhere in the value."""

    def of(value: Any) -> str:
        totals: Counter = Counter()
        stack = [value]
        while stack:
            node = stack.pop()
            items = node.items() if isinstance(node, dict) else ((None, x) for x in node) if isinstance(node, list) else ()
            for key, x in items:
                if key in names and type(x) is int:
                    totals[key] += x
                elif isinstance(x, dict | list):
                    stack.append(x)
        return canonical(dict(totals))

    return _udf("string", of)(text)


def container_summary(text: Column) -> Column:
    """Canonical JSON of the root's type, its size, its keys or its items' keys, and the longest array in it."""

    def of(value: Any) -> str:
        longest, stack = 0, [value]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                longest = max(longest, len(node))
            stack += node.values() if isinstance(node, dict) else node if isinstance(node, list) else ()
        keyed = value if isinstance(value, dict) else value[0] if isinstance(value, list) and value and isinstance(value[0], dict) else {}
        size = len(value) if isinstance(value, dict | list) else None
        return canonical({"type": {dict: "object", list: "array"}.get(type(value), "scalar"), "size": size, "keys": sorted(keyed), "longest": longest})

    return _udf("string", of)(text)


def _compact(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _measured(value: Any) -> tuple[int, Any]:
    """(bytes as compact JSON, the value with its parts measured likewise): one pass from below."""
    if isinstance(value, dict):
        parts = {k: _measured(v) for k, v in value.items()}
        return 2 + sum(len(_compact(k).encode()) + 1 + size for k, (size, _) in parts.items()) + max(0, len(parts) - 1), parts
    if isinstance(value, list):
        parts = [_measured(v) for v in value]
        return 2 + sum(size for size, _ in parts) + max(0, len(parts) - 1), parts
    return len(_compact(value).encode()), value


def _plain(node: tuple[int, Any]) -> Any:
    _, value = node
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else [_plain(v) for v in value] if isinstance(value, list) else value


def _fitted(node: tuple[int, Any], room: int) -> Any:
    """The value in at most ``room`` bytes of JSON, or ``MISSING`` where not even a mark fits.

    Strings keep a head. Arrays keep their first items as long as they fit. Members of an object share the room: small
    ones stay whole, and what these leave is dealt evenly to the others.
    """
    size, value = node
    if size <= room:
        return _plain(node)
    if isinstance(value, str):
        left = room - len(_compact({"cut_string": "", "bytes": len(value.encode())}).encode())
        ends, used = 0, 0
        for c in value:
            used += len(_compact(c).encode()) - 2
            if used > left:
                break
            ends += 1
        return {"cut_string": value[:ends], "bytes": len(value.encode())} if left >= 0 else MISSING
    if isinstance(value, list):
        left = room - len(_compact({"cut_array": [], "items": len(value)}).encode())
        kept, used = 0, 0
        for k, (part, _) in enumerate(value):
            used += part + (k > 0)
            if used > left:
                break
            kept += 1
        return {"cut_array": [_plain(v) for v in value[:kept]], "items": len(value)} if left >= 0 else MISSING
    if isinstance(value, dict):
        left = room - 1 - sum(len(_compact(k).encode()) + 2 for k in value)
        shares, open_ = {}, sorted(value, key=lambda k: value[k][0])
        for n, k in enumerate(open_):
            shares[k] = min(value[k][0], left // (len(open_) - n))
            left -= shares[k]
        parts = {k: _fitted(v, shares[k]) for k, v in value.items()}
        if all(p is not MISSING for p in parts.values()):
            return parts
        mark = {"cut_object": len(value)}
        return mark if len(_compact(mark).encode()) <= room else MISSING
    return MISSING


def bounded(text: Column, most: int) -> Column:
    """Compact JSON of at most ``most`` UTF-8 bytes: values that are larger are cut, and tell how much they were; null
    where no mark of a cut fits."""

    def of(value: Any) -> str | None:
        found = _fitted(_measured(value), most)
        return None if found is MISSING else _compact(found)

    return _udf("string", of)(text)


_ENUM_TYPES = ((bool, "boolean"), (int, "number"), (float, "number"), (str, "string"), (type(None), "null"))


def _typed_enums(schema: Any) -> Any:
    if isinstance(schema, list):
        return [_typed_enums(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: v if k in ("enum", "const", "default", "examples") else _typed_enums(v) for k, v in schema.items()}
    values = out.get("enum")
    if isinstance(values, list):
        groups: dict[str, list] = {}
        for v in values:
            name = next((n for kind, n in _ENUM_TYPES if isinstance(v, kind)), None)
            if name is None:
                return out
            groups.setdefault(name, []).append(v)
        if len(groups) > 1:
            rest = {k: v for k, v in out.items() if k not in ("enum", "type")}
            return {**rest, "anyOf": [{"type": n, "enum": v} for n, v in groups.items()]}
    return out


def typed_enums(text: Column) -> Column:
    """Canonical JSON of a schema whose enums of mixed types are split into one branch a type."""
    return _udf("string", lambda v: canonical(_typed_enums(v)))(text)


def without_keys(text: Column, names: tuple[str, ...]) -> Column:
    """Canonical JSON without the members of these names, at any depth."""

    def drop(value: Any) -> Any:
        if isinstance(value, dict):
            return {k: drop(v) for k, v in value.items() if k not in names}
        return [drop(v) for v in value] if isinstance(value, list) else value

    return _udf("string", lambda v: canonical(drop(v)))(text)
