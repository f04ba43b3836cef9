"""JSON pointers (RFC 6901) into variants."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_STATE = "struct<node:variant,issue:string>"


#: The grammar of RFC 6901: tokens of unescaped characters and the two escapes, and indexes without leading zeros.
_TOKEN, _INDEX = r"/((?:[^/~]|~[01])*)", re.compile("0|[1-9][0-9]*", re.ASCII)
_UNESCAPED = {"~0": "~", "~1": "/"}


def pointer_tokens(pointer: str) -> list[str]:
    """The reference tokens of a pointer; raises where it doesn't follow the grammar."""
    if not re.fullmatch(f"(?:{_TOKEN})*", pointer, re.DOTALL):
        raise ValueError(f"not a JSON pointer: {pointer!r}")
    return [re.sub("~[01]", lambda m: _UNESCAPED[m[0]], token) for token in re.findall(_TOKEN, pointer, re.DOTALL)]


def pointer_get(document: Column, pointer: str) -> Column:
    """(node, issue) at a pointer into a variant: the node where it exists, else what stopped the way to it.

    ``issue`` is null for a hit, otherwise "absent", "no index" (a token that can't name an item of an array) or "leaf"
    (the way goes on below a scalar). A null document is absent. Steps are taken one by one, as a numeric token is an index in an array and a key in an object.
    """
    steps = []
    for token in pointer_tokens(pointer):
        strict = _INDEX.fullmatch(token) is not None
        # an index above the range of int can't be in an array
        steps.append(F.struct(F.lit(token).alias("key"), F.lit(strict).alias("strict"), F.lit(int(token) if strict and len(token) < 10 else 2**31 - 1).alias("at")))
    start = F.struct(document.alias("node"), F.when(document.isNull(), "absent").alias("issue")).cast(_STATE)
    if not steps:
        return start
    state = lambda node, issue: F.struct(node.cast("variant").alias("node"), issue.cast("string").alias("issue")).cast(_STATE)
    failed = lambda issue: state(F.lit(None), F.lit(issue))

    def step(now: Column, to: Column) -> Column:
        members, items = (F.try_variant_get(now["node"], "$", f"{kind}variant>") for kind in ("map<string,", "array<"))
        in_object = F.when(F.map_contains_key(members, to["key"]), state(F.try_element_at(members, to["key"]), F.lit(None))).otherwise(failed("absent"))
        in_array = F.when(~to["strict"], failed("no index")).when(to["at"] < F.size(items), state(F.get(items, to["at"]), F.lit(None))).otherwise(failed("absent"))
        return F.when(now["issue"].isNotNull(), now).when(members.isNotNull(), in_object).when(items.isNotNull(), in_array).otherwise(failed("leaf"))

    return F.aggregate(F.array(*steps), start, step)
