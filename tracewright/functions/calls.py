"""Column functions on tool calls: kinds, outputs, failures, usage, identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How an output was encoded.
ENCODINGS = ("empty", "wrapped", "json", "text")


def kind_of(name: Column, kinds: dict[str, list[str]], other: str) -> Column:
    """The kind whose list holds the name."""
    found = reduce(lambda c, item: c.when(name.isin(*item[1]), item[0]), kinds.items(), F.when(F.lit(False), F.lit("")))
    return found.otherwise(other)


def output_encoding(raw: Column) -> Column:
    """Nothing, ``<output>...</output>`` around a payload, JSON, or plain text."""
    return F.when(raw.isNull() | (F.trim(raw) == ""), "empty").when(raw.rlike("(?s)^<output>.*</output>$"), "wrapped").when(F.try_parse_json(raw).isNotNull(), "json").otherwise("text")


def output_payload(raw: Column) -> Column:
    return F.when(output_encoding(raw) == "wrapped", F.regexp_extract(raw, "(?s)^<output>(.*)</output>$", 1)).otherwise(raw)


def payload_error(raw: Column) -> Column:
    """True where a wrapped payload ought to be JSON and is none."""
    return (output_encoding(raw) == "wrapped") & F.try_parse_json(output_payload(raw)).isNull()


def is_failure(code: Column, message: Column, codes: list[int], markers: list[str]) -> Column:
    """By code, or by a marker in the lower-cased message; timeouts are a class of their own."""
    lowered = F.lower(F.coalesce(message, F.lit("")))
    marked = reduce(Column.__or__, (F.contains(lowered, F.lit(m)) for m in markers))
    return (F.coalesce(code.isin(*codes), F.lit(False)) | marked) & ~is_timeout(message)


def is_timeout(message: Column) -> Column:
    return F.contains(F.lower(F.coalesce(message, F.lit(""))), F.lit("timed out"))


def usage(raw: Column) -> tuple[Column, Column, Column]:
    """(input, cached input, output) tokens of either dialect of usage JSON."""
    pick = lambda *paths: F.coalesce(*(F.get_json_object(raw, p).cast("long") for p in paths))
    return pick("$.input_tokens", "$.prompt_tokens"), pick("$.input_tokens_details.cached_tokens", "$.prompt_tokens_details.cached_tokens"), pick("$.output_tokens", "$.completion_tokens")


def request_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", *parts), 256)


def source_id(training_id: Column) -> Column:
    """The id before a window's suffix."""
    return F.substring_index(training_id, "::compaction_", 1)


def close(a: Column, b: Column, absolute: float, relative: float) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(absolute), relative * F.greatest(F.abs(a), F.abs(b)))
