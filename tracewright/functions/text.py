"""Column functions on text: normal forms, scrubbing with counts, marker counts, spans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact(col: Column) -> Column:
    """White space runs as one space."""
    return F.trim(F.regexp_replace(col, r"[ \t\r\n\f]+", " "))


def url_key(url: Column) -> Column:
    """Scheme and host in lower case, without query, fragment and trailing slashes."""
    head = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(head, F.regexp_replace(path, "/+$", ""))


def name_words(name: Column, stop: list[str] = ()) -> Column:
    """Lower-cased runs of ASCII letters and digits, without stop words."""
    words = F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]+)"), 1)
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def scrubbed(text: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, list[Column]]:
    """The text after (label, pattern, replacement) rules in order, and each rule's count on the text it was given."""
    counts = []
    for label, pattern, replacement in rules:
        counts.append(F.regexp_count(text, F.lit(pattern)).cast("long").alias(label))
        text = F.regexp_replace(text, pattern, replacement)
    return text, counts


def occurrences(text: Column, marker: str) -> Column:
    """How often a literal occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(marker)))) / len(marker)).cast("long")


def residue(text: Column, markers: list[str]) -> Column:
    return reduce(Column.__add__, (occurrences(text, m) for m in markers))


def char_grams(text: Column, n: int) -> Column:
    """Distinct runs of n characters; none for shorter texts."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, n))
    return F.when(F.length(text) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) - shared > 0, shared / (F.size(a) + F.size(b) - shared)).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """Shared members over the smaller set; 0 if one is empty."""
    return F.when(F.least(F.size(a), F.size(b)) > 0, F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))).otherwise(F.lit(0.0))


def html_title(html: Column) -> Column:
    return compact(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_text(html: Column) -> Column:
    """Visible text, without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    return compact(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def human_bytes(n: Column) -> Column:
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024**2, F.concat(F.floor(n / 1024).cast("string"), F.lit(" KB"))).otherwise(F.concat(F.floor(n / 1024**2).cast("string"), F.lit(" MB")))
