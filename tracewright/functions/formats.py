"""String formats as predicates on text Columns, and small lookups on URLs, names and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(\.{_OCTET}){{3}}"
_LABEL = "[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"


def _ipv6() -> str:
    """Eight groups of which a run may be left out as ``::``; the last two may be written as an IPv4 address."""
    group, tails = "[0-9A-Fa-f]{1,4}", []
    for after in range(8):  # groups behind ::
        last = f"(({group}:){{{after - 1}}}{group}|({group}:){{{after - 2}}}{_IPV4})" if after > 1 else group if after else ""
        before = f"({group}(:{group}){{0,{6 - after}}})?" if after < 7 else ""
        tails.append(f"{before}::{last}")
    return "|".join([f"({group}:){{7}}{group}", f"({group}:){{6}}{_IPV4}", *tails])


#: The formats that a declaration may name, and the patterns of those that a pattern tells.
FORMATS = ("date", "date-time", "time", "duration", "uri", "uuid", "email", "hostname", "ipv4", "ipv6")
_DURATION = r"P(?=\d|T\d)(\d+Y)?(\d+M)?(\d+D)?(T(\d+H)?(\d+M)?(\d+(\.\d+)?S)?)?"
_TIME = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d{1,6})?)?)?(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d)?)?)?"
_DATE = r"\d{4}-\d{2}-\d{2}"


def _whole(pattern: str) -> str:
    return rf"^({pattern})\z"


def has_format(text: Column, name: str) -> Column:
    """Whether a text has a format; null for null."""
    is_day = lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull()
    if name == "date":
        return text.rlike(_whole(_DATE)) & is_day(text)
    if name == "date-time":
        return text.rlike(_whole(rf"{_DATE}([T ]{_TIME})?")) & is_day(F.substring(text, 1, 10))
    if name == "time":
        return text.rlike(_whole(_TIME))
    if name == "uuid":
        bare = F.regexp_replace(F.regexp_replace(text, "urn:|uuid:", ""), "^[{}]+|[{}]+$", "")
        return F.regexp_replace(bare, "-", "").rlike(_whole("[0-9A-Fa-f]{32}"))
    if name == "uri":
        return text.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:[^?#\s]")
    patterns = {"duration": _DURATION, "email": r"[^@\s]+@[^@\s]+\.[^@\s]+", "hostname": rf"(?=.{{1,253}}\z)({_LABEL}\.)*{_LABEL}", "ipv4": _IPV4, "ipv6": _ipv6()}
    return text.rlike(_whole(patterns[name]))


#: Hosts that serve repositories, the number of path parts from which a revision is named, and where it is.
REVISIONS = {"raw.githubusercontent.com": (3, "third"), "github.com": (4, "by kind"), "codeload.github.com": (4, "last"), "api.github.com": (1, "query")}
ARCHIVES = (".zip", ".tar.gz")


def url_stability(url: Column) -> Column:
    """Whether what a repository URL names can change: ``immutable_repository`` if its revision is a commit of 40 hex digits,
    ``mutable_repository`` if it is anything else; null where the host or the path names no revision."""
    split = lambda k: F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(?:\?([^#]*))?", k)
    host, parts, query = F.lower(split(1)), F.filter(F.split(split(2), "/"), lambda p: p != ""), split(3)
    last = F.element_at(parts, -1)
    for suffix in ARCHIVES:
        last = F.regexp_replace(last, suffix.replace(".", r"\.") + "$", "")
    ref = F.filter(F.split(query, "&"), lambda q: q.startswith("ref=") & (q != "ref="))
    found = {
        "third": F.try_element_at(parts, F.lit(3)),
        "by kind": F.when(F.try_element_at(parts, F.lit(3)).isin("raw", "blob"), F.try_element_at(parts, F.lit(4))).when(F.try_element_at(parts, F.lit(3)) == "archive", last),
        "last": F.element_at(parts, -1),
        "query": F.when(F.get(parts, 0) == "repos", F.url_decode(F.substring(F.get(ref, 0), 5, 1 << 20))),
    }
    revision = F.lit(None).cast("string")
    for name, (least, where) in REVISIONS.items():
        revision = F.when((host == name) & (F.size(parts) >= least), found[where]).otherwise(revision)
    return F.when(revision.rlike("^[0-9a-fA-F]{40}$"), "immutable_repository").when(revision.isNotNull(), "mutable_repository")


def safe_relative(path: Column) -> Column:
    """Whether a path stays below its root: not empty, not absolute, no .. or empty part, no backslash."""
    return (path != "") & ~path.rlike(r"^[/~]|^[A-Za-z]:|\\|(^|/)\.\.(/|$)|//|(^|/)\.(/|$)")


def resource_scope(uri: Column) -> Column:
    """(scope, path) of an ``aw://scope/path`` URI; null unless the path is safe."""
    scope, path = F.regexp_extract(uri, "^aw://([a-z][a-z0-9_]*)/(.+)$", 1), F.regexp_extract(uri, "^aw://([a-z][a-z0-9_]*)/(.+)$", 2)
    return F.when((scope != "") & safe_relative(path), F.struct(scope.alias("scope"), path.alias("path")))


#: Hertz for each unit.
HERTZ = {"hz": 1.0, "khz": 1e3, "mhz": 1e6, "ghz": 1e9, "thz": 1e12}


def in_hertz(text: Column) -> Column:
    """The number of hertz that a text like "2.4 GHz" tells; null where it tells none."""
    number = F.regexp_extract(text, r"^\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\s*([A-Za-z]+)\s*$", 1)
    unit = F.lower(F.regexp_extract(text, r"^\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\s*([A-Za-z]+)\s*$", 2))
    factors = F.create_map(*(F.lit(x) for pair in HERTZ.items() for x in pair))
    return F.try_multiply(F.nullif(number, F.lit("")).try_cast("double"), F.try_element_at(factors, unit))


def runtime_cache_path(path: Column) -> Column:
    """Whether a path belongs to an interpreter's caches."""
    return path.rlike(r"(^|/)__pycache__(/|$)|\.py[co]$")


def mapped_names(text: Column, names: dict[str, str]) -> Column:
    """A text with tool names replaced, longer ones first, so that no name is cut by a shorter one."""
    for old in sorted(names, key=lambda n: (-len(n), n)):
        text = F.replace(text, F.lit(old), F.lit(names[old]))
    return text


def unresolved_paths(text: Column, prefixes: list[str], allowed: list[str]) -> Column:
    """Distinct absolute paths under ``prefixes`` that no allowed root begins, sorted."""
    found = F.regexp_extract_all(text, F.lit(r"((?:" + "|".join(p.replace(".", r"\.") for p in prefixes) + r")[^\s\"'<>|]*)"), 1)
    return F.array_sort(F.array_distinct(F.filter(found, lambda p: ~_any(F.startswith(p, F.lit(a)) for a in allowed))))


def _any(checks) -> Column:
    out = F.lit(False)
    for c in checks:
        out = out | c
    return out


def relevance(query: Column, name: Column, description: Column) -> Column:
    """100 where the query's words hold the name, 8 for each word shared with the name's parts, 1 for each with the description."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""))
    hit = F.array_contains(words(query), F.lower(name))
    shared = lambda c: F.size(F.array_intersect(words(query), words(c)))
    return F.when(hit, 100).otherwise(0) + 8 * shared(name) + shared(description)


def character_sum(text: Column) -> Column:
    """The sum of a text's code points: a tie-break that doesn't depend on order."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda s, c: s + F.ascii(c))
