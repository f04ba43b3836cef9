"""URL filters by a temporal list join: every capture is judged by the list entries active when it was fetched.

List events (dated additions and removals of an entry: a domain, or a host with a path) become validity intervals
[from, until) with ``lead`` over each entry's own events; a capture matches an entry of its host, of any parent domain,
or of its host and path, whose interval holds the fetch time (an as-of join). The captures are exploded to these few
keys and joined on the entry; as one host can hold a third of the captures, the join key carries a salt, with the list
side repeated for every salt. The list side is broadcast only within ``BROADCAST_ROWS`` and ``BROADCAST_BYTES``; else
the join is a merge, as Spark would take the salted list for as small as its file and broadcast it. The
longest active entry is taken per capture: per id, url and fetch time, so captures that share an id are judged apart.

Nulls and oddities: a null or hostless url has no key and no match (kept, reason null); a null fetch time matches
nothing; a null id is like any other. Repeated captures get a row each with equal answers. Very long urls are keys like
others. Events of one entry at one instant: the last by (action) order wins, repeated events count once. A removal
without an addition opens nothing. Empty captures give an empty result; an empty list keeps everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SALTS = 16
BROADCAST_ROWS, BROADCAST_BYTES = 10_000, 4_000_000
#: A fixed policy list: (entry, action, date). A domain covers its subdomains.
LIST_EVENTS = [
    ("casino-win.example.com", "add", "2024-01-05"),
    ("casino-win.example.com", "remove", "2024-02-10"),
    ("casino-win.example.com", "add", "2024-03-01"),
    ("cheap-pills.example.com", "add", "2024-01-20"),
    ("www.cheap-pills.example.com", "add", "2024-02-20"),
    ("www.cheap-pills.example.com", "remove", "2024-02-25"),
    ("tionsh.example.com", "add", "2024-02-01"),
    ("tionsh.example.net", "add", "2024-02-01"),
    ("blog.tionsh.example.net", "add", "2024-02-15"),
    ("blog.tionsh.example.net", "remove", "2024-02-20"),
    ("tionsh.example.com", "remove", "2024-03-10"),
    ("tionsh.example.net", "remove", "2024-03-10"),
    ("tionble.example.org", "add", "2024-01-01"),
    ("tionble.example.org", "remove", "2024-01-31"),
    ("example.net", "add", "2024-03-20"),
]
FETCH_START = "2024-01-01 00:00:00"
FETCH_STEP_SECONDS = 475_141
FETCH_DAYS = 90
#: The feed's listings: the n-th page's from day ``FEED_STEP_DAYS * n`` of the period, for five days and more.
FEED_STEP_DAYS, FEED_LEAST_DAYS, FEED_SPREAD_DAYS = 37, 5, 17


def host_of(url: Column) -> Column:
    """The lower-cased host of an absolute URL, without user, port or trailing dots; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """The path of an absolute URL, without query and fragment; empty where there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""
    parts = F.split(host, r"\.")
    return F.when(F.size(parts) < 2, F.array(host)).otherwise(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))


def entries_of(host: Column, path: Column) -> Column:
    """The entries that cover a URL, should they be listed."""
    return F.when(F.length(path) > 1, F.array_append(suffixes(host), F.concat(host, path))).otherwise(suffixes(host))


def validity(events: DataFrame) -> DataFrame:
    """(domain, valid_from, valid_until) of each addition, up to the entry's next event; null: still active."""
    events = events.where("domain IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    instants = events.groupBy("domain", "at").agg(F.max("action").alias("action"))
    changes = Window.partitionBy("domain").orderBy("at")
    lined = instants.withColumn("before", F.lag("action").over(changes)).where("before IS NULL OR before <> action")
    lined = lined.withColumn("valid_until", F.lead("at").over(changes))
    return lined.where("action = 'add'").select("domain", F.col("at").alias("valid_from"), "valid_until")


def as_of(captures: DataFrame, lists: DataFrame, id_col: str, salts: int = SALTS) -> DataFrame:
    """Per capture the longest listed entry active at its fetch time, and since when; null where there is none.

    ``captures``: id, url, fetched_at; ``lists``: the output of ``validity``.
    """
    one = [id_col, "url", "fetched_at"]
    captures = captures.withColumn("host", host_of(F.col("url")))
    keyed = captures.where("host IS NOT NULL AND fetched_at IS NOT NULL").select(*one, F.explode(entries_of(F.col("host"), path_of(F.col("url")))).alias("domain"), F.pmod(F.xxhash64(*one), F.lit(salts)).alias("salt"))
    rows, size = lists.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length("domain")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(lists), "domain")
    else:
        salted = lists.withColumn("salt", F.explode(F.array(*(F.lit(k).cast("long") for k in range(salts)))))
        joined = keyed.join(salted.hint("merge"), ["domain", "salt"])
    active = joined.where("fetched_at >= valid_from AND (valid_until IS NULL OR fetched_at < valid_until)")
    best = active.groupBy(*one).agg(F.max(F.struct(F.length("domain").alias("n"), "domain", "valid_from")).alias("hit"))
    best = best.select(*(F.col(c).alias(f"same_{k}") for k, c in enumerate(one)), F.col("hit.domain").alias("listed_domain"), F.col("hit.valid_from").alias("listed_since"))
    same = [F.col(c).eqNullSafe(F.col(f"same_{k}")) for k, c in enumerate(one)]
    return captures.join(best.hint("merge"), same, "left").drop(*(f"same_{k}" for k in range(len(one))))


def list_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LIST_EVENTS, "domain string, action string, day string").select("domain", "action", F.to_timestamp_ntz("day").alias("at"))


def _days(n: Column) -> Column:
    return F.to_timestamp_ntz(F.lit(FETCH_START)) + F.make_dt_interval(days=n.cast("int"))


def feed_events(pages: DataFrame) -> DataFrame:
    """A feed as large as the pages: every page's host and path is listed for some days of the fetch period."""
    paths = pages.select("page_id", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("domain")).where("domain IS NOT NULL AND page_id IS NOT NULL")
    added = F.pmod(F.col("page_id") * FEED_STEP_DAYS, F.lit(FETCH_DAYS))
    removed = added + FEED_LEAST_DAYS + F.pmod(F.col("page_id"), F.lit(FEED_SPREAD_DAYS))
    events = F.array(F.struct(F.lit("add").alias("action"), _days(added).alias("at")), F.struct(F.lit("remove").alias("action"), _days(removed).alias("at")))
    return paths.select("domain", F.inline(events))


def fetch_time(page_id: Column) -> Column:
    """The pages table has no fetch time; the query takes one that spreads ids over 90 days."""
    return F.to_timestamp_ntz(F.lit(FETCH_START)) + F.make_interval(secs=F.pmod(page_id * FETCH_STEP_SECONDS, F.lit(FETCH_DAYS * 86400)).cast("decimal(18,6)"))


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    lists = written(validity(list_events(spark).unionByName(feed_events(pages))), "lists")
    judged = as_of(pages.withColumn("fetched_at", fetch_time(F.col("page_id"))), lists, "page_id")
    return judged.select("page_id", "url", "host", "fetched_at", "listed_domain", "listed_since", F.col("listed_domain").isNull().alias("kept"))


_VALUES = ",\n    ".join(f"('{d}', '{a}', TIMESTAMP '{t}')" for d, a, t in LIST_EVENTS)
_HOST = "nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '[.]+$', ''), '')"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_ADDED = f"(page_id * {FEED_STEP_DAYS}) % {FETCH_DAYS}"
SQL = f"""
WITH captures AS (SELECT row_number() OVER () AS capture, page_id, url, {_HOST} AS host, {_PATH} AS path,
  TIMESTAMP '{FETCH_START}' + to_seconds((page_id * {FETCH_STEP_SECONDS}) % {FETCH_DAYS * 86400}) AS fetched_at FROM pages),
events(domain, action, moment) AS (VALUES
    {_VALUES}
  UNION ALL SELECT host || path, 'add', TIMESTAMP '{FETCH_START}' + to_days(CAST({_ADDED} AS INT)) FROM captures WHERE host IS NOT NULL
  UNION ALL SELECT host || path, 'remove', TIMESTAMP '{FETCH_START}' + to_days(CAST({_ADDED} + {FEED_LEAST_DAYS} + page_id % {FEED_SPREAD_DAYS} AS INT)) FROM captures WHERE host IS NOT NULL),
instants AS (SELECT domain, moment, max(action) AS action FROM events GROUP BY domain, moment),
changes AS (SELECT *, lag(action) OVER (PARTITION BY domain ORDER BY moment) AS before FROM instants),
lined AS (SELECT domain, action, moment, lead(moment) OVER (PARTITION BY domain ORDER BY moment) AS until FROM changes WHERE before IS NULL OR before <> action),
lists AS (SELECT domain, moment AS since, until FROM lined WHERE action = 'add'),
hits AS (SELECT c.capture, l.domain, l.since, row_number() OVER (PARTITION BY c.capture ORDER BY length(l.domain) DESC) AS k
  FROM captures c JOIN lists l ON (c.host = l.domain OR ends_with(c.host, '.' || l.domain) OR (length(c.path) > 1 AND c.host || c.path = l.domain))
  AND c.fetched_at >= l.since AND (l.until IS NULL OR c.fetched_at < l.until))
SELECT c.page_id, c.url, c.host, c.fetched_at, h.domain AS listed_domain, h.since AS listed_since, h.domain IS NULL AS kept
FROM captures c LEFT JOIN hits h ON c.capture = h.capture AND h.k = 1
"""
