"""Scrubbing, normal forms, duplicates and spans over documents, pages and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import text as ft
from tracewright.functions.pointers import pointer_get
from tracewright.operators import ranking, spans
from tracewright.session import table

_RULES = [("emails", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+", "<email>"), ("numbers", "[0-9]+", "0"), ("pipes", "[|]+", "/")]


def path_scrub_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, counts = ft.scrubbed(F.col("text"), _RULES)
    return table(spark, sf_dir, "documents").select("doc_id", *counts, F.sha2(cleaned, 256).alias("cleaned_sha256"))


def marker_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *(ft.occurrences(F.col("text"), m).alias(n) for n, m in (("amp", "&&&"), ("the", "the"), ("bars", "|"))))


def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", ft.url_key(F.col("url")).alias("url_key"))


def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.array_join(ft.name_words(F.col("p_name"), ["the", "red"]), " ").alias("words"), ft.slug(F.col("p_brand")).alias("slug"))


def html_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", ft.html_title(F.col("html")).alias("title"), F.substring(ft.html_text(F.col("html")), 1, 360).alias("preview"))


def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return groups.where("n > 1")


def ledger_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each content, with the sources it came from."""
    docs = table(spark, sf_dir, "documents")
    grouped = docs.groupBy(F.sha2("text", 256).alias("sha256")).agg(F.sort_array(F.collect_set("source")).alias("sources"), F.min("doc_id").alias("first_id"))
    return grouped.select("sha256", "first_id", F.array_join("sources", "|").alias("sources"))


def near_duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of distinct part names with 5-gram Jaccard of 0.5 or more; candidates share one of their rarest grams."""
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id")).select("id", F.lower("p_name").alias("name"))
    return spans.similar_pairs(names, "id", "name", 5, 0.5)


def sentence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many characters of documents their first sentences leave uncovered; the spans overlap."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    length = F.length("text")
    some = F.array(*(F.struct(F.least(F.lit(a), length).alias("start"), F.least(F.lit(b), length).alias("end")) for a, b in ((0, 40), (30, 90), (30, 90), (200, 260))))
    return spans.uncovered(docs, docs.select("doc_id", F.inline(some)).where("start < end"), "doc_id", "text")


def subject_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", F.lit("seed").alias("origin")), table(spark, sf_dir, "labels").select("doc_id", F.lit("labels").alias("origin"))
    return documents.unionByName(labels).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("origin")), "+").alias("origins"))


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample without replacement that the seed and the ids decide (the sampling operator's own limit)."""
    order = F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")).cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang").orderBy(order, "doc_id").limit(50)


def best_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best label of each document by rank, kept for unlabelled ones as well."""
    labels = table(spark, sf_dir, "labels").withColumn("rank", F.col("quality") * 2 + (1 - F.col("toxic")))
    best = ranking.first_per_group(labels, ["doc_id"], [F.col("rank").desc(), F.col("quality").desc()])
    return table(spark, sf_dir, "documents").select("doc_id").join(best.select("doc_id", "rank"), "doc_id", "left")


def json_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return props.select("event_id", F.expr("schema_of_variant(v) IS NOT NULL").alias("is_json"), F.expr("size(map_keys(from_json(to_json(v), 'map<string,string>')))").cast("long").alias("n_keys"))


def json_pointer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pointers find that hit, miss and traverse a scalar."""
    props = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    found = {n: pointer_get(F.col("v"), p) for n, p in (("hit", "/k"), ("miss", "/~0k~1"), ("crossed", "/k/0"))}
    return props.select("event_id", *(c for n, f in found.items() for c in (F.to_json(f["node"]).alias(n), f["issue"].alias(f"{n}_issue"))))


QUERIES = {f.__name__: f for f in (path_scrub_counts, marker_residue, url_normalise, name_normalise, html_summary, exact_duplicate_groups, ledger_dedupe, near_duplicate_names, sentence_coverage, subject_universe, seeded_sample, best_evidence, json_key_counts, json_pointer_values)}

_S1 = "regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+', '<email>', 'g')"
_S2 = f"regexp_replace({_S1}, '[0-9]+', '0', 'g')"
_GRAMS = "SELECT id, name, list_distinct([substr(name, i, 5) FOR i IN range(1, length(name) - 3)]) AS grams FROM (SELECT min(p_partkey) AS id, lower(p_name) AS name FROM part GROUP BY p_name)"

ORACLE_SQL = {
    "path_scrub_counts": f"SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+')) AS BIGINT) AS emails, CAST(len(regexp_extract_all({_S1}, '[0-9]+')) AS BIGINT) AS numbers, CAST(len(regexp_extract_all({_S2}, '[|]+')) AS BIGINT) AS pipes, sha256(regexp_replace({_S2}, '[|]+', '/', 'g')) AS cleaned_sha256 FROM documents",
    "marker_residue": "SELECT doc_id, " + ", ".join(f"CAST((length(text) - length(replace(text, '{m}', ''))) // {len(m)} AS BIGINT) AS {n}" for n, m in (("amp", "&&&"), ("the", "the"), ("bars", "|"))) + " FROM documents",
    "url_normalise": "SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS url_key FROM pages",
    "name_normalise": "SELECT p_partkey, array_to_string(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda w: w NOT IN ('the', 'red')), ' ') AS words, regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part",
    "html_summary": r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[ \t\r\n\f]+', ' ', 'g')) AS title, substr(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n\f]+', ' ', 'g')), 1, 360) AS preview FROM pages",
    "exact_duplicate_groups": "SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "ledger_dedupe": "SELECT sha256(text) AS sha256, min(doc_id) AS first_id, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM documents GROUP BY 1",
    "near_duplicate_names": f"WITH g AS ({_GRAMS}) SELECT a.id AS a, b.id AS b, CAST(len(list_intersect(a.grams, b.grams)) AS BIGINT) AS shared, CAST(len(a.grams) + len(b.grams) - len(list_intersect(a.grams, b.grams)) AS BIGINT) AS united FROM g a JOIN g b ON a.id < b.id WHERE len(list_intersect(a.grams, b.grams)) >= 0.5 * (len(a.grams) + len(b.grams) - len(list_intersect(a.grams, b.grams))) AND len(list_intersect(a.grams, b.grams)) > 0",
    "sentence_coverage": r"SELECT doc_id, CAST((length(text) > 0)::INT + 2 * (length(text) > 30)::INT + (length(text) > 200)::INT AS BIGINT) AS n_spans, CAST(length(regexp_replace(substring(text, 91, 110) || substring(text, 261), '[ \t\r\n\f\x0B]', '', 'g')) AS BIGINT) AS uncovered FROM documents",
    "subject_universe": "SELECT doc_id, string_agg(DISTINCT origin, '+' ORDER BY origin) AS origins FROM (SELECT doc_id, 'seed' AS origin FROM documents UNION ALL SELECT doc_id, 'labels' FROM labels) GROUP BY doc_id",
    "seeded_sample": "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50",
    "best_evidence": "SELECT d.doc_id, l.rank FROM documents d LEFT JOIN (SELECT doc_id, max(quality * 2 + 1 - toxic) AS rank FROM labels GROUP BY doc_id) l USING (doc_id)",
    "json_key_counts": "SELECT event_id, json_valid(props) AS is_json, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events",
    "json_pointer_values": "SELECT event_id, " + ", ".join(f"CAST(json_extract(props, '{p}') AS VARCHAR) AS {n}, CASE WHEN json_type(props, '{p}') IS NOT NULL THEN NULL WHEN json_type(props, '{up}') IN ('OBJECT', 'ARRAY') THEN 'absent' ELSE 'leaf' END AS {n}_issue" for n, p, up in (("hit", "/k", ""), ("miss", "/~0k~1", ""), ("crossed", "/k/0", "/k"))) + " FROM events",
}
