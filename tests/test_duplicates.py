"""Duplicate texts against the reference's normal form and brute force."""

from __future__ import annotations

import random
import unicodedata

import duckdb

from tests import prose as fx
from tracewright.operators import duplicates
from tracewright.plans import duplicate_queries


def form(text):
    return "".join(c for c in unicodedata.normalize("NFKC", text).casefold() if c.isalnum() or c == "#")


def test_equal_texts_share_a_class_whatever_their_quotes_accents_widths_and_case(spark):
    pairs = [("He said “no” – twice", 'he said "no" - TWICE'), ("café crème", "café crème"), ("ＡＢＣ １２", "abc 12"), ("Die Straße", "DIE STRASSE")]
    rows = [(2 * k + j, t) for k, pair in enumerate(pairs) for j, t in enumerate(pair)] + [(20, "abc 7"), (21, "abc ٣")]
    got = {r.id: r for r in duplicates.duplicate_classes(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert [got[k].exact_id for k in range(8)] == [0, 0, 2, 2, 4, 4, 6, 6]
    assert {got[k].number_id for k in (4, 5, 20, 21)} == {4}


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(14):
        text = fx.prose(rng, rng.randrange(10, 90)) + " Straße “naïve”"
        texts += [text, unicodedata.normalize("NFD", text).upper(), fx.edited(rng, text, 0.03), text + " " + fx.prose(rng, 3), text[: len(text) // 2]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    first: dict = {}
    for k, t in enumerate(texts):
        first.setdefault(form(t), k)
    sets = {k: {f[i : i + 5] for i in range(len(f) - 4)} for f, k in first.items() if len(f) >= 60}
    want = set()
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and (shared >= 0.78 * (len(sets[a]) + len(sets[b]) - shared) or shared >= 0.94 * min(len(sets[a]), len(sets[b]))):
                want.add((a, b, shared, len(sets[a]), len(sets[b])))
    assert len(want) > 20
    assert {tuple(r) for r in duplicates.near_duplicates(df, "id", "text").collect()} == want


def test_text_duplicate_classes_follow_their_sql_on_odd_texts(spark, tmp_path):
    pairs = [("“a b” – c", "a b c"), ("ＡＢＣ", "abc"), ("abc 7", "abc ٣"), ("Straße", "STRASSE"), ("ΟΔΟΣ", "οδοσ"), ("İx", "ix"), ("café", "cafe\u0301"), (None, None), ("", " ."), ("n 12", "N 7"), ("ÄÖ", "äö")]
    rows = [(2 * k + j, t) for k, pair in enumerate(pairs) for j, t in enumerate(pair)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = duckdb.sql(duplicate_queries.ORACLE_SQL["text_duplicate_classes"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    got = duplicate_queries.text_duplicate_classes(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_duplicates_of_repetitive_and_reordered_texts_match_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("ab", 300), ("abc", 90), ("abcdef", 400), ("a", 200), ("ab", 64))]
    texts = base + [t[len(t) // 2 :] + t[: len(t) // 2] for t in base] + [t * 3 for t in base] + [t[:70] for t in base] + [t + "zz" + t[::-1] for t in base]
    want = set()
    first = {t: k for k, t in reversed(list(enumerate(texts))) if len(t) >= 60}
    sets = {k: {t[i : i + 5] for i in range(len(t) - 4)} for t, k in first.items()}
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and (shared >= 0.78 * (len(sets[a]) + len(sets[b]) - shared) or shared >= 0.94 * min(len(sets[a]), len(sets[b]))):
                want.add((a, b, shared, len(sets[a]), len(sets[b])))
    got = duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text")
    assert {tuple(r) for r in got.collect()} == want and len(want) > 10


def test_common_grams_make_no_pairs_of_texts_that_share_little(spark):
    """Texts of few syllables share grams with nearly all others, windows of them with few."""
    from tracewright.functions import gram_windows

    rng = random.Random(9)
    syllables = ["the", "ion", "ent", "her", "ing", "and", "er", "on", "st", "wh", "ou", "ti"]
    rows = [(k, "".join(rng.choice(syllables) for _ in range(120))) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, text string")
    keys = df.mapInArrow(gram_windows.window_keys(5, 4, 0.8764, duplicates._common_windows(df.select("id", "text").toDF("id", "form"))), gram_windows.KEYS)
    walks = df.mapInArrow(gram_windows.walk_keys(5, 4), gram_windows.KEYS)
    met = keys.alias("x").join(walks.alias("y"), "key").where("x.id <> y.id AND x.width = 4").count()
    single = df.mapInArrow(gram_windows.walk_keys(5, 1), gram_windows.KEYS)
    assert met * 4 < keys.alias("x").select("id", "n").join(single.alias("y"), "id").count() * 300


def test_near_duplicates_broadcast_nothing_and_gather_few_windows(spark, monkeypatch):
    rng = random.Random(10)
    texts = [fx.prose(rng, 40) for _ in range(30)]
    df = spark.createDataFrame([(2 * k + j, t + " and a tail" * j) for k, t in enumerate(texts) for j in range(2)], "id long, text string")
    write, common, plans, sizes = duplicates.written, duplicates._common_windows, [], []
    plan = lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(duplicates, "COMMON", 100, raising=False)
    monkeypatch.setattr(duplicates, "written", lambda d, label, **more: plan(d) or write(d, label, **more))
    monkeypatch.setattr(duplicates, "_common_windows", lambda forms: sizes.append(common(forms)) or sizes[-1])
    found = duplicates.near_duplicates(df, "id", "text")
    plan(found)
    assert len(plans) > 5 and not [p for p in plans if "Broadcast" in p]
    assert len(sizes[0][0]) == len(sizes[0][1]) == 100
    assert {(r.a, r.b) for r in found.collect()} == {(2 * k, 2 * k + 1) for k in range(30)}


def test_few_pairs_of_common_texts_are_left_for_exact_comparison(spark, monkeypatch):
    """Texts of few syllables share windows with many others, but seldom as many as near duplicates must."""
    rng = random.Random(11)
    syllables = ["the", "ion", "ent", "her", "ing", "and", "er", "on", "st", "wh", "ou", "ti"]
    rows = [(k, "".join(rng.choice(syllables) for _ in range(100 + k))) for k in range(200)]
    write, met = duplicates.written, {}
    monkeypatch.setattr(duplicates, "written", lambda d, label, **more: met.setdefault(label, write(d, label, **more)))
    assert duplicates.near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text").count() == 0
    assert met["near-met"].count() * 5 < 200 * 199 / 2
