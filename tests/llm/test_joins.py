"""The n-gram Jaccard join, components, decontamination, the classifier and URL lists against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm import fixtures as fx
from tracewright.llm import op2_ngram_jaccard as op2
from tracewright.llm import op4_pu_quality as op4
from tracewright.llm import op6_edit_decontamination as op6
from tracewright.llm import op9_url_lists as op9
from tracewright.llm import text_arrays as ta
from tracewright.llm.components import connected_components

# ---- n-gram Jaccard join


def shingles(text: str | None) -> frozenset:
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components(nodes, edges) -> dict:
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def jaccard_components(texts: dict) -> dict:
    sets = {k: shingles(t) for k, t in texts.items()}
    holders = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            holders[g].append(k)
    shared: dict = defaultdict(int)
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    groups = components(texts, links)
    return {k: (len(sets[k]), groups[k]) for k in texts}


def joined(df) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def families(seed: int) -> list[tuple]:
    """Chains of near copies at all distances, made of common passages so that frequent shingles decide."""
    rng = random.Random(seed)
    common = [fx.prose(rng, 30) for _ in range(8)]
    texts = [None, "", "one two", "One TWO", "a b c d e", "a b c d e f"]
    for _ in range(10):
        text = " ".join(rng.sample(common, 3)) if rng.random() < 0.6 else fx.prose(rng, rng.randrange(8, 300))
        for _ in range(rng.randrange(1, 9)):
            texts.append(text)
            text = fx.edited(rng, text, rng.choice([0.0, 0.005, 0.01, 0.02, 0.04]))
    rng.shuffle(texts)
    return [(k * 3 + 1, t, "en", "s", 0) for k, t in enumerate(texts)]


def test_jaccard_join_matches_brute_force_on_the_data(spark, sf_dir):
    assert joined(op2.op2_ngram_jaccard(spark, sf_dir)) == jaccard_components({r[0]: r[1] for r in fx.table_of(spark, sf_dir)})


@pytest.mark.parametrize(("seed", "frequent"), [(1, 2), (2, 32)])
def test_jaccard_join_matches_brute_force_on_families(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(op2, "FREQUENT", frequent)
    rows = families(seed)
    assert joined(op2.similar_components(fx.clashing(spark, rows))) == jaccard_components({r[0]: r[1] for r in rows})


def test_jaccard_join_bears_nulls_repeats_and_no_rows(spark):
    text, other = "a b c d e f g", "h i j k l m n o"
    rows = [(None, text), (4, text), (4, text), (9, text.upper()), (4, other), (20, other), (3, other), (30, other + " p q r s")]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in op2.similar_components(fx.clashing(spark, [(*r, None, None, None) for r in rows])).collect()), key=str)
    # the rows of id 4 are one document, which links both texts
    assert got == [(0, 3, None), (20, 4, 3), (3, 4, 3), (30, 8, 30), (4, 3, 3), (4, 3, 3), (4, 4, 3), (9, 3, 3)]
    assert op2.similar_components(fx.clashing(spark, [])).count() == 0


def test_jaccard_join_compares_few_pairs_of_a_large_group(spark):
    """Near copies at all distances from one text: candidate pairs stay in proportion to the members."""
    rng = random.Random(11)
    base = fx.prose(rng, 140)
    texts = {k: fx.edited(rng, base, rng.choice([0.004, 0.01, 0.02, 0.03, 0.04, 0.06])) + " and a closing line that all of them share" for k in range(260)}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    assert joined(op2.similar_components(docs)) == jaccard_components(texts)
    rows = op2.written(op2.shared_tokens(docs, op2.shingles, op2._with_shared, op2.SETS, lower=True), "rows")
    sets = op2.keyed_sets(rows)
    keys = sets.selectExpr("max(size(keys) / n)").first()[0]
    assert keys < 3
    links, _ = op2.similar_links(sets)
    assert links.count() < 2 * len(texts)


def test_jaccard_join_bears_a_very_long_text_with_near_copies(spark):
    rng = random.Random(12)
    base = fx.prose(rng, 12_000)
    texts = {k: fx.edited(rng, base, share) for k, share in enumerate((0.0, 0.002, 0.01, 0.02, 0.03, 0.05))}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    assert joined(op2.similar_components(docs)) == jaccard_components(texts)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in components({n for e in edges for n in e}, edges).items() if n in nodes}


# ---- decontamination


def least_distance(item: bytes, text: bytes) -> int:
    """Sellers' dynamic programme for a substring."""
    m = len(item)
    column = list(range(m + 1))
    best = m
    for c in text:
        diagonal, column[0] = column[0], 0
        for i in range(1, m + 1):
            diagonal, column[i] = column[i], min(diagonal + (item[i - 1] != c), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[m])
    return best


def planted(seed: int):
    rng = random.Random(seed)
    items = [(k, fx.prose(rng, rng.randrange(12, 22))) for k in range(6)] + [(90, None), (91, ""), (92, "short one"), (93, "What is, the NAME of that place?")]
    docs = []
    for k in range(24):
        text = fx.prose(rng, 40)
        if k % 2:
            item = list(rng.choice(items[:6])[1])
            for _ in range(rng.randrange(0, len(item) // 9)):
                at = rng.randrange(len(item))
                item[at : at + 1] = rng.choice(["", "x", item[at] + "y"])
            text = text[:80] + " " + "".join(item) + " " + text[80:]
        docs.append((k, text, "en", "s", 0))
    docs += [(50, None, None, None, None), (51, "", None, None, None), (52, "and WHAT is the name   of that place??? yes", None, None, None), (None, "what is the name of that place", None, None, None), (52, "and WHAT is the name   of that place??? yes", None, None, None)]
    return docs, items


@pytest.mark.parametrize("block", [2, 5000])
def test_decontamination_finds_what_brute_force_finds(spark, block):
    docs, items = planted(3)
    got = {(r.doc_id, r.item_id): r.distance for r in op6.leaks(fx.clashing(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block).collect()}
    bench = op6.Benchmark(items)
    want = {}
    for k, text, *_ in docs:
        for item_id, item, edits in zip(bench.ids, bench.items, bench.edits.tolist()):
            distance = least_distance(item, op6.normalised_text(text or "")) if text else len(item)
            if distance <= edits:
                want[k, item_id] = distance
    assert set(got) <= set(want)
    assert len(want) >= 12 and len(got) >= 0.9 * len(want)
    assert all(got[k] >= want[k] for k in got)
    assert got[52, 93] == 0 and got[None, 93] == 0


def edited_bytes(rng: random.Random, item: bytes, edits: int, kinds: str = "dir") -> str:
    text = list(item.decode())
    for at in rng.sample(range(len(text)), edits):
        text[at] = {"d": "", "i": text[at] + "q", "r": "q"}[rng.choice(kinds)]
    return "".join(text)


@pytest.mark.parametrize(("size", "count"), [(40, 120), (100, 120), (300, 80), (1000, 24), (3000, 8)])
def test_recall_at_all_edits_allowed(size, count):
    """Items with as many edits as they allow, alone and of each kind, in a document each."""
    rng = random.Random(size)
    bench = op6.Benchmark([(k, fx.prose(rng, size // 4)[:size]) for k in range(count)])
    found = wanted = 0
    for k, item in enumerate(bench.items):
        document = f"{fx.prose(rng, 12)} {edited_bytes(rng, item, int(bench.edits[k]), rng.choice(['d', 'i', 'r', 'dir']))} {fx.prose(rng, 12)}"
        for t in ta.slices(pa.array([document]), lower=True):
            text = op6.normalised(t)
            if op6.edits_within(item, text.data.tobytes(), int(bench.edits[k])) is not None:
                wanted += 1
                found += (0, k) in bench.found(text)
    assert wanted > count / 2 and found >= 0.9 * wanted, (found, wanted)


def test_items_that_share_a_passage_are_told_apart(monkeypatch):
    """Grams of very many items, counted few places at a time."""
    monkeypatch.setattr(op6, "EXPANDED", 500)
    rng = random.Random(21)
    question = "which of the following statements about the subject is not correct at all"
    items = [(k, f"{question} {fx.prose(rng, 8)}") for k in range(90)]
    bench = op6.Benchmark(items)
    docs = [f"{fx.prose(rng, 10)} {edited_bytes(rng, bench.items[k], 3)} {fx.prose(rng, 10)}" for k in range(0, 90, 3)]
    want = {(d, i) for d, text in enumerate(docs) for i, item in enumerate(bench.items) if op6.edits_within(item, op6.normalised_text(text), int(bench.edits[i])) is not None}
    got = {(t.first + d, i) for t in ta.slices(pa.array(docs), lower=True) for d, i in bench.found(op6.normalised(t))}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) >= 30


def test_very_long_items_and_texts_are_compared():
    rng = random.Random(22)
    item = fx.prose(rng, 1500)
    bench = op6.Benchmark([(1, item), (2, "x " * 40)])
    text = f"{fx.prose(rng, 4000)} {edited_bytes(rng, bench.items[0], 60)} {fx.prose(rng, 4000)}"
    got = [bench.ids[i] for t in ta.slices(pa.array([text]), lower=True) for _, i in bench.found(op6.normalised(t))]
    assert got == [1]


def test_very_short_items_are_looked_up():
    bench = op6.Benchmark([(1, "Cats"), (2, "Short one"), (3, "?")])
    texts = ["some cats", "catsuit", "a SHORT, one", "a short on", "Cats", ""]
    got = {(t.first + d, bench.ids[i]) for t in ta.slices(pa.array(texts), lower=True) for d, i in bench.found(op6.normalised(t))}
    assert got == {(0, 1), (4, 1), (2, 2)}


def test_myers_distance_is_exact():
    rng = random.Random(8)
    for _ in range(60):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 60)))
        want = least_distance(item, text)
        assert op6.edits_within(item, text, len(item)) == want
        assert op6.edits_within(item, text, want - 1) is None


def test_clean_documents_keep_their_columns_and_empty_tables_work(spark):
    docs, items = planted(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = fx.clashing(spark, docs)
    gone = {r.doc_id for r in op6.leaking_documents(df, benchmark).collect()}
    left = op6.clean_documents(df, benchmark)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d[0]) for d in docs if d[0] not in gone)
    assert op6.leaking_documents(df, benchmark.limit(0)).count() == 0
    assert op6.leaking_documents(df.limit(0), benchmark).count() == 0


# ---- quality classifier


def auc(score: np.ndarray, label: np.ndarray) -> float:
    good, bad = score[label == 1], score[label == 0]
    return float(np.mean((good[:, None] > bad[None]) + 0.5 * (good[:, None] == bad[None])))


def test_held_out_documents_are_told_apart(spark):
    folder = str(fx.DATA / "sf0.1")
    labels = {r[0]: r[1] for r in fx.table_of(spark, folder, "labels")}
    rows = [r for r in op4.op4_pu_quality(spark, folder).collect()]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])
    assert len(held) > 300 and 0.1 < np.mean([r.held_out for r in rows]) < 0.3
    assert auc(score, label) > 0.8
    assert np.mean(score[label == 1] >= 0.3) > 0.9


def test_prior_and_risk_on_a_known_mixture():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (1500, 2)), rng.normal(3, 1, (1500, 2))
    scorer = op4.fit(good[:700], np.concatenate((good[700:], bad[:1200])))
    assert 0.3 < scorer.prior < 0.55
    assert np.mean(scorer.scores(good) > np.median(scorer.scores(bad))) > 0.9


def _naive_statistics(text: str) -> list[float]:
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    n, pairs = max(len(words), 1), list(zip(words, words[1:], strict=False))
    letters, upper = sum(chr(b).isalpha() for b in raw if b < 128), sum(chr(b).isupper() for b in raw if b < 128)
    counts = [sum(b in chars.encode() for b in raw) / n for chars in op4._CLASSES.values()]
    same = sum(a == b for a, b in pairs)
    return counts + [upper / max(letters, 1), sum(map(len, words)) / n, sum(b >= 128 for b in raw) / max(len(raw), 1), len(set(words)) / n, same / n, len(set(pairs)) / max(len(pairs), 1), raw.count(b"\n") / n, float(np.log1p(n))]


def test_statistics_and_scores_match_a_naive_version():
    texts = [r[1] or "" for r in fx.rows(seed=3, plain=10, long_words=3000)]
    got, want = op4.text_statistics(texts), np.array([_naive_statistics(t) for t in texts])
    assert np.allclose(got, want)
    scorer = op4.fit(got[:30], got[20:])
    for row, score in zip(got, scorer.scores(got), strict=True):
        z = scorer.weights[-1] + sum(scorer.weights[j * op4.BINS + sum(e <= v for e in scorer.edges[j])] for j, v in enumerate(row))
        assert abs(1 / (1 + np.exp(-z)) - score) < 1e-5


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_risk_and_gradient_match_naive_sums_and_differences(prior):
    rng = np.random.default_rng(4)
    p, u, w = rng.normal(1, 1, (30, 4)), rng.normal(-1, 1, (50, 4)), rng.normal(0, 1, 4)
    loss = lambda x, sign: 1 / (1 + np.exp(sign * float(x @ w)))
    plus = prior * sum(loss(x, 1) for x in p) / len(p)
    minus = sum(loss(x, -1) for x in u) / len(u) - prior * sum(loss(x, -1) for x in p) / len(p)
    assert np.allclose(op4.risk(w, p, u, prior), (plus, minus))
    got = op4.risk_gradient(w, p, u, prior)
    for j in range(4):
        step = np.eye(4)[j] * 1e-6
        (a, b), (c, d) = op4.risk(w + step, p, u, prior), op4.risk(w - step, p, u, prior)
        want = (a + b - c - d) / 2e-6 if minus >= 0 else -(b - d) / 2e-6  # the non-negative correction
        assert abs(got[j] - want) < 1e-6


def test_repeated_ids_count_once_in_the_samples(spark):
    rng = random.Random(8)
    rows = [(k, fx.prose(rng, 40), "en", "s", 1) for k in range(60)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    once, thrice = (op4.fitted(fx.clashing(spark, rows * n), labels) for n in (1, 3))
    assert np.allclose(once.weights, thrice.weights) and once.prior == thrice.prior


def test_classifier_bears_nulls_repeats_no_labels_and_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = fx.clashing(spark, [(None, None, None, None, None), (1, "a", "en", "s", 1), (1, "a", "en", "s", 1)])
    got = op4.quality_scores(df, op4.fitted(df, labels)).collect()
    assert [r.score for r in got] == [0.5] * 3 and {r.held_out for r in got if r.doc_id is None} == {False}
    assert op4.quality_documents(df, op4.fitted(df, labels)).columns == df.columns
    assert op4.quality_scores(df.limit(0), op4.fitted(df.limit(0), labels)).count() == 0


# ---- URL lists


def test_url_lists_match_their_sql(spark, sf_dir):
    got = sorted(tuple(r) for r in op9.op9_url_lists(spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    assert got == sorted(con.execute(op9.SQL).fetchall(), key=lambda r: r[0]) and len(got) == 250
    assert 20 < sum(r[4] is not None for r in got) < 230


@pytest.mark.parametrize("limit", [0, 50_000])
def test_url_lists_judge_each_capture_of_an_id_at_its_own_time(spark, monkeypatch, limit):
    monkeypatch.setattr(op9, "BROADCAST_ROWS", limit)
    lists = op9.validity(spark.createDataFrame([("bad.org", "add", "2024-01-02"), ("bad.org", "remove", "2024-01-05"), ("good.org/a/b", "add", "2024-01-01")], "domain string, action string, day string").selectExpr("domain", "action", "to_timestamp_ntz(day) AS at"))
    captures = [(1, "http://bad.org/", "2024-01-03"), (1, "http://bad.org/", "2024-02-01"), (1, "http://good.org/", "2024-01-03"), (None, "http://good.org/a/b?c", "2024-01-03"), (None, "http://good.org/a/b/c", "2024-01-03")]
    df = spark.createDataFrame(captures, "id long, url string, day string").selectExpr("id", "url", "to_timestamp_ntz(day) AS fetched_at", "'x' AS domain", "1 AS salt", "2 AS n")
    got = sorted((r.url, str(r.fetched_at)[:10], r.listed_domain) for r in op9.as_of(df, lists, "id").collect())
    assert got == [("http://bad.org/", "2024-01-03", "bad.org"), ("http://bad.org/", "2024-02-01", None), ("http://good.org/", "2024-01-03", None), ("http://good.org/a/b/c", "2024-01-03", None), ("http://good.org/a/b?c", "2024-01-03", "good.org/a/b")]


@pytest.mark.parametrize(("limit", "size"), [(0, 4_000_000), (50_000, 0)])
def test_long_url_lists_are_not_broadcast_however_small_their_file_is(spark, sf_dir, monkeypatch, limit, size):
    monkeypatch.setattr(op9, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(op9, "BROADCAST_BYTES", size, raising=False)
    plan = op9.op9_url_lists(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("limit", [0, 50_000])
def test_url_lists_as_of(spark, monkeypatch, limit):
    monkeypatch.setattr(op9, "BROADCAST_ROWS", limit)
    events = [("bad.org", "add", "2024-01-02"), ("bad.org", "add", "2024-01-02"), ("bad.org", "remove", "2024-01-05"), ("x.bad.org", "add", "2024-01-01"), ("gone.com", "remove", "2024-01-01"), (None, "add", "2024-01-01"), ("localhost", "add", None)]
    lists = op9.validity(spark.createDataFrame(events, "domain string, action string, day string").selectExpr("domain", "action", "to_timestamp_ntz(day) AS at"))
    captures = [(1, "http://BAD.org/x", "2024-01-02"), (2, "http://bad.org:80/", "2024-01-05"), (3, "https://u@y.x.bad.org./", "2024-01-03"), (4, "https://notbad.org/", "2024-01-03"), (5, None, "2024-01-03"), (6, "nonsense", "2024-01-03"), (7, "http://bad.org", None), (8, "http://gone.com", "2024-02-01"), (1, "http://BAD.org/x", "2024-01-02")]
    df = spark.createDataFrame(captures, "id long, url string, day string").selectExpr("id", "url", "to_timestamp_ntz(day) AS fetched_at", "'x' AS reason")
    got = sorted((r.id, r.listed_domain) for r in op9.as_of(df, lists, "id").collect())
    assert got == [(1, "bad.org"), (1, "bad.org"), (2, None), (3, "x.bad.org"), (4, None), (5, None), (6, None), (7, None), (8, None)]
    assert op9.as_of(df.limit(0), lists, "id").count() == 0
    assert op9.as_of(df, lists.limit(0), "id").where("listed_domain IS NOT NULL").count() == 0
