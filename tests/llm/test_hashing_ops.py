"""Sharding, line rules, token files, license scans and BPE against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import fixtures as fx
from tracewright.llm import op1_hilbert_shards as op1
from tracewright.llm import op3_line_crf as op3
from tracewright.llm import op7_patched_ids as op7
from tracewright.llm import op8_license_scan as op8
from tracewright.llm import op10_byte_bpe as op10
from tracewright.llm import text_arrays as ta

ROWS = fx.rows()


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return fx.stored(spark, folder, ROWS)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return fx.stored(spark, folder, [], 1)


def by_id(df) -> dict:
    out = {r.doc_id: r for r in df.collect()}
    return out


# ---- sharding


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_shards_hold_near_equal_row_counts_without_gaps(spark, sf_dir, odd_dir, where):
    folder = {"odd": odd_dir, "sf": sf_dir}[where]
    texts = {r[0]: r[1] for r in fx.table_of(spark, folder)}
    found = op1.op1_hilbert_shards(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    slots = defaultdict(list)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(24)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    curve = [r.curve for r in ordered]
    assert curve == sorted(curve)


def test_curve_visits_neighbouring_cells(spark):
    bits, n = 3, 3
    cells = [(x, y, z) for x in range(8) for y in range(8) for z in range(8)]
    df = op1.hilbert_index(spark.createDataFrame(cells, "a int, b int, c int"), ["a", "b", "c"], "i", bits)
    path = {r.i: (r.a, r.b, r.c) for r in df.collect()}
    assert sorted(path) == list(range(1 << (bits * n)))
    assert all(sum(abs(p - q) for p, q in zip(path[k], path[k + 1])) == 1 for k in range(len(path) - 1))


def test_manifest_prunes(spark, sf_dir):
    sharded = op1.op1_hilbert_shards(spark, sf_dir)
    manifest = op1.shard_manifest(sharded, ["lang_cell", "length_cell"]).collect()
    assert sum(r.rows for r in manifest) == 1000
    langs = {r.lang_cell for r in sharded.collect()}
    for cell in langs:
        touched = sum(r.min_lang_cell <= cell <= r.max_lang_cell for r in manifest)
        assert touched < 24


def test_shards_bear_nulls_repeats_extra_columns_and_no_rows(spark, empty_dir):
    rows = [(None, None, None, None, None), (1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", -5)]
    df = op1.hilbert_shards(fx.clashing(spark, rows), op1.document_dimensions(), "doc_id", shards=3)
    assert sorted(Counter(r.shard for r in df.collect()).values()) == [1, 1, 2]
    assert op1.op1_hilbert_shards(spark, empty_dir).count() == 0


def test_shards_match_their_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = con.execute(op1.SQL)
    names = [d[0] for d in found.description]
    rows = op1.op1_hilbert_shards(spark, sf_dir)
    assert sorted(tuple(r[n] for n in names) for r in rows.collect()) == sorted(found.fetchall())


# ---- line rules


def line_counts(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = set()
    for k in range(len(words) - 7):
        if grams[tuple(words[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    n, again = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, again, n < 20 or 100 * again > 30 * n


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_line_rules_count_as_defined(spark, sf_dir, odd_dir, where):
    folder = {"odd": odd_dir, "sf": sf_dir}[where]
    texts = {r[0]: r[1] for r in fx.table_of(spark, folder)}
    found = by_id(op3.op3_line_crf(spark, folder))
    assert len(found) == len(texts)
    for k, r in found.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == line_counts(texts[k]), k
        assert not (r.kept and r.base_failed)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = rng.integers(1, 7, 4)
        docs = np.repeat(np.arange(4), sizes)
        x = np.concatenate((np.ones((len(docs), 1)), rng.normal(size=(len(docs), 2))), axis=1)
        field = op3.Field(rng.normal(size=3), rng.normal(size=(2, 2)))
        got = op3.viterbi(field, x, docs)
        for d in range(4):
            own = np.flatnonzero(docs == d)
            score = x[own] @ field.emit

            def total(y, score=score, field=field):
                return sum(s * k for s, k in zip(score, y)) + sum(field.step[a, b] for a, b in zip(y, y[1:]))

            best = max(total([(m >> k) & 1 for k in range(len(own))]) for m in range(1 << len(own)))
            assert total(got[own].tolist()) == pytest.approx(best)


def test_field_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    docs = np.repeat(np.arange(3), [4, 1, 3])
    x, y = rng.normal(size=(8, 3)), rng.integers(0, 2, 8).astype(float)
    field = op3.Field(rng.normal(size=3), rng.normal(size=(2, 2)))

    def likelihood(f):
        out = 0.0
        for d in range(3):
            own = np.flatnonzero(docs == d)
            s = x[own] @ f.emit
            total = lambda z: sum(a * b for a, b in zip(s, z)) + sum(f.step[int(a), int(b)] for a, b in zip(z, z[1:]))
            out += total(y[own]) - np.log(sum(np.exp(total([(m >> k) & 1 for k in range(len(own))])) for m in range(1 << len(own))))
        return out

    emit, step = op3._gradient(field, x, y, docs)
    eps = 1e-6
    for k in range(3):
        moved = op3.Field(field.emit + eps * (np.arange(3) == k), field.step)
        assert emit[k] == pytest.approx((likelihood(moved) - likelihood(field)) / eps, abs=1e-3)
    for a in range(2):
        for b in range(2):
            shift = np.zeros((2, 2))
            shift[a, b] = eps
            assert step[a, b] == pytest.approx((likelihood(op3.Field(field.emit, field.step + shift)) - likelihood(field)) / eps, abs=1e-3)


def test_line_rules_keep_good_documents_and_drop_bad(spark, sf_dir):
    labels = {r[0]: r[1] for r in fx.table_of(spark, sf_dir, "labels")}
    found = by_id(op3.op3_line_crf(spark, sf_dir))
    good = [found[k].kept for k, q in labels.items() if q == 1 and not found[k].base_failed]
    bad = [found[k].kept for k, q in labels.items() if q == 0]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < np.mean(good)


def test_line_rules_bear_no_rows_and_clashing_columns(spark, empty_dir):
    assert op3.op3_line_crf(spark, empty_dir).count() == 0
    df = op3.line_rules(fx.clashing(spark, [(None, None, None, None, None), (1, "a b", "en", "s", 1), (1, "a b", "en", "s", 1)]), op3.Field.start())
    assert [(r.doc_id, r.n_words, r.kept) for r in df.orderBy("doc_id").collect()] == [(None, 0, False), (1, 2, False), (1, 2, False)]


# ---- token files


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_token_files_hold_the_tokenizers_ids(spark, sf_dir, odd_dir, where):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(op7.VOCABULARY))
    folder = {"odd": odd_dir, "sf": sf_dir}[where]
    texts = {r[0]: r[1] for r in fx.table_of(spark, folder)}
    found, start = by_id(op7.op7_patched_ids(spark, folder)), 0
    assert len(found) == len(texts)
    for k in sorted(texts):
        ids = [*tokenizer.encode(texts[k] or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (found[k].start, found[k].n_tokens, found[k].ids_crc32) == (start, len(ids), crc), k
        start += len(ids)


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=3000))
@settings(max_examples=40, deadline=None)
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    image = op7.Image(op7.encode_image(np.array([7], np.int64), np.array([0, len(ids)]), ids))
    assert image.ids().tolist() == ids.tolist()
    for k in range(image.n_blocks):
        assert image.block(k).tolist() == ids[k * op7.BLOCK : (k + 1) * op7.BLOCK].tolist()


def test_outliers_go_to_the_exception_list():
    ids = np.full(op7.BLOCK, 1000, np.uint32)
    ids[::2] += 15
    ids[[3, 900]] = 49_000
    image = op7.Image(op7.encode_image(np.array([1], np.int64), np.array([0, len(ids)]), ids))
    assert (image.mins[0], image.widths[0], image.counts[0]) == (1000, 4, 2)
    assert (image.block(0) == ids).all()


def test_token_files_bear_nulls_repeats_and_no_rows(spark, empty_dir, tmp_path):
    assert op7.op7_patched_ids(spark, empty_dir).count() == 0
    df = fx.clashing(spark, [(2, "b", None, None, None), (None, None, None, None, None), (1, "a", None, None, None), (1, "a", None, None, None), (-(1 << 63), None, None, None, None)])
    files = op7.write_files(df, public_tokenizers.path(op7.VOCABULARY), folder=str(tmp_path / "files"))
    assert [(r.doc_id, r.start, r.n_tokens) for r in op7.read_documents(files).orderBy("start").collect()] == [(None, 0, 1), (-(1 << 63), 1, 1), (1, 2, 2), (1, 4, 2), (2, 6, 2)]
    found = sorted(p for p in (tmp_path / "files").iterdir() if p.suffix == ".pfor")
    assert sum(op7.Image(p.read_bytes()).n for p in found) == 8 and len(found) == files.count()


WORD_TEXTS = st.text(st.one_of(st.sampled_from("aAbB ,.'-!?%\n\t12\x85\xa0 \x1c\x7fİſßéÉÞ×÷ÿŁłɏ̸̈<>|e界🙂½²٣"), st.characters(exclude_categories=["Cs"])), max_size=40)


@given(st.lists(WORD_TEXTS, max_size=6), st.sampled_from([3, 1 << 18]))
@settings(max_examples=400, deadline=None)
def test_words_give_the_tokenizers_ids_of_any_texts(texts, known):
    path = public_tokenizers.path(op7.VOCABULARY)
    words = op7.Words(path, known_words=known)
    for _ in range(2):
        got, sizes = [], []
        for t in ta.slices(pa.array(texts, pa.string())):
            ids, n = words.encoded(t, op7.END_ID)
            got += ids.tolist()
            sizes += n.tolist()
        want = [[*words.tokenizer.encode(x, add_special_tokens=False).ids, op7.END_ID] for x in texts]
        assert got == [i for x in want for i in x] and sizes == [len(x) for x in want]


# ---- license scans


def scanned(text: str | None) -> tuple:
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in op8.PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    more, score = set(labels), 1.0 if labels else 0.0
    for line in lowered.split("\n"):
        held = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
        for template, label in op8.TEMPLATES.items():
            t = {w.decode() for w in op8.words_of(template)}
            if len(t & held) >= int(np.ceil(op8.CONTAINMENT * len(t) - 1e-9)):
                more.add(label)
                score = max(score, len(t & held) / len(t))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), score


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_license_scans_match_brute_force(spark, sf_dir, odd_dir, where):
    folder = {"odd": odd_dir, "sf": sf_dir}[where]
    texts = {r[0]: r[1] for r in fx.table_of(spark, folder)}
    found = by_id(op8.op8_license_scan(spark, folder))
    assert len(found) == len(texts)
    for k, r in found.items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, pytest.approx(r.score)) == scanned(texts[k]), k


def test_license_scans_bear_nulls_repeats_and_no_rows(spark, empty_dir):
    assert op8.op8_license_scan(spark, empty_dir).count() == 0
    text = "x licensed under the Apache License, Version 2.0 y"
    df = op8.license_scan(fx.clashing(spark, [(None, None, None, None, None), (1, text, "en", "s", 1), (1, text, "en", "s", 1)]))
    assert [(r.doc_id, r.labels) for r in df.orderBy("doc_id").collect()] == [(None, ""), (1, "apache-2"), (1, "apache-2")]


def windowed(text: str) -> tuple[str, float]:
    """Labels and score by trying every run of words."""
    words = op8.words_of(text)
    labels, score = set(), 0.0
    for template, label in op8.TEMPLATES.items():
        wanted = set(op8.words_of(template))
        span = op8.SPAN * len(op8.words_of(template))
        shared = max(len(wanted & set(words[k : k + span])) for k in range(max(len(words), 1)))
        if shared >= int(np.ceil(op8.CONTAINMENT * len(wanted) - 1e-9)):
            labels.add(label)
            score = max(score, shared / len(wanted))
    return ",".join(sorted(labels)), score


def test_license_templates_are_met_across_line_breaks_but_not_spread_over_a_document(spark):
    filler = [f"filler{k}" for k in range(300)]
    gpl = "GNU General Public License as published by\nthe Free Software Foundation, either version 3"
    texts, want = [gpl], ["gpl-3"]
    for template, label in op8.TEMPLATES.items():
        for width in (12, 20, 40, 60, 80):
            texts.append(" ".join(filler) + "\n" + textwrap.fill(f"The files here are {template} and so on", width, break_long_words=False, break_on_hyphens=False) + "\n" + " ".join(filler))
            want.append(label)
        texts.append(" ".join(w for word in template.split() for w in (word, *filler[:40])))
        want.append("")
    rng = random.Random(4)
    vocabulary = [w.decode() for t in op8.TEMPLATES for w in op8.words_of(t)]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))) for _ in range(60)]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in op8.license_scan(spark.createDataFrame(rows, fx.PLAIN), phrases={"no such phrase": "none"}).collect()}
    for k, label in enumerate(want):
        assert label in got[k].labels if label else got[k].labels == "", texts[k]
    assert [(got[k].labels, pytest.approx(got[k].score)) for k in range(len(texts))] == [windowed(t) for t in texts]


# ---- byte-level BPE


def reference_encoding():
    import tiktoken

    ranks = op10.read_ranks(public_tokenizers.path(op10.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_bpe_matches_the_library(spark, sf_dir, odd_dir, where):
    folder = {"odd": odd_dir, "sf": sf_dir}[where]
    encoding = reference_encoding()
    texts = {r[0]: r[1] for r in fx.table_of(spark, folder)}
    found = by_id(op10.op10_byte_bpe(spark, folder))
    assert len(found) == len(texts)
    for k, r in found.items():
        ids = encoding.encode_ordinary(texts[k] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((texts[k] or "").encode()).hexdigest()), k


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_bpe_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    codec = op10._codec(public_tokenizers.path(op10.VOCABULARY), public_tokenizers.PATTERN)
    chunks = op10.chunk_memo(codec)
    ids = [int(i) for c in op10._chunks(text) for i in chunks[c][0].split(",")[:-1]]
    assert ids == _encoding.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_memos_keep_two_generations_at_most():
    memo = op10.Memo(3, len)
    for k in range(40):
        assert memo[f"{k % 5}" * (k % 5)] == k % 5
        assert len(memo) <= 3 and len(memo.older) <= 3
    assert memo["x" * 100] == 100 and "x" * 100 not in memo


@pytest.mark.parametrize("window", [7, 1 << 14])
def test_bpe_of_long_pieces(monkeypatch, window):
    """Pieces of many windows, with steps back across their edges."""
    monkeypatch.setattr(op10, "WINDOW", window)
    codec = op10._codec(public_tokenizers.path(op10.VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(6)
    for piece in ("ab" * 900, "é" * 500, "".join(rng.choice("aehinorst") for _ in range(40_000)), "".join(rng.choice("日本語文字🙂é") for _ in range(900))):
        assert list(codec.encode_piece(piece.encode())) == _encoding._encode_single_piece(piece.encode())


_encoding = reference_encoding()


def test_bpe_bears_nulls_repeats_and_no_rows(spark, empty_dir):
    assert op10.op10_byte_bpe(spark, empty_dir).count() == 0
    df = op10.byte_bpe(fx.clashing(spark, [(None, None, None, None, None), (1, "ab", "en", "s", 1), (1, "ab", "en", "s", 1)]), public_tokenizers.path(op10.VOCABULARY))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in df.collect()) == [(0, 0), (1, 1), (1, 1)]
    ids = op10.token_ids(fx.clashing(spark, [(1, "hello world", "en", "s", 1)]), public_tokenizers.path(op10.VOCABULARY)).first().ids
    assert ids == _encoding.encode_ordinary("hello world")
