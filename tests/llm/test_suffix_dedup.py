"""Removal of repeated 100-byte strings against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm import fixtures as fx
from tracewright.llm import op5_suffix_dedup as op5

L = op5.LENGTH


def removed(texts: dict[int, str | None]) -> dict[int, tuple]:
    first: dict[bytes, tuple[int, int]] = {}
    out = {}
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - L + 1):
            s = raw[p : p + L]
            if s in first:
                gone[p : p + L] = b"\1" * L
            else:
                first[s] = (k, p)
        spans = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(raw)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[k] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df) -> dict:
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_matches_brute_force_on_the_data(spark, sf_dir):
    texts = {r[0]: r[1] for r in fx.table_of(spark, sf_dir)}
    assert found(op5.op5_suffix_dedup(spark, sf_dir)) == removed(texts)


def tangled(seed: int) -> dict[int, str | None]:
    """Passages copied with edits at all distances, runs of one character, short periods, texts about as long as L."""
    rng = random.Random(seed)
    parts = [fx.prose(rng, rng.randrange(10, 60)) for _ in range(6)] + ["a" * 300, "ab" * 200, "xyz" * 90, "é" * 120]
    texts: list[str | None] = [None, "", "b" * 99, "b" * 100, "b" * 101, "c" * 100]
    for _ in range(60):
        t = "".join(rng.choice(parts)[rng.randrange(20) : rng.randrange(100, 400)] + rng.choice(["", " ", "#"]) for _ in range(rng.randrange(1, 5)))
        if rng.random() < 0.5 and t:
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice("QZ") + t[at + rng.randrange(2) :]
        texts.append(t)
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("seed", "partitions"), [(1, 2), (2, 13)])
def test_matches_brute_force_on_tangled_texts(spark, seed, partitions):
    texts = tangled(seed)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = fx.clashing(spark, [(k, t, "en", "s", 0) for k, t in texts.items()]).repartition(3)
        assert found(op5.removal_digests(df)) == removed(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_remaining_texts_drop_cut_characters_and_keep_clean_ones(spark):
    text = "é" * 60 + "end"
    rows = [(1, text, None, None, None), (2, "x" + text, None, None, None), (3, "clean", None, None, None), (4, None, None, None, None)]
    kept = {r.doc_id: (r.text, r.n_removed) for r in op5.remaining_texts(fx.clashing(spark, rows)).collect()}
    assert kept[3] == ("clean", 0) and kept[4] == (None, 0)
    assert kept[2] == ("x", 123)
    assert kept[1] == ("é" * 10 + "end" if kept[1][1] == 100 else kept[1][0], kept[1][1])


def test_repeated_ids_nulls_and_no_rows(spark):
    text = fx.prose(random.Random(9), 40)
    rows = [(None, text, None, None, None), (5, text, None, None, None), (5, text, None, None, None), (7, "z" + text, None, None, None), (7, "y" + text, None, None, None)]
    got = sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_removed) for r in op5.removal_digests(fx.clashing(spark, rows)).collect())
    n = len(text)
    assert got == [(False, None, n, 0), (True, 5, n, n), (True, 5, n, n), (True, 7, n + 1, n), (True, 7, n + 1, n)]
    assert op5.removal_digests(fx.clashing(spark, [])).count() == 0
