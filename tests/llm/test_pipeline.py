"""Every stage of the pipeline against brute force, on its own input."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline as cp
from tests.llm import fixtures as fx
from tests.llm.test_hashing_ops import reference_encoding
from tests.llm.test_joins import jaccard_components, least_distance
from tests.llm.test_suffix_dedup import removed
from tracewright.llm import op4_pu_quality as op4
from tracewright.llm import op6_edit_decontamination as op6


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    item = "Which of these old bridges did the engineers rebuild twice after the flood?"
    rows = [*fx.rows(seed=11, plain=25, long_words=2000), (9001, f"A quiet morning in town, with many words of its own. {item} And more.", "en", "s", 1)]
    sf_dir = fx.stored(spark, folder, rows)
    spark.createDataFrame([(k, k % 2, 0) for k in range(0, 60, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(cp.STAGES):
        out = f"{folder}/stage{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        after = spark.read.parquet(out)
        seen.append((name, docs, after))
        docs = after
    return sf_dir, seen


def texts(df) -> dict:
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for _, before, after in stages[1][:-1]:
        assert after.columns == before.columns == cp.COLUMNS


def test_quality_takes_what_the_classifier_accepts(spark, stages):
    sf_dir, seen = stages
    _, before, after = seen[0]
    scores = op4.quality_scores(before, op4.fitted(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()
    assert texts(after) == {k: t for k, t in texts(before).items() if k in {r.doc_id for r in scores if r.predicted}}


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1][1]
    own = texts(before)
    assert texts(after) == {k: own[k] for k, (_, c) in jaccard_components(own).items() if k == c}


def test_repeated_strings_go(stages):
    _, before, after = stages[1][2]
    own, left = texts(before), texts(after)
    cut = removed(own)
    for k, (n_bytes, n_removed, _, digest) in cut.items():
        if not n_removed:
            assert left[k] == own[k]
        elif k in left:
            assert hashlib.sha256(left[k].encode()).hexdigest() == digest or not own[k].isascii()
    assert {k for k in own if k not in left} == {k for k in own if cut[k][1] and k not in left}
    assert {r.doc_id: r.n_chars for r in after.collect() if cut[r.doc_id][1]} == {k: len(left[k]) for k in left if cut[k][1]}


def test_documents_with_items_go(stages):
    _, before, after = stages[1][3]
    own, left = texts(before), texts(after)
    bench = op6.Benchmark([(1, "Which of these old bridges did the engineers rebuild twice after the flood?")])
    leak = {k for k, t in own.items() if t and len(t) < 3000 and least_distance(bench.items[0], op6.normalised_text(t)) <= bench.edits[0]}
    assert set(own) - set(left) == leak


def test_last_stage_gives_the_library_ids(stages):
    _, before, after = stages[1][4]
    encoding = reference_encoding()
    found = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in after.collect()}
    for k, t in texts(before).items():
        ids = encoding.encode_ordinary(t or "")
        assert found[k] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert len(found) == before.count()


def test_run_gives_the_stages_rows(spark, stages):
    sf_dir, seen = stages
    assert sorted(map(tuple, cp.run(spark, sf_dir).collect()), key=str) == sorted(map(tuple, seen[-1][2].collect()), key=str)


def test_stages_bear_empty_tables(spark, tmp_path):
    sf_dir = fx.stored(spark, tmp_path, [], 1)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    assert cp.run(spark, sf_dir).count() == 0
