"""The conversation trie, SentencePiece ids and the Merkle manifest against brute force, the library and SQL."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tests.llm import fixtures as fx
from tests.test_catalog import comparable
from tracewright.llm import op11_prefix_trie as op11
from tracewright.llm import op12_pieces as op12
from tracewright.llm import op13_merkle_manifest as op13

ROWS = fx.rows()
TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed: int = 3) -> list[tuple]:
    """Shared openings, copies, a long conversation, null turns, roles, texts and ids, ties, repeated rows, gaps."""
    rng = random.Random(seed)
    openings = [("system", "be kind"), ("user", "hello"), ("assistant", ""), ("user", "hé llo"), (None, None)]
    out = []
    for c in [*range(60), *range(500, 540), -7, -5, 10**12]:
        for t in range(rng.randrange(1, 12)):
            role, text = openings[t % 5] if rng.random() < 0.7 else (rng.choice(["user", None]), rng.choice(["a", "b", None, ""]))
            out.append((c, None if t == 3 and c % 4 == 0 else t, role, text))
    out += [(c, t, "user", f"turn {t}") for c in range(100, 140) for t in range(6)]
    out += [(700, t, "user", f"long {t}") for t in range(900)] + [(705, t, "user", f"long {t}") for t in range(850)]
    out += [(7, 0, "user", "hello"), (7, 0, "user", "hello"), (None, 1, "user", "lost"), (8, 1, "x", "word " * 20_000)]
    rng.shuffle(out)
    return out


def naive_trie(rows: list[tuple]) -> dict[tuple, tuple]:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = turns.get(donor, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    out, sums = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = [sums[p] for p in children[path]]
        own = (len(nodes[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        sums[path] = (sum(b[0] for b in below) or (not children[path]), own + sum(b[1] for b in below))
        ends = ",".join(map(str, sorted(c for c in nodes[path] if len(built[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out[path] = (min(nodes[path]), len(path), parent, len(nodes[path]), len(children[path]), int(sums[path][0]), sums[path][1], hashlib.sha256(ends.encode()).hexdigest())
    return out


@pytest.mark.parametrize("task_turns", [1 << 17, 500, 60])
def test_trie_matches_brute_force_however_it_is_cut_into_tasks(spark, task_turns):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS + ", node string, depth int, key string").repartition(5)
    got = op11.prefix_trie(op11.rebuilt(df), task_turns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, naive_trie(rows).values()))


def test_trie_of_nothing_and_of_null_ids_is_empty(spark):
    for rows in ([], [(None, 1, "user", "a")]):
        assert op11.prefix_trie(op11.rebuilt(spark.createDataFrame(rows, TURNS))).collect() == []


def test_runs_carry_lcps_and_merging_reads_turns_only_where_they_are_equal():
    rng = random.Random(1)
    entries = [(b"".join(bytes([rng.randrange(3)]) * op11.WIDTH for _ in range(rng.randrange(7))), k, []) for k in range(2500)]
    entries += [(b"\1" * op11.WIDTH * 400, k, []) for k in range(3000, 3100)]  # copies with 400 shared turns
    rng.shuffle(entries)
    tree = op11.LoserTree([op11.sorted_run(entries[k : k + 100]) for k in range(0, len(entries), 100)])
    merged, want = list(tree), sorted(entries, key=lambda e: e[:2])
    assert [e for _, e in merged] == want
    assert [shared for shared, _ in merged] == [op11.lcp(want[k - 1][0], e[0]) if k else 0 for k, e in enumerate(want)]
    whole = sum(len(e[0]) // op11.WIDTH for e in want)
    assert tree.compared < whole, "each copy would cost its 400 turns some log2(26) times if shared turns were compared again"


@pytest.fixture(scope="module")
def codec():
    return op12.loaded(public_tokenizers.path(op12.VOCABULARY))


def expected(rows) -> dict:
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(op12.VOCABULARY))
    out = {}
    for doc_id, text in rows:
        ids = model.encode(text or "", add_eos=True)
        out[doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest(), ids)
    return out


def spaced() -> list[str]:
    rng = random.Random(9)
    return ["".join(rng.choice([" ", "  ", "▁", "a", "The", "é", "日", "\n", "\t", "<0x0A>", "</s>", "🙂", " ", "　", "\x00"]) for _ in range(rng.randrange(0, 40))) for _ in range(300)]


@pytest.mark.parametrize("unit_bytes", [op12.UNIT_BYTES, 3000])
def test_pieces_equal_the_library_in_units_of_any_size(spark, unit_bytes, tmp_path):
    texts = [r[1] for r in ROWS] + spaced()
    folder = fx.stored(spark, tmp_path, [(k, t, None, None, None) for k, t in enumerate(texts)])
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "text AS word", "1 AS unit", "2 AS ids")
    path = public_tokenizers.path(op12.VOCABULARY)
    got, want = op12.pieces(docs, path, unit_bytes).collect(), expected(enumerate(texts))
    assert len(got) == len(texts) and sum(r.n_missed for r in got) == 0
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == {k: v[:3] for k, v in want.items()}
    assert {r.doc_id: r.ids for r in op12.token_ids(docs, path, unit_bytes).collect()} == {k: v[3] for k, v in want.items()}


def test_each_distinct_word_is_in_its_units_table_once(spark, tmp_path):
    folder = fx.stored(spark, tmp_path, ROWS)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [(r.unit, w) for r in spark.read.parquet(op12.word_table(docs, public_tokenizers.path(op12.VOCABULARY))).collect() for w in op12.unpacked(r["size"], r.block)[0].to_pylist()]
    assert len(set(found)) == len(found)
    assert {w for _, w in found} == {w for r in ROWS for w in op12.marked_words(r[1] or "")}


def test_words_that_a_unit_lacks_are_segmented_in_place(codec, tmp_path):
    words = op12.UnitWords(str(tmp_path), 5, codec)
    ids, shown = words.texts(op12.word_lists(pa.array(["hello  world", None, "hello"])))
    assert words.missed == 3 and shown.to_pylist() == ["hello  world", "", "hello"]
    assert ids.to_pylist()[0] == " ".join(map(str, codec.model.encode("hello  world")))


def test_pieces_of_nothing_and_equal_rows(spark):
    path = public_tokenizers.path(op12.VOCABULARY)
    assert op12.pieces(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
    got = op12.pieces(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string"), path).collect()
    assert len({r.ids_sha256 for r in got if r.doc_id == 1}) == 1 and [r.n_tokens for r in got if r.doc_id is None] == [1]


def naive_manifest(rows: list[tuple]) -> list[tuple]:
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(doc_id, text, lang, source, n_chars):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def folds(nodes):
        """Levels of a tree, and each first node's siblings from below."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, k):
        out = []
        for level in levels[:-1]:
            run, at = level[k // 16 * 16 : k // 16 * 16 + 16], k % 16
            out.append(("".join(run[:at]), "".join(run[at + 1 :])))
            k //= 16
        return out

    groups = defaultdict(list)
    for r in rows:
        changed = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None, *r[2:])
        shown = leaf(*(changed if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r))
        groups[r[3]].append(((r[0] is not None, r[0] or 0), leaf(*r), shown, r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:2])
        trees[name] = folds([x[1] for x in groups[name]])
    top = folds([trees[n][-1][0] for n in names])
    out = []
    for g, name in enumerate(names):
        for k, (_, own, shown, doc_id) in enumerate(groups[name]):
            proof, node = path(trees[name], k) + path(top, g), shown
            for before, after in proof:
                node = h(before, node, after)
            out.append((doc_id, own, trees[name][-1][0], top[-1][0], h(*(b + a for b, a in proof)), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("many", [False, True])
def test_manifest_matches_brute_force(spark, tmp_path, many):
    rng = random.Random(2)
    rows = [(*r[:4], r[4]) for r in ROWS] + [(None, "A", None, "hot", 1), (None, None, None, None, None), ROWS[0], ROWS[0]]
    if many:  # several blocks in one group, and more groups than a run holds
        rows += [(10_000 + k, f"Text {k}", "en", "hot" if rng.random() < 0.9 else f"s{k % 300}", k) for k in range(6000)]
    got = op13.op13_merkle_manifest(spark, fx.stored(spark, tmp_path, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, naive_manifest(rows)))
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_nothing_one_row_and_clashing_columns(spark):
    f = list(op13.FIELDS)
    assert op13.manifest(spark.createDataFrame([], fx.PLAIN), f, "doc_id", "source").collect() == []
    one = op13.manifest(spark.createDataFrame([(1, "T", "en", "s", 1)], fx.PLAIN), f, "doc_id", "source").collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root and one[0].verified
    assert one[0].proof_sha256 == hashlib.sha256(b"").hexdigest()
    wide = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in ROWS], fx.PLAIN + ", id string, tree int, idx int, leaf string")
    plain = spark.createDataFrame(ROWS, fx.PLAIN)
    assert sorted(map(str, op13.manifest(wide, f, "doc_id", "source").collect())) == sorted(map(str, op13.manifest(plain, f, "doc_id", "source").collect()))


@pytest.mark.parametrize("op,name", [(op11, "op11_prefix_trie"), (op13, "op13_merkle_manifest")])
def test_queries_give_what_their_sql_gives(spark, sf_dir, op, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, found = getattr(op, name)(spark, sf_dir), con.execute(op.SQL)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert comparable(df.columns, df.collect()) == comparable(names, found.fetchall())
