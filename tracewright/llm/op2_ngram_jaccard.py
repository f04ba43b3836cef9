"""N-gram Jaccard join with token-combination prefixes: components of documents whose shingle sets are similar.

A document's set is its distinct 5-word shingles (64-bit hashes, the tokens). Two sets link at a Jaccard similarity of
0.8; that takes ``ceil(0.8 * n)`` shared tokens of either.

1. Shared tokens. A token of one document alone can't be shared, so a document in which fewer than ``ceil(0.8 * n)``
   tokens occur elsewhere has no link. Documents are dealt into buckets by id; each bucket sends its tokens, packed, to
   their hash range, where those that occur twice are found and sent back. Both ways are shuffles; nothing is broadcast.
   Rows of equal sets are one class, and the class's smallest id goes on with the tokens it shares.
2. Order. Tokens are ordered by document frequency over the sets that are left, rare ones first.
3. Keys. Two similar sets share at least ``k`` tokens within their prefixes of ``n - ceil(0.8 * n) + k``. A rare token
   within the prefix for k = 1 is a key by itself. For frequent tokens (in ``FREQUENT`` sets or more) the prefix is
   extended to ``k = B + 1`` and its frequent tokens fall by hash into ``B`` groups: of B + 1 shared ones, two are in one
   group, so the pairs within groups are the keys. B grows with the set (a sixteenth of its power of two), so a set
   has about as many keys as prefix tokens, whatever its size. A pair of sets goes by the B of the smaller; a set takes
   part with the B of every size that it can meet, at most two.
4. Verification. In each key's group the best member (with the fewest unshared tokens) is compared with all others,
   and each set only with the best of all its groups: as many comparisons as sets. Then, in the groups that still span
   several components, all members outside the group's largest component are compared with all of the other
   components. Before that, bounds sort out pairs: by sizes, by shared tokens, and by the parity sketch of
   ``SKETCH`` bits, in which two sets differ at most as often as they differ in tokens. What is left is compared exactly.
5. Components by alternating stars.

Nulls: a null or wordless text has an empty set and is linked with nothing. A null doc_id takes no part and gets a null
component. Repeated rows each get a row; rows of one doc_id with different texts are one document with the links of all
of them. Fewer than five words are one shingle. Very long texts are single documents in their slice, so a task needs
memory for the longest text. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import dropped, table, written
from .components import connected_components
from .shared_tokens import Shared, shared_tokens

WORDS = 5
PERCENT = 80
#: From how many sets on a token counts as frequent.
FREQUENT = 32
#: A set of 2**c to 2**(c + 1) - 1 tokens deals its frequent ones into 2**c / GROUPING groups.
GROUPING = 16
SKETCH = 512
_SKETCHES = [f"b{k}" for k in range(SKETCH // 64)]

KEYED = "node long, doc_id long, n long, sig_a long, sig_b long, s long, tokens array<long>, keys array<long>, " + ", ".join(f"{b} long" for b in _SKETCHES)


def needed(n: np.ndarray | int):
    """The least overlap of a set of ``n`` with any similar one."""
    return -(-PERCENT * n // 100)


def shingles(t: ta.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Documents, in order, and the hashes of all their shingles."""
    starts, ends = t.spans(~ta.SPACE[t.data])
    docs, words = t.doc_of(starts), t.hashes(starts, ends)
    grams, at = ta.gram_hashes(words, docs, WORDS)
    gram_docs = docs[at]
    counts = np.bincount(docs, minlength=t.count)
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        first = np.concatenate(([0], np.cumsum(counts)))[short]
        whole = counts[short].astype(ta.U64) * ta._STEP
        for k in range(WORDS - 1):
            there = counts[short] > k
            whole[there] += words[first[there] + k] * ta._GRAM[k]
        grams, gram_docs = np.concatenate((grams, ta.mixed(whole))), np.concatenate((gram_docs, short))
        order = np.argsort(gram_docs, kind="stable")
        grams, gram_docs = grams[order], gram_docs[order]
    return gram_docs, grams


def shingle_sets(t: ta.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Documents and their distinct shingle hashes, ordered by both."""
    docs, grams = shingles(t)
    order = np.argsort(grams)
    order = order[np.argsort(docs[order].astype(np.uint16) if t.count <= 1 << 16 else docs[order], kind="stable")]
    docs, grams = docs[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    return docs[new], grams[new]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _per_doc(docs: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of unsigned values by document; ``docs`` in order."""
    out = np.zeros(count, ta.U64)
    if len(docs):
        firsts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        out[docs[firsts]] = np.add.reduceat(values, firsts)
    return out


SETS = "doc_id long, n long, sig_a long, sig_b long, tokens array<long>"


def _with_shared(t: ta.Texts, batch: pa.RecordBatch, shared: Shared) -> pa.RecordBatch:
    """Size and signature of each set; the shared tokens of those sets that may have a link."""
    docs, hashes = shingle_sets(t)
    n = np.bincount(docs, minlength=t.count)
    there = shared.holds(hashes)
    ids = batch.column(0)
    alive = (np.bincount(docs[there], minlength=t.count) >= needed(n)) & (n > 0) & ids.is_valid().to_numpy(zero_copy_only=False)
    chosen = there & alive[docs]
    sizes = np.bincount(docs[chosen], minlength=t.count)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32(), mask=np.append(~alive, False))
    tokens = pa.ListArray.from_arrays(offsets, pa.array(_signed(hashes[chosen])))
    sums = [_per_doc(docs, ta.mixed(hashes + ta.U64(k + 1) * ta._STEP), t.count) for k in range(2)]
    return pa.RecordBatch.from_arrays([ids, pa.array(n), *(pa.array(_signed(s)) for s in sums), tokens], names=[c.split()[0] for c in SETS.split(", ")])


def combination_keys(n: np.ndarray, place: np.ndarray, docs: np.ndarray, tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the document of each, of sets whose shared tokens stand in order at ``place``; ``n``: sizes by document."""
    room = n - needed(n)  # the prefix for k = 1 is one longer
    single = ~frequent & (place <= room[docs])
    keys, owners = [ta.mixed(tokens[single])], [docs[single]]
    size_class = lambda x: np.floor(np.log2(np.maximum(x, 1))).astype(np.int64)
    for own in (needed(n), n):
        cls = size_class(own)
        if own is not n:
            cls = np.where(cls == size_class(n), -1, cls)  # met with the other
        groups = np.maximum((1 << np.maximum(cls, 0)) // GROUPING, 1)
        at = np.flatnonzero(frequent & (cls[docs] >= 0) & (place <= (room + groups)[docs]))
        if not len(at):
            continue
        d, t = docs[at], tokens[at]
        g = (ta.mixed(t + ta._GRAM[59]) % groups[d].astype(ta.U64)).astype(np.int64)
        order = np.lexsort((at, g, d))  # by document and group, tokens in their order
        d, g, t = d[order], g[order], t[order]
        step = 1
        while True:  # each token with the one ``step`` places on in its group
            both = np.flatnonzero((d[step:] == d[:-step]) & (g[step:] == g[:-step]))
            if not len(both):
                break
            salt = (cls[d[both]] + 1).astype(ta.U64) * ta._STEP
            keys.append(ta.mixed(t[both] * ta._GRAM[60] + t[both + step] * ta._GRAM[61] + salt))
            owners.append(d[both])
            step += 1
    return np.concatenate(keys), np.concatenate(owners)


def sketches(docs: np.ndarray, tokens: np.ndarray, count: int) -> np.ndarray:
    """Per document the parities of its tokens' bit places, as 64-bit words."""
    bit = (ta.mixed(tokens + ta._GRAM[58]) >> ta.U64(40)).astype(np.int64) % SKETCH
    odd = np.bincount(docs * SKETCH + bit, minlength=count * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd.reshape(count, SKETCH), axis=1, bitorder="little").view("<i8")


def _keyed(often: int):
    """For mapInArrow over (node, doc_id, n, sig_a, sig_b, found): ``found`` are (frequency, token) in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                lists = batch.column(5)
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                tokens, frequency = flat.field(1).to_numpy().view(ta.U64), flat.field(0).to_numpy()
                count, n = len(batch), batch.column(2).to_numpy()
                docs = np.repeat(np.arange(count), sizes)
                place = np.arange(len(docs)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(n - sizes, sizes)
                keys, owners = combination_keys(n, place, docs, tokens, frequency >= often)
                order = np.argsort(owners, kind="stable")
                edges = np.searchsorted(owners[order], np.arange(count + 1))
                key_lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(_signed(keys[order])))
                token_lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(_signed(tokens)))
                words = sketches(docs, tokens, count)
                cols = [*batch.columns[:5], pa.array(sizes, pa.int64()), token_lists, key_lists, *(pa.array(words[:, k]) for k in range(words.shape[1]))]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in KEYED.split(", ")])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (a, b, total, x, y): the pairs whose sets, of ``total`` tokens in all, share enough."""
    for batch in batches:
        good = np.zeros(len(batch), bool)
        for k, (total, x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True)):
            both = np.concatenate((x.values.to_numpy(), y.values.to_numpy()))
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            good[k] = 100 * shared >= PERCENT * (total - shared)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar."""
    first, second = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"tokens_{c}")) for c in "ab")
    joined = pairs.join(first, "a").join(second, "b")
    return joined.select("a", "b", F.col("n_a") + F.col("n_b"), "tokens_a", "tokens_b").mapInArrow(_linked, "a long, b long")


def _enough(shared: Column | str, sizes: str) -> Column:
    """Whether ``shared`` tokens of two sets could do."""
    return F.expr(f"{100 + PERCENT} * ({shared}) >= {PERCENT} * ({sizes})")


def keyed_sets(rows: DataFrame) -> DataFrame:
    """One written row per class of equal sets that may have a link: its shared tokens, keys and sketch."""
    same = ["n", "sig_a", "sig_b"]
    alive = rows.where("tokens IS NOT NULL")
    least = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("doc_id"))
    chosen = alive.join(least, ["doc_id", *same], "left_semi").dropDuplicates(["doc_id", *same])
    # numbers of a written table stay, whatever is computed again
    chosen = written(chosen.withColumn("node", F.monotonically_increasing_id()), "classes")
    tokens = chosen.select("node", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("frequency")).where("frequency > 1")
    found = tokens.join(often, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("frequency", "token"))).alias("found"))
    sets = chosen.drop("tokens").join(found, "node").where(f"100 * size(found) >= {PERCENT} * n")
    out = written(sets.select("node", "doc_id", *same, "found").mapInArrow(_keyed(FREQUENT), KEYED), "sets")
    dropped(chosen)
    return out


def similar_links(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) nodes of similar sets, enough of them to give all components; and (node, component)."""
    postings = sets.select("node", "n", "s", F.explode("keys").alias("key"))
    groups = postings.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("unshared"), "node", "n", "s")).alias("best"), F.count("*").alias("members")).where("members > 1")
    postings = written(postings.join(groups, "key"), "postings")
    met = postings.where(F.col("node") != F.col("best.node")).where(_enough("least(s, best.s)", "n + best.n"))
    pairs = met.groupBy("node").agg(F.min("best").alias("best")).select(F.col("best.node").alias("a"), F.col("node").alias("b"))
    links = written(verified(sets, written(pairs, "pairs")), "links")
    labels = written(connected_components(links), "labels")

    # groups that span components
    labelled = postings.select("key", "node", "n", "s").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = labelled.groupBy("key", "component").count().groupBy("key").agg(F.max(F.struct("count", "component")).alias("largest"), F.count("*").alias("components")).where("components > 1")
    spread = written(labelled.join(spread.select("key", F.col("largest.component").alias("main")), "key"), "spread").join(sets.select("node", *_SKETCHES), "node")
    few = spread.where("component <> main").select("key", *(F.col(c).alias(f"f_{c}") for c in ("node", "n", "s", "component", *_SKETCHES)))
    differ = " + ".join(f"bit_count({b} ^ f_{b})" for b in _SKETCHES)
    cross = few.join(spread, "key").where("component <> f_component AND (component = main OR node < f_node)")
    cross = cross.where(_enough("least(s, f_s)", "n + f_n")).where(_enough(f"(s + f_s - ({differ})) div 2", "n + f_n"))
    more = written(verified(sets, cross.select(F.least("node", "f_node").alias("a"), F.greatest("node", "f_node").alias("b")).distinct()), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = written(connected_components(links), "labels")
    return links, labels


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = written(shared_tokens(docs, shingles, _with_shared, SETS, lower=True), "rows")
    sets = keyed_sets(rows)
    _, labels = similar_links(sets)
    same = ["n", "sig_a", "sig_b"]
    named = sets.select("node", "doc_id", *same).join(labels, "node")
    ids = named.join(named.groupBy("component").agg(F.min("doc_id").alias("linked")), "component").select(*same, "linked")
    least = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("least"))
    classes = least.join(ids, same, "left").select(*same, F.coalesce("linked", "least").alias("class_id"))
    found = rows.select("doc_id", *same).join(classes, same, "left")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"))
    return _one_per_id(written(found, "components"))


def _one_per_id(found: DataFrame) -> DataFrame:
    """Joins the components that share a doc_id, where rows of one doc_id hold different texts."""
    several = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo <> hi")
    several = written(several.select("doc_id", "lo"), "several")
    if several.isEmpty():
        return found
    edges = found.join(several, "doc_id").select(F.col("component_id").alias("a"), F.col("lo").alias("b")).distinct()
    renamed = written(connected_components(edges), "renamed").select(F.col("node").alias("component_id"), F.col("component").alias("joint"))
    return found.join(renamed, "component_id", "left").select("doc_id", "n_shingles", F.coalesce("joint", "component_id").alias("component_id"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))
