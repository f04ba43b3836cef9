"""The prefix trie of conversations, from an LCP-aware mergesort over range partitions.

A conversation is a row of turn digests. A range shuffle on (digests, id) deals them over tasks in order. A task cuts
what it gets into sorted runs, each entry with its LCP (shared leading turns) to the one before; a loser tree merges
the runs, where entries are compared by their LCPs to the last winner, and turns are read only from where these are
equal. The merged stream gives the nodes: an open-path stack holds the nodes of the entry at hand, and whatever the
next entry doesn't share is finished.

Nodes on the first or last path of a task may go on in its neighbours. They are the only ones that leave a task
unfinished, in preorder, with what the finished part below them adds up to; one more pass over these partial nodes, in
the order of tasks, finishes them by the same stack. It reads two paths a task and holds one path at a time, and the
ids of conversations that end in a copied node stream through it, as SHA-256 is sequential. Children of such nodes get
their parent's smallest id by a join on (task, node), so no parent is a hot key.

A task gets about ``TASK_TURNS`` turns, 16 bytes each; ids of copies are bounded by that too. The turns of a single
conversation are brought together (16 bytes a turn): one must fit in a task.

Nulls: a null role or text is empty; null turns come first. Equal turns of a conversation are ordered by the digest of
role and text. Rows with a null conversation id belong to none and make no node. Repeated rows are turns of their own.
Empty and very long texts are turns like others. An empty table has no conversations and no nodes, not even a root.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, table, written
from .op1_hilbert_shards import _crc_table

#: Bytes of a turn's digest, conversations of a sorted run, and turns that a task gets about.
WIDTH, RUN, TASK_TURNS = 16, 1024, 1 << 17
#: Turns taken over at most, and ids that share a donor.
MOST_SHARED, DONOR = 8, 5
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: What a task gives: nodes with their parent's id or, below a node that other tasks may share, its key; partial nodes.
FOUND = f"{NODE}, task long, place long, partial boolean, node binary, parent binary, last_bytes long, ends string"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): digests of the rebuilt turns joined, and the UTF-8 bytes of each text.

    The first h turns come from conversation c - c % 5, the rest are c's own after its first h; h = crc32(c) % 9.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH)).alias("d"), F.octet_length(text).cast("long").alias("b"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "d", "b"))).alias("turns"))
    own = written(own, "trie-turns")
    donors = own.select(F.col("conv_id").alias("donor"), F.slice("turns", 1, MOST_SHARED).alias("lent")).where(f"donor % {DONOR} = 0")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    rows = own.withColumn("h", h).withColumn("donor", F.expr(f"conv_id - conv_id % {DONOR}")).join(donors, "donor", "left")
    none = F.array().cast(own.schema["turns"].dataType)
    taken = F.when(F.col("h") > 0, F.slice(F.coalesce("lent", none), F.lit(1), F.col("h"))).otherwise(none)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    rows = rows.select("conv_id", F.concat(taken, rest).alias("turns"))
    return rows.select("conv_id", _joined(F.transform("turns", lambda t: t["d"])).alias("key"), F.transform("turns", lambda t: t["b"]).alias("sizes"))


def _joined(digests: Column) -> Column:
    return F.unhex(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""))


def lcp(a: bytes, b: bytes, start: int = 0) -> int:
    """Leading turns that two keys share, the first ``start`` known to be."""
    most = min(len(a), len(b)) // WIDTH
    step = 1
    while start < most:  # doubling steps, so that long shared paths cost few comparisons
        end = min(most, start + step)
        if a[start * WIDTH : end * WIDTH] == b[start * WIDTH : end * WIDTH]:
            start, step = end, 2 * step
        elif step == 1:
            break
        else:
            step = 1 if end - start <= 2 else (end - start) // 2
    return start


Entry = tuple[bytes, int, list]


def sorted_run(entries: list[Entry]) -> list[tuple[int, Entry]]:
    """Entries (key, id, sizes) in order, each with its LCP to the one before."""
    entries = sorted(entries, key=lambda e: e[:2])
    return [(lcp(entries[k - 1][0], e[0]) if k else 0, e) for k, e in enumerate(entries)]


class LoserTree:
    """Merges sorted runs; ``compared`` counts the turns from which comparisons were made."""

    def __init__(self, runs: list[list[tuple[int, Entry]]]):
        self.runs, self.compared = [iter(r) for r in runs], 0
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.head = [next(r, None) for r in self.runs] + [None] * (self.size - len(runs))
        self.loser = [0] * self.size
        winners = [*[0] * self.size, *range(self.size)]
        for node in range(self.size - 1, 0, -1):
            winners[node], self.loser[node] = self._played(winners[2 * node], winners[2 * node + 1])
        self.winner = winners[1]

    def _played(self, i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads, whose LCPs are to the same earlier winner; the loser's becomes that to
        the winner."""
        a, b = self.head[i], self.head[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if a[0] != b[0]:  # the longer LCP is the smaller entry, and the loser's stays right
            return (i, j) if a[0] > b[0] else (j, i)
        shared = lcp(a[1][0], b[1][0], a[0])
        self.compared += 1 + shared - a[0]
        at = slice(shared * WIDTH, (shared + 1) * WIDTH)
        first = (a[1][0][at], a[1][1], i) <= (b[1][0][at], b[1][1], j)
        won, lost = (i, j) if first else (j, i)
        self.head[lost] = (shared, self.head[lost][1])
        return won, lost

    def __iter__(self) -> Iterator[tuple[int, Entry]]:
        while (best := self.head[self.winner]) is not None:
            yield best
            at = self.winner
            self.head[at] = next(self.runs[at], None)
            node = (at + self.size) // 2
            while node:
                at, self.loser[node] = self._played(at, self.loser[node])
                node //= 2
            self.winner = at


class Node:
    """A node on the open path. ``found``: finished children waiting for this node's smallest id."""

    __slots__ = ("hash", "size", "first", "members", "children", "leaves", "saved", "ends", "found", "edge", "place")

    def __init__(self, path_hash, size: int, edge: bool, place: int):
        self.hash, self.size, self.edge, self.place = path_hash, size, edge, place
        self.first, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.found = [], []

    @property
    def key(self) -> bytes:
        """A name of fixed size for the turns that lead here."""
        return self.hash.digest()


def _closed(node: Node, depth: int) -> tuple:
    """(conv_id, depth, None for the parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    leaves, saved = node.leaves + (node.children == 0), node.saved + (node.members - 1) * node.size
    return (node.first, depth, None, node.members, node.children, leaves, saved, hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest())


def nodes_of(merged: Iterator[tuple[int, Entry]], last_key: bytes | None) -> Iterator[tuple]:
    """Rows of FOUND without the task: finished nodes, and partial ones where the first or the last path passes.

    ``last_key``: the key that comes last, so that its path is known while the stream runs.
    """
    path: list[Node] = []
    place, first = 0, None

    def finish(depth: int) -> Iterator[tuple]:
        node = path.pop()
        if path:
            up = path[-1]
            up.members, up.first = up.members + node.members, node.first if up.first is None else min(up.first, node.first)
        if node.edge:  # its own size and members are counted once all its parts have met
            yield (node.first, depth, None, node.members, node.children, node.leaves, node.saved, None, node.place, True, node.key, path[-1].key if path else None, node.size, ",".join(map(str, node.ends)))
            for row in node.found:
                yield (*row, 0, False, None, node.key, None, None)
            return
        row = _closed(node, depth)
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + row[5], up.saved + row[6]
        up.found.append(row)
        for child in node.found:
            yield (*child[:2], node.first, *child[3:], 0, False, None, None, None, None)

    for shared, (key, conv, sizes) in merged:
        first = key if first is None else first
        while len(path) > shared + 1:
            yield from finish(len(path) - 1)
        edge = max(lcp(key, first), lcp(key, last_key))
        for depth in range(len(path), len(key) // WIDTH + 1):
            path_hash = path[-1].hash.copy() if path else hashlib.sha256()
            path_hash.update(key[(depth - 1) * WIDTH : depth * WIDTH] if depth else b"")
            path.append(Node(path_hash, sizes[depth - 1] if depth else 0, depth <= edge, place))
            place += 1
        at = path[-1]
        at.members, at.first = at.members + 1, conv if at.first is None else min(at.first, conv)
        at.ends.append(conv)
    while path:
        yield from finish(len(path) - 1)


_FOUND_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
_FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _batches(rows: Iterator[tuple], types: list[pa.DataType], names: list[str], most: int = 1 << 12) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def merged_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over a range of (conv_id, key, sizes): the nodes of that range."""
    runs, held = [], []
    for batch in batches:
        held += zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
        while len(held) >= RUN:
            runs.append(sorted_run(held[:RUN]))
            held = held[RUN:]
    if held:
        runs.append(sorted_run(held))
    task = TaskContext.get().partitionId()
    last = max((r[-1][1][0] for r in runs), default=None)
    rows = nodes_of(iter(LoserTree(runs)), last) if runs else iter(())
    yield from _batches(((*r[:8], task, *r[8:]) for r in rows), _FOUND_TYPES, _FOUND_NAMES)


def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over the partial nodes of all tasks, in order: each finished, with its key and its parent's."""
    path: list[list] = []  # key, parent, depth, first, members, children, leaves, saved, size, hash of ends, ends so far

    def finish() -> tuple:
        key, parent, depth, first, members, children, leaves, saved, size, ends, _ = path.pop()
        leaves, saved = leaves + (children == 0), saved + (members - 1) * size
        if path:
            up = path[-1]
            up[5], up[6], up[7] = up[5] + 1, up[6] + leaves, up[7] + saved
        return (first, depth, None, members, children, leaves, saved, ends.hexdigest(), key, parent)

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for r in batch.to_pylist():
                # a node that is open already goes on, and what is open below it may go on with the next rows
                while len(path) > r["depth"] and path[r["depth"]][0] != r["node"]:
                    yield finish()
                if len(path) == r["depth"]:
                    path.append([r["node"], r["parent"], r["depth"], r["conv_id"], 0, 0, 0, 0, r["last_bytes"], hashlib.sha256(), False])
                at = path[r["depth"]]
                at[3] = min(at[3], r["conv_id"])
                for k, c in ((4, "n_convs"), (5, "n_children"), (6, "n_leaves"), (7, "saved_tokens")):
                    at[k] += r[c]
                if r["ends"]:
                    at[9].update((("," if at[10] else "") + r["ends"]).encode())
                    at[10] = True
        while path:
            yield finish()

    yield from _batches(rows(), [*[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary()], [*_FOUND_NAMES[:8], "node", "parent"])


def prefix_trie(sequences: DataFrame, task_turns: int = TASK_TURNS) -> DataFrame:
    """The nodes of the trie over (conv_id, key, sizes)."""
    spark = sequences.sparkSession
    rows = written(sequences, "trie-sequences")
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    n = max(1, -(-turns // task_turns), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // RUN)))
    found = written(rows.repartitionByRange(n, "key", "conv_id").mapInArrow(merged_nodes, FOUND), "trie-found")
    names = _FOUND_NAMES[:8]
    partial = found.where("partial")
    # preorder within a task: parents come before their children by their places
    whole = written(partial.repartition(1).sortWithinPartitions("task", "place").mapInArrow(stitched, f"{NODE}, node binary, parent binary"), "trie-stitched")
    smallest = whole.select(F.col("node").alias("_node"), F.col("conv_id").alias("_first"))
    parents = partial.select("task", "node").join(smallest, F.col("node") == F.col("_node")).select("task", F.col("node").alias("parent"), "_first")
    below = found.where("NOT partial AND parent IS NOT NULL").join(parents, ["task", "parent"]).withColumn("parent_conv_id", F.col("_first"))
    tops = whole.join(smallest, F.col("parent") == F.col("_node"), "left").withColumn("parent_conv_id", F.col("_first"))
    out = found.where("NOT partial AND parent IS NULL").select(names).unionAll(below.select(names)).unionAll(tops.select(names))
    dropped(rows)
    return out


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
SQL = f"""
WITH crc_table AS (SELECT {_crc_table()} AS t),
turns AS (SELECT conv_id, turn, strlen(coalesce(text, '')) AS b, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS k FROM turns),
convs AS (SELECT conv_id, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
steps AS (
  SELECT c.conv_id, n.k AS pos, n.d, n.b FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 AND n.k <= c.h
  UNION ALL SELECT c.conv_id, 100 + n.k, n.d, n.b FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.k > c.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, d, b FROM steps),
prefixes AS (
  SELECT conv_id, depth, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth) AS name, b FROM placed
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT name, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
    sha256(coalesce(string_agg(CASE WHEN depth = length THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY name, depth),
tied AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.name = left(n.name, len(n.name) - 64)),
counted AS (SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.name, len(c.name) - 64) = n.name) AS n_children FROM tied n),
sums AS (
  SELECT a.name, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.b) AS saved_tokens
  FROM counted n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.name)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (name)
"""
