"""A Merkle manifest of a dataset, and membership proofs by looking up coordinates in the materialised node table.

Every row is a leaf: the SHA-256 of its columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
The leaves of a group (a source) ascend by id; ``FAN`` consecutive nodes make one node of the next level, until one
is left, the subroot; subroots by group make the root in the same way. A coordinate is (tree, level, run of ``FAN``
nodes); the node table holds each run's digests once.

A leaf's proof is what stands beside it: coordinates of its siblings follow from its index and the sizes of its group
and of the tree of subroots, and are exploded and joined to the node table. Leaves of one run ask alike above level 0,
so a run asks for them; runs of ``BLOCK`` leaves ask alike above level ``BLOCK_LEVEL``, so a block asks for those. No
coordinate is asked for by more than ``BLOCK / FAN`` rows but those that blocks ask for, 1/4096 of the leaves.

Order and indexes come from a range shuffle on (group, id, leaf) with counts per partition, so a group of any size is
spread over tasks. To the driver go counts per partition, the largest group's size, the number of groups and the root.

Nulls: each is written ``-``; null groups come first, null ids first within a group. Rows of one id are ordered by
leaf, and repeated rows are leaves of their own. Empty and very long texts are hashed as they are. An empty table
gives no rows. A tampered row with a null id can't be chosen, as its id has no decimal form. Extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, table, written
from .op1_hilbert_shards import _crc_table, ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run, levels of the leaves' own tree that runs ask for, and leaves that share all coordinates above them.
FAN, BLOCK_LEVEL = 16, 2
BLOCK = FAN ** (BLOCK_LEVEL + 1)
#: The tree of subroots; groups are numbered from 0.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(columns: list[str], **changed: Column) -> Column:
    return digest(*(field(changed.get(c, F.col(c))) for c in columns))


def folded(start: Column, levels: Column) -> Column:
    """``start`` hashed with its siblings level by level; levels: array of (before, after), joined digests."""
    return F.aggregate(levels, start, lambda node, level: digest(level["before"], node, level["after"]))


def _indexed(leaves: DataFrame, group: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves with tree, idx and n (size of the tree); the table of trees (tree, group, n); the ranked table behind both."""
    rows, _ = ranked(leaves, [group, id_col, "leaf"])
    sizes = rows.groupBy(group).agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    groups, _ = ranked(sizes, [group])
    groups = written(groups.select(F.col("rank").alias("tree"), group, "first", "n"), "merkle-groups")
    # a third of all leaves may share a group; the other side is one row a group, so a split partition is no burden
    same = rows[group].eqNullSafe(groups[group])
    return rows.join(groups, same).select("tree", (F.col("rank") - F.col("first")).alias("idx"), "n", *(rows[c] for c in leaves.columns)), groups, rows


def _run_nodes(nodes: DataFrame, level: int) -> DataFrame:
    """Runs of one level: (tree, level, run, digests in order, size of the level)."""
    run = F.expr(f"idx DIV {FAN}").alias("run")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"])
    return nodes.groupBy("tree", run).agg(in_order.alias("nodes"), F.max("n").alias("n")).select("tree", F.lit(level).alias("level"), "run", "nodes", "n")


def _tree(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level of all trees, as written tables, and the last nodes (tree, node).

    ``nodes``: (tree, idx, node, n), n being the tree's size; ``most``: the largest size.
    """
    levels, tops, level = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", "node"))
        if most <= 1:
            return levels, reduce(DataFrame.unionAll, tops)
        levels.append(written(_run_nodes(nodes.where("n > 1"), level), f"merkle-level{level}"))
        nodes = levels[-1].select("tree", F.col("run").alias("idx"), digest(F.array_join("nodes", "")).alias("node"), F.ceil(F.col("n") / FAN).alias("n"))
        most, level = -(-most // FAN), level + 1


def _depth(n: Column) -> Column:
    """Levels with more than one node in a tree of n leaves."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda d, k: d + F.when(F.pow(F.lit(float(FAN)), (k - 1).cast("double")) < n, 1).otherwise(0))


def _coordinates(tree: Column, idx: Column, first: Column, last: Column) -> Column:
    """Coordinates of the node above leaf ``idx`` on the levels from first to below last: (tree, level, run, at)."""
    level_index = lambda k: F.floor(idx / F.pow(F.lit(float(FAN)), k.cast("double"))).cast("long")
    levels = F.when(first < last, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(levels, lambda k: F.struct(tree.alias("tree"), k.alias("level"), F.floor(level_index(k) / FAN).cast("long").alias("run"), (level_index(k) % FAN).cast("int").alias("at")))


def _beside(nodes: Column, at: Column) -> Column:
    """(before, after): the digests of a run around place ``at``, joined."""
    return F.struct(F.array_join(F.slice(nodes, F.lit(1), at), "").alias("before"), F.array_join(F.slice(nodes, at + 2, F.lit(FAN)), "").alias("after"))


def _looked_up(askers: DataFrame, key: list[str], coordinates: Column, nodes: DataFrame, out: str) -> DataFrame:
    """Per asker its levels (before, after) in order, by exploding coordinates and joining the node table."""
    asked = askers.select(*key, F.explode(coordinates).alias("c")).select(*key, "c.*")
    found = asked.join(nodes, ["tree", "level", "run"]) if "tree" not in key else asked
    return found.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct((F.col("tree") == TOP).alias("top"), "level", _beside(F.col("nodes"), F.col("at")).alias("beside")))).alias(out))


def manifest(docs: DataFrame, columns: list[str], id_col: str, group: str, changed: dict[str, Column] | None = None, tampered: Column | None = None) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``tampered`` chooses rows that are verified after ``changed`` replaced some of their columns; the tree is built
    of the original rows.
    """
    spark = docs.sparkSession
    again = F.when(tampered, leaf_digest(columns, **(changed or {}))) if tampered is not None else F.lit(None).cast("string")
    indexed, groups, behind = _indexed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(group).alias("grp"), leaf_digest(columns).alias("leaf"), again.alias("tampered")), "grp", "id")
    leaves = written(indexed, "merkle-leaves")
    stats = groups.agg(F.count("*"), F.max("n")).first()
    n_groups, most = stats[0], stats[1] or 0
    levels, subroots = _tree(leaves.select("tree", "idx", F.col("leaf").alias("node"), "n"), most)
    subroots = written(subroots, "merkle-subroots")
    tops, root = _tree(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "node", F.lit(n_groups).cast("long").alias("n")), n_groups)
    found = root.first()
    nodes = reduce(DataFrame.unionAll, [*levels, *tops]).drop("n") if levels or tops else spark.createDataFrame([], "tree long, level int, run long, nodes array<string>")

    # what whole blocks share: the levels above BLOCK_LEVEL, then the tree of subroots
    blocks = groups.select("tree", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) DIV {BLOCK}"))).alias("block"))
    top_depth, none = _depth(F.lit(n_groups)), F.array().cast("array<struct<top:boolean,level:int,beside:struct<before:string,after:string>>>")
    upper = F.concat(_coordinates(F.col("owner"), F.col("block") * BLOCK, F.lit(BLOCK_LEVEL + 1), _depth(F.col("n"))), _coordinates(F.lit(TOP).cast("long"), F.col("owner"), F.lit(0), top_depth))
    by_block = _looked_up(blocks.withColumnRenamed("tree", "owner"), ["owner", "block"], upper, nodes, "upper")
    # what runs share: the levels from 1 to BLOCK_LEVEL; a lone leaf asks for none
    runs = groups.where("n > 1").select(F.col("tree").alias("owner"), "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) DIV {BLOCK}"))).alias("block"))
    runs = runs.select("owner", "n", F.explode(F.sequence(F.col("block") * (BLOCK // FAN), F.least((F.col("block") + 1) * (BLOCK // FAN) - 1, F.expr(f"(n - 1) DIV {FAN}")))).alias("run0"))
    lower = _coordinates(F.col("owner"), F.col("run0") * FAN, F.lit(1), F.least(_depth(F.col("n")), F.lit(BLOCK_LEVEL + 1)))
    by_run = _looked_up(runs, ["owner", "run0"], lower, nodes, "lower")
    paths = blocks.select(F.col("tree").alias("owner"), "n", "block").join(by_block, ["owner", "block"], "left")
    paths = paths.select("owner", "n", F.explode(F.sequence(F.col("block") * (BLOCK // FAN), F.least((F.col("block") + 1) * (BLOCK // FAN) - 1, F.expr(f"(n - 1) DIV {FAN}")))).alias("run0"), F.coalesce("upper", none).alias("upper"))
    paths = paths.join(by_run, ["owner", "run0"], "left")
    own = nodes.where((F.col("level") == 0) & (F.col("tree") != TOP)).select(F.col("tree").alias("owner"), F.col("run").alias("run0"), "nodes")
    paths = paths.join(own, ["owner", "run0"], "left").select(F.col("owner").alias("tree"), "run0", "nodes", F.transform(F.concat(F.coalesce("lower", none), "upper"), lambda x: x["beside"]).alias("above"))

    keyed = leaves.withColumn("run0", F.expr(f"idx DIV {FAN}")).join(paths, ["tree", "run0"]).join(subroots.select("tree", F.col("node").alias("subroot")), "tree")
    first = F.when(F.col("nodes").isNotNull(), F.array(_beside(F.col("nodes"), (F.col("idx") % FAN).cast("int")))).otherwise(F.array().cast("array<struct<before:string,after:string>>"))
    keyed = keyed.select("id", "leaf", "subroot", F.coalesce("tampered", "leaf").alias("shown"), F.concat(first, "above").alias("proof"))
    whole = F.array_join(F.flatten(F.transform("proof", lambda p: F.array(p["before"], p["after"]))), "")
    out = keyed.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(found[1] if found else None).cast("string").alias("root"), F.sha2(whole.cast("binary"), 256).alias("proof_sha256"), folded(F.col("shown"), F.col("proof")).alias("folded_root"))
    dropped(behind)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(table(spark, sf_dir, "documents"), list(FIELDS), "doc_id", "source", {"text": F.translate("text", UPPER, LOWER)}, tampered)


def _oracle(levels: int = 6) -> str:
    """The query in DuckDB's SQL with its levels written out, for up to 16**levels leaves a source."""
    bytes_ = "list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    part = lambda c, v: f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c, text if c == "text" else c) for c in FIELDS) + ")"
    ctes = [
        f"crc_table AS (SELECT {_crc_table()} AS t)",
        f"base AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(f'''translate(text, '{UPPER}', '{LOWER}')''')} ELSE {leaf('text')} END AS shown FROM documents, crc_table)",
        "leaves AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM base)",
        "n0 AS (SELECT tree, idx, leaf AS node FROM leaves)",
    ]

    def tree(name: str, partition: str, depth: int) -> None:
        for k in range(depth):
            at = f"{name}{k}"
            ctes.append(f"{name}r{k} AS (SELECT {partition} idx // {FAN} AS run, list(node ORDER BY idx) AS nodes, max(size) AS size FROM (SELECT *, count(*) OVER ({'PARTITION BY tree' if partition else ''}) AS size FROM {at}) GROUP BY ALL)".replace("GROUP BY ALL", f"GROUP BY {partition} idx // {FAN}"))
            ctes.append(f"{name}{k + 1} AS (SELECT {partition} run AS idx, CASE WHEN size > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {name}r{k})")

    tree("n", "tree,", levels)
    ctes.append(f"t0 AS (SELECT tree AS idx, node FROM n{levels})")
    tree("t", "", 3)
    stage = f"SELECT doc_id, leaf, shown AS node, '' AS proof, l.tree, l.idx, s.node AS subroot, r.node AS root FROM leaves l JOIN n{levels} s USING (tree), t3 r"
    ctes.append(f"p0 AS ({stage})")
    before, after = "array_to_string(nodes[1:place], '')", f"array_to_string(nodes[place + 2:{FAN}], '')"
    for k in range(levels + 3):
        own = k < levels
        runs, index = (f"nr{k}", f"idx // {FAN**k}") if own else (f"tr{k - levels}", f"tree // {FAN ** (k - levels)}")
        on = f"{'x.tree = r.tree AND ' if own else ''}r.run = ({index}) // {FAN}"
        ctes.append(f"p{k + 1} AS (SELECT doc_id, leaf, CASE WHEN size > 1 THEN sha256({before} || node || {after}) ELSE node END AS node, CASE WHEN size > 1 THEN proof || {before} || {after} ELSE proof END AS proof, tree, idx, subroot, root FROM (SELECT x.*, r.nodes, r.size, ({index}) % {FAN} AS place FROM p{k} x JOIN {runs} r ON {on}))")
    last = f"p{levels + 3}"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM {last}"


SQL = _oracle()
