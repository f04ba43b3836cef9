"""Sharding along a Hilbert curve, in DataFrame operations alone.

Metadata dimensions are quantised to a few bits each, the curve index of the cell is computed with Column arithmetic,
rows are ordered by (index, id) by a range shuffle, and the order is cut into runs. Rows near each other in every
dimension land in the same few shards, so the per-shard minima and maxima (``shard_manifest``) prune on any of them.

Cutting follows the law ``rows``: shard k takes the rows with rank in [k*n/shards, (k+1)*n/shards), so counts differ by
one at most. The range shuffle orders by the unique id within a cell, so a cell that holds a third of all rows still
spreads over partitions. Ranks come from row counts per partition (as many rows as partitions), never from a window
over all rows.

Nulls: a null text has no bytes (size 8, crc of the empty text), a null dimension is quantised to cell 0, a null id
sorts first in its cell. Repeated rows keep a slot each. An empty table gives an empty result. Extra columns of the
input are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

SHARDS = 24
BITS = 5


def log_cell(col: Column, bits: int = BITS) -> Column:
    """Half octaves of a non-negative number, capped to ``bits`` bits; order is kept."""
    value = F.greatest(F.coalesce(col, F.lit(0)).cast("double"), F.lit(0.0))
    return F.least(F.floor(2 * F.log2(value + 1)), F.lit((1 << bits) - 1)).cast("int")


def name_cell(col: Column, bits: int = BITS) -> Column:
    """A cell for a category; equal names share it, so an equality predicate prunes."""
    return F.coalesce(F.pmod(F.crc32(col.cast("binary")), F.lit(1 << bits)), F.lit(0)).cast("int")


def hilbert_steps(cells: list[str], bits: int, xor: str = "({} ^ {})") -> list[tuple[str, str]]:
    """The transform from axes to the transposed curve index (Skilling 2004), as assignments over integer columns.

    ``xor``: how the SQL dialect writes it.
    """
    n, steps = len(cells), []
    of = xor.format
    x = list(cells)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if i == 0:
                steps.append((x[0], f"CASE WHEN {x[0]} & {q} <> 0 THEN {of(x[0], p)} ELSE {x[0]} END"))
            else:
                swap = f"({of(x[0], x[i])} & {p})"
                steps.append(("_t", f"CASE WHEN {x[i]} & {q} <> 0 THEN 0 ELSE {swap} END"))
                steps.append((x[0], f"CASE WHEN {x[i]} & {q} <> 0 THEN {of(x[0], p)} ELSE {of(x[0], '_t')} END"))
                steps.append((x[i], of(x[i], "_t")))
        q >>= 1
    for i in range(1, n):
        steps.append((x[i], of(x[i], x[i - 1])))
    steps.append(("_t", reduce(of, (f"(CASE WHEN {x[n - 1]} & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)" for b in range(1, bits)))))
    steps += [(c, of(c, "_t")) for c in x]
    return steps


def hilbert_index(df: DataFrame, cells: list[str], out: str, bits: int = BITS) -> DataFrame:
    """Adds the curve index of integer columns with values below 2**bits."""
    work = [f"_h{i}" for i in range(len(cells))]
    df = df.withColumns({w: F.col(c).cast("int") for w, c in zip(work, cells, strict=True)})
    for name, expr in hilbert_steps(work, bits):
        df = df.withColumn(name, F.expr(expr))
    pieces = [F.shiftleft(F.shiftright(F.col(w), b).bitwiseAND(F.lit(1)).cast("long"), b * len(work) + len(work) - 1 - i) for b in range(bits) for i, w in enumerate(work)]
    return df.withColumn(out, reduce(Column.bitwiseOR, pieces)).drop("_t", *work)


def ranked(df: DataFrame, order: list[str], partitions: int | None = None) -> tuple[DataFrame, int]:
    """Adds ``rank``, the place from 0 in the order of unique columns; also returns the row count.

    The range-partitioned rows are written once, as boundaries drawn again for a second job could differ.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = written(rows.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", 33)
    counts = sorted((r[0], r[1]) for r in rows.groupBy(part.alias("p")).count().collect())  # a row per partition
    starts, seen = [], 0
    for p, count in counts:
        starts.append((p, seen))
        seen += count
    if not starts:
        return rows.withColumn("rank", F.lit(0).cast("long")).drop("_place"), 0
    before = spark.createDataFrame(starts, "_p long, _before long")
    joined = rows.withColumn("_p", part).join(F.broadcast(before), "_p")
    return joined.withColumn("rank", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).drop("_p", "_before", "_place"), seen


def hilbert_shards(df: DataFrame, dimensions: dict[str, Column], id_col: str, shards: int = SHARDS, bits: int = BITS, keep: list[Column] | None = None) -> DataFrame:
    """One row per input row: id, the columns of ``keep``, the cells, the curve index, shard and slot.

    ``dimensions`` maps a cell name to a Column with values in [0, 2**bits).
    """
    rows = df.select(F.col(id_col), *(keep or []), *(c.alias(k) for k, c in dimensions.items()))
    rows = hilbert_index(rows, list(dimensions), "curve", bits)
    order = ["curve", id_col, *(c for c in rows.columns if c not in ("curve", id_col))]
    rows, n = ranked(rows, order)
    if not n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).drop("rank")
    # the first rank r with r * shards >= k * n opens shard k
    shard = F.expr(f"CAST((rank * {shards}) DIV {n} AS INT)")
    first = F.expr(f"(shard * {n}L + {shards - 1}) DIV {shards}")
    return rows.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank")


def shard_manifest(sharded: DataFrame, cells: list[str]) -> DataFrame:
    """Per shard the rows and the range of each cell: what a reader needs to skip files."""
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *(f(c).alias(f"{tag}_{c}") for c in cells for f, tag in ((F.min, "min"), (F.max, "max"))))


def document_dimensions() -> dict[str, Column]:
    return {"lang_cell": name_cell(F.col("lang")), "source_cell": name_cell(F.col("source")), "length_cell": log_cell(F.col("n_chars"))}


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = [(F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    rows = hilbert_shards(table(spark, sf_dir, "documents"), document_dimensions(), "doc_id", keep=keep)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve", "lang_cell", "source_cell", "length_cell")


def _crc_table() -> list[int]:
    """CRC-32's table, by its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _oracle() -> str:
    """The query in DuckDB's SQL, where CRC-32 and the curve are written out."""

    def crc(text: str) -> str:
        bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
        step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
        return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: {step}), 4294967295)"

    cells = ["lang_cell", "source_cell", "length_cell"]
    work = [f"_h{i}" for i in range(len(cells))]
    stage, ctes = "celled", []
    for k, (name, expression) in enumerate(hilbert_steps(work, BITS, "xor({}, {})")):
        kept = [w for w in (*work, "_t") if w != name and not (w == "_t" and k == 0)]
        ctes.append(f"s{k} AS (SELECT doc_id, {', '.join(kept)}, {expression} AS {name} FROM {stage})")
        stage = f"s{k}"
    n = len(work)
    index = " + ".join(f"(CAST(({w} >> {b}) & 1 AS BIGINT) << {b * n + n - 1 - i})" for b in range(BITS) for i, w in enumerate(work))
    return f"""
WITH crc_table AS (SELECT {_crc_table()} AS t),
docs AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {crc("coalesce(text, '')")} AS text_crc32, lang, source, n_chars FROM documents, crc_table),
names AS (SELECT name, CAST({crc("name")} % {1 << BITS} AS INT) AS cell FROM (SELECT lang AS name FROM documents UNION SELECT source FROM documents), crc_table WHERE name IS NOT NULL),
cells AS (SELECT d.doc_id, coalesce(a.cell, 0) AS lang_cell, coalesce(b.cell, 0) AS source_cell, CAST(least(floor(2 * log2(greatest(coalesce(n_chars, 0), 0) + 1)), {(1 << BITS) - 1}) AS INT) AS length_cell
  FROM docs d LEFT JOIN names a ON a.name = d.lang LEFT JOIN names b ON b.name = d.source),
celled AS (SELECT doc_id, {', '.join(f'{c} AS {w}' for c, w in zip(cells, work, strict=True))} FROM cells),
{', '.join(ctes)},
curves AS (SELECT doc_id, {index} AS curve FROM {stage}),
ranked AS (SELECT doc_id, curve, row_number() OVER (ORDER BY curve, doc_id) - 1 AS rank, count(*) OVER () AS n FROM curves),
sharded AS (SELECT *, (rank * {SHARDS}) // n AS shard FROM ranked)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(d.text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(s.shard AS INT) AS shard, CAST(s.rank - (s.shard * s.n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard,
  s.curve, c.lang_cell, c.source_cell, c.length_cell
FROM docs d JOIN sharded s USING (doc_id) JOIN cells c USING (doc_id)
"""


SQL = _oracle()
