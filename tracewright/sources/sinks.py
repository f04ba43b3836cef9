"""Releases on disk: JSON lines, CSV, several outputs of one table, manifests, and publication in one step.

Spark's commit protocol makes each output whole; a release is written beside its place and moved there at the end through
the Hadoop file system, so readers see all of it or nothing. Nothing is collected but manifests (a row per output).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Compact JSON lines, characters unescaped and nulls written; an output that is there already is an error."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, joint: str = "|") -> None:
    """CSV with a header; arrays of texts joined by ``joint``; the first column's name begins with a byte order mark, by
    which spreadsheet programs tell UTF-8."""
    flat = [F.array_join(c, joint).alias(c) if kind.startswith("array<") else F.col(c) for c, kind in df.dtypes]
    out = df.select(*flat)
    out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0]).write.mode("errorifexists").option("header", "true").csv(path)


def routed(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; a row without a verdict is an error when either is read."""
    verdict = F.when(accepted.isNull(), F.raise_error(F.lit("a row has no verdict"))).otherwise(accepted)
    return df.where(verdict), df.where(~verdict)


def manifest(outputs: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(output, rows, digest) of each output; the digest is of the sum of row hashes, so it needs no order."""
    frames = []
    for name, df in outputs.items():
        text = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in keys))
        value = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
        frames.append(df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0)).cast("string").alias("digest")).select(F.lit(name).alias("output"), "rows", "digest"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def published(outputs: dict[str, DataFrame], folder: str, keys: list[str], policy: dict | None = None, write: Callable[[DataFrame, str], None] = write_jsonl) -> DataFrame:
    """Writes all outputs and their manifest into a new folder, all or nothing; returns the manifest as read back.

    A folder that is there already is an error, before anything is written and again when the release is moved.
    """
    spark = next(iter(outputs.values())).sparkSession
    if exists(spark, folder):
        raise FileExistsError(folder)
    building = f"{folder.rstrip('/')}.{uuid.uuid4().hex}.building"
    fs, at = _fs(spark, building)
    try:
        for name, df in outputs.items():
            write(df, f"{building}/{name}")
        told = manifest({name: spark.read.schema(df.schema).json(f"{building}/{name}") if write is write_jsonl else df for name, df in outputs.items()}, keys)
        told.withColumn("policy", F.lit(json.dumps(policy or {}, sort_keys=True))).coalesce(1).write.json(f"{building}/manifest")
        _, target = _fs(spark, folder)
        if fs.exists(target) or not fs.rename(at, target):
            raise FileExistsError(folder)
    finally:
        if fs.exists(at):
            fs.delete(at, True)
    return spark.read.schema("output string, rows long, digest string, policy string").json(f"{folder}/manifest")


def grown(parent: DataFrame, increment: DataFrame) -> DataFrame:
    """(output, rows) of a release and what was added to it."""
    return parent.select("output", "rows").unionByName(increment.select("output", "rows")).groupBy("output").agg(F.sum("rows").alias("rows"))


def append_progress(rows: DataFrame, folder: str) -> None:
    """Adds rows to a progress log; rows that are there stay as they are."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(folder)


def write_by_decision(df: DataFrame, decision: str, folder: str) -> None:
    """A folder per decision, rows unmodified; rows without one are left for ``pending``."""
    df.where(F.col(decision).isNotNull()).write.mode("errorifexists").partitionBy(decision).json(folder)


def pending(df: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of rows that have no decision yet."""
    return df.select(*keys).distinct().join(decided.select(*keys), keys, "left_anti")


def report_markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small table as Markdown; more than ``most`` rows are an error, as a report is read by people."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of over {most} rows")
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"
