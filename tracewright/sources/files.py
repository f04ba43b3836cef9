"""File trees: manifests, formats by content, and per-scope counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(spark: SparkSession, path: str, exclude: str | None = None) -> DataFrame:
    """(path, bytes, sha256, format) of every file below a folder; ``exclude``: a pattern of paths to leave out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if exclude:
        files = files.where(~F.col("path").rlike(exclude))
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), content_format(F.col("content"), F.col("path")).alias("format"))


def content_format(content: Column, path: Column) -> Column:
    """By the first bytes, else by the suffix."""
    head = F.hex(F.substring(content, 1, 6))
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    found = F.when(head.startswith("504B0304"), "zip").when(head.startswith("1F8B"), "gzip").when(head.startswith("25504446"), "pdf").when(head.startswith("53514C697465"), "sqlite").when(head.startswith("89504E47"), "png").when(head.startswith("50415231"), "parquet")
    return found.when(suffix != "", suffix).otherwise("binary")


def inventory(manifest: DataFrame, by: str) -> DataFrame:
    """Per group: files, bytes, sorted distinct formats."""
    return manifest.groupBy(by).agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.sort_array(F.collect_set("format")).alias("formats"))
