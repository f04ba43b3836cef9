"""Sessions with the settings that the operators count on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` in as many partitions as shuffles have: a small file is read by one task, however much work its rows are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; where it is unset it is an error on a
    cluster, and a temporary folder in local mode, where one machine does everything."""
    found = spark.sparkContext.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors see")
        found = tempfile.mkdtemp(prefix="tracewright-")
        spark.conf.set(CHECKPOINT_DIR, found)
    return found


def written(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; the shuffle files of the write may go with it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true" if drop_shuffles else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
