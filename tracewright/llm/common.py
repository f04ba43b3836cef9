"""What the operators of this subpackage share: table reading and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch where the session has Spark's own 10,000: whole texts travel in them, and every task holds
#: several batches at a time on both sides.
ROWS_OF_TEXT, SPARKS_ROWS = 1024, "10000"


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for this session, unless it has a size of its own."""
    if spark.conf.get(BATCH_ROWS, SPARKS_ROWS) == SPARKS_ROWS:
        spark.conf.set(BATCH_ROWS, str(ROWS_OF_TEXT))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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


def written_by(df: DataFrame, label: str, *partition_by: str) -> str:
    """Writes ``df`` as Parquet to the shared folder, in folders by the given columns; returns the path.

    The shuffle files of the write go with it, as the table replaces them.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    return df.sparkSession.read.schema(df.schema).parquet(written_by(df, label))


def dropped(*frames: DataFrame) -> None:
    """Deletes tables made by ``written`` that no result reads any more."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def total(df: DataFrame, col: str) -> int:
    return df.agg(F.sum(col)).first()[0] or 0
