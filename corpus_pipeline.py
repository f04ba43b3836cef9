"""A corpus pipeline: quality, near copies, repeated strings, benchmark items, token ids.

Every stage works on all that the one before kept, as Parquet in the shared folder; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import op2_ngram_jaccard, op4_pu_quality, op5_suffix_dedup, op6_edit_decontamination, op10_byte_bpe
from tracewright.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on these documents' labels outside the held-out fold."""
    docs = docs.select(COLUMNS)
    return op4_pu_quality.quality_documents(docs, op4_pu_quality.fitted(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; documents without words or id all stay."""
    docs = docs.select(COLUMNS)
    rest = op2_ngram_jaccard.similar_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier 100-byte string holds; a document that loses its last word goes."""
    rest = op5_suffix_dedup.remaining_texts(docs.select(COLUMNS), ["lang", "source", "n_chars"])
    rest = rest.where(r"n_removed = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    return rest.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, up to the allowed edits."""
    return op6_edit_decontamination.clean_documents(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and digest of its token ids, and the digest of what they decode to."""
    return op10_byte_bpe.byte_bpe(docs, public_tokenizers.path(op10_byte_bpe.VOCABULARY))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_items),
    ("byte-level BPE", token_ids),
]

#: SQL has no classifier fitted by risk minimisation and no BPE; tests hold every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
