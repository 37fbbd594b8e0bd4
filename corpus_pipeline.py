"""From raw documents to packed sequences: toxic ones go, one of each group of near copies stays, leaks of the
benchmark go, personal data is masked, the rest is packed. Each stage reads what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgewise.llm import jaccard, leaks, packing, personal, toxicity
from lodgewise.llm.common import table, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one stays: that with the smallest doc_id (null: the largest), then the smallest hash of
    its text. Rows are told apart by id and text, so unlinked texts under one id all stay, and so do empty texts."""
    surplus = written(jaccard.surplus(docs).withColumnsRenamed({"doc_id": "_id", "text_hash": "_text"}), "surplus")
    own = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("_text"))

    def listed(some: str) -> DataFrame:
        keys = surplus.filter(some).select("_id", "_text")
        return keys if keys.offset(jaccard.BROADCAST_ROWS).head(1) else F.broadcast(keys)

    single = docs.join(listed("true"), own, "left_anti")
    first = docs.join(listed("stays"), own, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(first)


def leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers of persons are masked by their kind; every document stays."""
    return personal.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_bytes=48 << 20, slice_bytes=2 << 20)  # the workers serve other stages too


STAGES = [
    ("toxicity", toxic),
    ("near_copies", near_copies),
    ("decontamination", leaked),
    ("personal_data", private),
    ("packing", packed),
]
#: No SQL: a classifier, word fingerprints and a tokenizer take part.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name, "4m")
    return docs
