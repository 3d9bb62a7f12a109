"""From documents to packed training sequences, in stages of ``textvec.llm`` operators.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that the one before kept, and is
written as Parquet and read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textvec.llm import decontaminate, knn_quality, line_dedup, packing, simhash
from textvec.llm.common import crc32_remainder, table
from textvec.workspace import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours do not vote down."""
    held_out = crc32_remainder("doc_id", 5) == 0
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"), held_out)
    return knn_quality.kept(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a near line precedes; documents of which nothing is left go."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near-duplicates."""
    return simhash.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

# the trained and hashed stages cannot be told in SQL: the tests hold run() against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
