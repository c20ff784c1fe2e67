"""A training-data pipeline over ``documents``: toxic documents go, one document
of each near-duplicate group stays, passages that an earlier document has are
cut, documents with benchmark text go, and what is left is tokenized.

Each stage's result is written as Parquet to the shared folder and read again
as the next one's documents; it is removed once the next one is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from litreflow.llm import bpe, common, decontam, simhash, substring, toxicity
from litreflow.session import remove_folder, shared_dir


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    return toxicity.filtered(docs, common.table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.deduplicated(docs, shingle=3, radius=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return substring.cut(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining text, as counts and digests."""
    return bpe.encoded_digests(docs)


#: (name, function(spark, docs, sf_dir)); all but the last return the columns
#: of documents.
STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_near_copies),
    ("substring", without_repeats),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokenized),
]

#: The stages score, cluster, align and merge texts: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage applied to ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return docs
