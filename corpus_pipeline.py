"""The document pipeline: toxicity, exact copies, near copies, benchmark passages, tokens.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's
documents. All but the last return the columns of documents.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfpanel.llm import bpe, decontaminate, exact_dedup, near_dedup, queries, toxicity
from shelfpanel.llm.common import delete_at_exit, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest id."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by a similarity of 0.8 on five-word shingles."""
    return near_dedup.drop_near_copies(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word passage of the benchmark."""
    return decontaminate.remove_documents(docs, queries.table(spark, sf_dir, "benchmark"), size=10)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded text, of each document left."""
    return queries.digests(bpe.encode_decode(docs, queries.vocab_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("bpe", tokens),
]

#: SQL cannot train the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; their tables are deleted when the driver's JVM ends."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    delete_at_exit(spark, folder)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
