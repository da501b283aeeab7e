"""From raw documents to packed training sequences: five stages, each over all that the
one before it kept.

Stages pass on the columns of ``documents``; the last gives the packed pieces. Between
stages the rows are written as Parquet to the shared folder that the session names
in spark.checkpoint.dir, and read again. An empty table goes through all of them;
rows with null or shared ids are filtered, mixed and packed like others.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from linkledger.llm.common import read
from linkledger.llm.exact_dedup import drop_copies
from linkledger.llm.mixing import mixed_rows
from linkledger.llm.packing import pack
from linkledger.llm.simhash import one_of_each
from linkledger.llm.toxicity import drop_toxic
from linkledger.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"), folds=5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest id stays."""
    return drop_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that fingerprints link, the one with the smallest id stays."""
    return one_of_each(docs, shingle=3, max_bits=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_rows(docs, weights=(5, 2, 1), max_repeat=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    return pack(docs, length=4096, end_id=1)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup),
          ("mixing", mixing), ("packing", packing)]

#: SQL can express neither the toxicity models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; the rows of the last."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline-{uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
