"""Corpus preparation in stages; each stage's rows are written as Parquet and reread by the next.

Toxic documents go, of equal texts one stays, of near duplicates one stays, sources are mixed to their target weights in
whole documents, and what is left is encoded (and decoded again, whose digest is returned with the ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweave.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from lakeweave.llm.common import Workspace


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't called toxic by a classifier fitted to the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, toxicity.fit(spark, docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id."""
    return near_dedup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0 to 2 times) as the mix takes its words."""
    return mixing.mixed_copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the decoded bytes."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decoded=False, digests=True)


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("bpe", encode)]
#: SQL can express neither the classifier nor the hashed orders.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = work.put(docs, name)
    return docs
