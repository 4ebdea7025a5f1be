"""The corpus pipeline: stages over documents, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import exact_dedup, minhash, mixing, packing, quality
from weftline.llm.queries import tokenizer_path
from weftline.plans.shared import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays, in one row."""
    return exact_dedup.drop_copies(docs, single=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest id."""
    return minhash.drop_near_copies(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the sequences that hold them."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("quality", good), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: The quality stage trains a network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
