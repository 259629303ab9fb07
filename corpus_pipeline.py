"""From raw documents to packed token ids, in stages that each read what the one before has written.

``run(spark, sf_dir)`` applies ``STAGES`` to the table ``documents``. Each stage takes (spark, docs, sf_dir), where docs is
the stored result of its predecessor; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillworks.llm import decontaminate, minhash, mixing, packing, toxicity
from tillworks.llm.storage import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs, mixing.quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids; the same rows lie in binary files."""
    return packing.with_ids(packing.packed(docs))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("packing", packed),
]
ORACLE_SQL = None  # no SQL states the model's scores, signatures or packing; tests/llm holds brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
