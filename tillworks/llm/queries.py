"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import chat, codes, decontaminate, minhash, mixing, packing, phrases, sharding, suffix_tree, topk, toxicity, urls, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    return warc.archived(spark, _table(spark, sf_dir, "pages"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in eight shards of near equal bytes, tokens and rows."""
    rows = sharding.sharded(_table(spark, sf_dir, "documents"), 8).drop("row_id")
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that overlaps with a benchmark item, one row for each such pair."""
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    weights = mixing.quality_weights(_table(spark, sf_dir, "labels"))
    return mixing.mixed(_table(spark, sf_dir, "documents"), weights).select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.scored(docs, _table(spark, sf_dir, "labels")).drop("text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies in the packed id matrices."""
    placed = packing.segments(packing.packed(_table(spark, sf_dir, "documents")))
    return placed.select("doc_id", "piece", "pieces", "file", "row", "start", "length", "ids_crc32")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.integers(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    mined = urls.mine(urls.labelled_pages(pages, _table(spark, sf_dir, "labels")))
    return urls.judged(pages, mined).drop("url", "confidence")


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the suffix tree and the unigram model."""
    return suffix_tree.scored(_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: class_id is the smallest doc_id of the class."""
    classes = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "kept")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", topk.integers(F.col("embedding")).alias("v"))
    return codes.reported(*codes.compressed(vectors))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every formatted conversation says, read back from it."""
    return chat.digests(chat.conversations(_table(spark, sf_dir, "conversations")))


QUERIES = (
    op1_warc, op2_sharding, op3_decontaminate, op4_mixing, op5_toxicity, op6_packing, op7_topk, op8_urls, op9_suffix_tree,
    op10_minhash, op11_phrases, op12_codes, op13_chat,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.ORACLE, "op4_mixing": mixing.ORACLE, "op7_topk": topk.ORACLE, "op11_phrases": phrases.ORACLE,
        "op12_codes": codes.ORACLE,
        "op13_chat": chat.ORACLE,
    }
