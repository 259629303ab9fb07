"""Shards that hold near equal shares of bytes, tokens and rows, with equal texts together.

Groups of equal texts are vectors of bytes, tokens and rows. Those above ``1 / CRATES`` of any total are placed one by one,
the rest in ``CRATES`` crates chosen by a hash of the text, so at most ``4 * CRATES`` vectors are packed, however many rows
there are. From the largest on, each goes to the shard in which it fits and has the highest dot product with the residual
capacity. A group that exceeds a shard's capacity by itself is first cut into parts, dealt by a hash of the row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.mixing import word_count
from tillworks.llm.storage import stored

CRATES = 4096
PARTS = 16  # parts of a capacity into which a group is cut that exceeds one


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; items are vectors in units of a shard's capacity."""
    residual, out = np.ones((shards, items.shape[1])), np.zeros(len(items), np.int64)
    for k in np.argsort(-items.max(1), kind="stable"):
        fit = residual @ items[k]
        holds = (residual >= items[k] - 1e-12).all(1)
        out[k] = np.argmax(np.where(holds, fit, -np.inf)) if holds.any() else np.argmax(fit)
        residual[out[k]] -= items[k]
    return out


def with_slots(rows: DataFrame, shard: str) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard, in order of ``row_id``. No window sees more than 2^20 rows or the blocks
    of one shard. ``rows`` has to be stored."""
    rows = rows.withColumn("block", F.shiftright("row_id", 20))
    counts = rows.groupBy(shard, "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(shard).orderBy("block")) - F.col("n")
    counts = stored(counts.select(shard, "block", before.alias("before")), "slots")
    inside = F.row_number().over(Window.partitionBy(shard, "block").orderBy("row_id"))
    numbered = rows.withColumn("at", inside).join(counts, [shard, "block"])
    return numbered.withColumn("slot", F.col("before") + F.col("at") - 1).drop("block", "at", "before")


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``row_id`` (of the table's scan), ``doc_id``, ``size`` (UTF-8 bytes and 1), ``tokens`` (words), ``text_crc32``,
    ``shard`` and ``slot`` of every row of a stored table with ``doc_id`` and ``text``.

    Null text has no bytes and is one group with empty texts. Rows are never dropped; repeated rows are one group. Further
    columns are ignored. An empty table gives an empty result.
    """
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        word_count(F.col("text")).alias("tokens"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("text_key"),
    )
    rows = stored(rows.withColumn("crate", F.pmod(F.xxhash64("text_key"), F.lit(CRATES))), "measured")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    totals = np.maximum([float(x or 0) for x in rows.agg(*sums).first()], 1)
    capacity = totals / shards

    groups = rows.groupBy("text_key", "crate").agg(*sums)
    heavy = F.greatest(*(F.col(c) / float(t) for c, t in zip(("bytes", "tokens", "rows"), totals))) > 1 / CRATES
    alone = F.when(heavy, F.col("text_key")).alias("text_key")
    items = groups.select(alone, F.when(~heavy, F.col("crate")).alias("crate"), "bytes", "tokens", "rows")
    items = items.groupBy("text_key", "crate").agg(*(F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")))
    items = items.orderBy("text_key", "crate").toArrow()  # at most 4 * CRATES rows

    vectors = np.stack([items[c].to_numpy().astype(float) for c in ("bytes", "tokens", "rows")], 1) / capacity
    most = vectors.max(1, initial=0)
    parts = [math.ceil(m * PARTS) if m > 1 and key else 1 for m, key in zip(most, items["text_key"].to_pylist())]
    chosen = place(np.repeat(vectors / np.array(parts, float)[:, None], parts, axis=0), shards)
    lists = np.split(chosen, np.cumsum(parts)[:-1]) if parts else []
    table = items.select(["text_key", "crate"]).append_column("dealt", pa.array([x.tolist() for x in lists], pa.list_(pa.int32())))
    table = spark.createDataFrame(table, "text_key binary, crate long, dealt array<int>")

    by_text = table.where("text_key is not null").select("text_key", "dealt")
    by_crate = table.where("text_key is null").select("crate", F.col("dealt").alias("crate_dealt"))
    placed = rows.join(F.broadcast(by_text), "text_key", "left").join(F.broadcast(by_crate), "crate", "left")
    dealt = F.coalesce("dealt", "crate_dealt")
    part = F.pmod(F.xxhash64("row_id"), F.size(dealt).cast("long")).cast("int")
    placed = placed.select("row_id", "doc_id", "size", "tokens", "text_crc32", F.get(dealt, part).alias("shard"))
    return with_slots(stored(placed, "placed"), "shard")
