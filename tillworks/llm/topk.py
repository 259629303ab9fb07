"""Exact top-k inner products by norm order, rotated partial sums and Cauchy-Schwarz bounds.

Vectors are rotated to the principal axes of the whole table (eigenvectors of its second moments), so that the first few
coordinates carry most of a product, and dealt into blocks of descending length. A task meets one block of queries and one
of vectors. It goes through the vectors from the longest on: where length times length is below a query's k-th best score
so far, nothing that follows can enter; for the rest the product over the first coordinates plus the product of the
remainders' lengths is an upper bound, and only pairs whose bound reaches the k-th best are multiplied out in integers.

The k-th best starts from the longest block of vectors, which is of bounded size and sent to all tasks; pairs of blocks that
it rules out by length are never formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.storage import stored

BLOCK, STEP = 2048, 512
NO_ID = np.iinfo(np.int64).max


def integers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as long; null if the vector or a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < math.inf))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _moments(dims: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _dense(batch.column("v"), dims).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["at", "value"])

    return run


def _dense(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers; shorter vectors are filled up with 0."""
    length = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims)[None, :] < length[:, None]] = lists.flatten().to_numpy()
    return out


def _packer(dims: int, most: int):
    """Blocks of at most ``most`` rows of a partition that is sorted by descending length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, held = TaskContext.get().partitionId() << 32, []

        def blocks(rows: list[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal first, held
            table = pa.Table.from_batches(rows).combine_chunks()
            n = len(table) if last else len(table) // most * most
            for k in range(0, n, most):
                part = table.slice(k, min(most, n - k)).combine_chunks().to_batches()[0]
                ids = part.column("vec_id").fill_null(NO_ID).to_numpy()
                arrays = [part.column("row_id").to_numpy(), ids, _dense(part.column("v"), dims)]
                norms = part.column("norm").to_numpy()
                cells = [pa.array([a.tobytes()], pa.binary()) for a in arrays]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first]), pa.array([norms[0]]), *cells], ["block", "norm", "row_ids", "vec_ids", "v"]
                )
                first += 1
            held = table.slice(n).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 4 * most:
                yield from blocks(held, False)
        if sum(map(len, held)):
            yield from blocks(held, True)

    return run


_BLOCK = "block long, norm double, row_ids binary, vec_ids binary, v binary"


class Block:
    def __init__(self, row_ids: bytes, vec_ids: bytes, v: bytes, axes: np.ndarray, head: int) -> None:
        self.rows, self.ids = np.frombuffer(row_ids, np.int64), np.frombuffer(vec_ids, np.int64)
        self.v = np.frombuffer(v, np.int64).reshape(len(self.rows), len(axes))
        turned = self.v.astype(float) @ axes
        self.head = turned[:, :head]
        self.tail = np.sqrt((turned[:, head:] ** 2).sum(1))
        self.norm = np.sqrt((turned**2).sum(1))

    def exact(self, other: Block) -> np.ndarray:
        """All inner products. Products of whole numbers below 2^53 are exact in doubles."""
        most = self.norm.max(initial=0) * other.norm.max(initial=0)
        if most >= 2.0**63:
            raise OverflowError("an inner product does not fit into a long")
        if most < 2.0**52:
            return (self.v.astype(float) @ other.v.astype(float).T).astype(np.int64)
        return self.v @ other.v.T

    def part(self, at: slice) -> Block:
        out = object.__new__(Block)
        for name in ("rows", "ids", "v", "head", "tail", "norm"):
            setattr(out, name, getattr(self, name)[at])
        return out


def best(queries: Block, vectors: Block, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of all pairs that may be among a query's k best: the score is at least ``floor`` and the
    k-th best seen. ``floor`` is raised in place."""
    top = np.full((len(floor), k), -np.inf)
    found = []
    for start in range(0, len(vectors.rows), STEP):
        part = vectors.part(slice(start, start + STEP))
        live = np.flatnonzero(queries.norm * part.norm[0] * (1 + 1e-12) + 1e-6 >= floor)
        if not len(live):
            break
        asked = queries.part(live)
        slack = 1e-6 + 1e-12 * asked.norm[:, None] * part.norm[None, :]
        bound = asked.head @ part.head.T + asked.tail[:, None] * part.tail[None, :] + slack
        near = (bound >= floor[live][:, None]) & (asked.rows[:, None] != part.rows[None, :])
        q, v = np.nonzero(near)
        if len(q) * 4 > near.size or queries.norm.max() * part.norm[0] >= 2.0**52:
            score = asked.exact(part)[q, v]
        else:
            score = np.concatenate([
                np.einsum("ij,ij->i", asked.v[q[i : i + 65536]], part.v[v[i : i + 65536]]) for i in range(0, len(q), 65536)
            ]) if len(q) else np.zeros(0, np.int64)
        found.append((live[q], start + v, score))
        dense = np.full(near.shape, -np.inf)
        dense[q, v] = score
        joined = np.concatenate([top[live], dense], axis=1)
        top[live] = -np.partition(-joined, k - 1, axis=1)[:, :k]
        floor[live] = np.maximum(floor[live], top[live].min(1))
    q, v, score = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    keep = score >= floor[q]
    return q[keep], v[keep], score[keep]


def _floors(seed: tuple, axes: np.ndarray, head: int, k: int):
    """Each query's k-th best score among the longest vectors, and the length that a vector needs to reach it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = Block(*seed, axes, head)
        for batch in batches:
            floors, needs = [], []
            for cells in zip(*(batch.column(c).to_pylist() for c in ("row_ids", "vec_ids", "v"))):
                queries = Block(*cells, axes, head)
                floor = np.full(len(queries.rows), -np.inf)
                best(queries, longest, floor, k)
                floors.append(floor.tobytes())
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(floor > 0, floor / queries.norm, -np.inf)
                needs.append(float(need.min()) * (1 - 1e-9) - 1e-6)
            columns = [batch.column(c) for c in ("block", "row_ids", "vec_ids", "v")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(floors, pa.binary()), pa.array(needs)], ["q_block", "q_rows", "q_ids", "q_v", "floor", "need"]
            )

    return run


def _search(axes: np.ndarray, head: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("q_rows", "q_ids", "q_v", "row_ids", "vec_ids", "v", "floor")
        for batch in batches:
            for cells in zip(*(batch.column(c).to_pylist() for c in names)):
                queries, vectors = Block(*cells[:3], axes, head), Block(*cells[3:6], axes, head)
                q, v, score = best(queries, vectors, np.frombuffer(cells[6]).copy(), k)
                order = np.lexsort((vectors.rows[v], vectors.ids[v], -score, q))
                q, v, score = q[order], v[order], score[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, v, score = (x[place < k] for x in (q, v, score))
                ids = vectors.ids[v]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries.rows[q]), pa.array(queries.ids[q]), pa.array(ids, mask=ids == NO_ID),
                        pa.array(vectors.rows[v]), pa.array(score),
                    ],
                    ["query_row", "query_id", "vec_id", "vec_row", "score"],
                )

    return run


def _blocks(rows: DataFrame, dims: int, most: int) -> DataFrame:
    n = max(1, -(-rows.count() // most))
    dealt = rows.repartitionByRange(n, F.desc("norm"), F.xxhash64("row_id")).sortWithinPartitions(F.desc("norm"), "row_id")
    return stored(dealt.mapInArrow(_packer(dims, most), _BLOCK), "vector-blocks")


def _pairs(asked: DataFrame, lengths: DataFrame, buckets: int = 64) -> DataFrame:
    """Pairs of a query block and a vector block whose longest vector has the length that the queries need."""
    side = F.pmod(F.xxhash64("block"), F.lit(buckets)).alias("bucket")
    each = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return each.join(lengths.select("block", "norm", side), "bucket").where("norm >= need").select("q_block", "block")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, head: int | None = None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k largest inner products of each query with all
    rows but itself; ties go to the smaller vec_id (null last), then row.

    ``vectors`` is a stored table of ``vec_id`` and ``v`` (array of long, null: takes no part). ``is_query`` is a condition
    on it; rows without vec_id ask nothing. Shorter vectors count as filled up with 0. Repeated rows are vectors of their
    own. Scores have to fit into a long. Further columns are ignored. Without queries the result is empty.
    """
    spark = vectors.sparkSession
    rows = vectors.withColumn("row_id", F.monotonically_increasing_id()).withColumn("asks", is_query).where("v is not null")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = stored(rows.select("row_id", "vec_id", "v", F.sqrt(square).alias("norm"), "asks"), "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if not dims:
        dims = 1
    moments = rows.select("v").mapInArrow(_moments(dims), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    gram = np.zeros(dims * dims)
    table = moments.toArrow()  # dims^2 sums
    gram[table["at"].to_numpy()] = table["value"].to_numpy()
    axes = np.linalg.eigh(gram.reshape(dims, dims))[1][:, ::-1].copy()
    head = head or max(1, dims // 4)

    candidates = _blocks(rows.drop("asks"), dims, block)
    queries = _blocks(rows.where("asks and vec_id is not null").drop("asks"), dims, block // 2)
    longest = candidates.orderBy("block").limit(1).collect()
    if not longest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seed = (bytes(longest[0].row_ids), bytes(longest[0].vec_ids), bytes(longest[0].v))
    asked = stored(
        queries.mapInArrow(_floors(seed, axes, head, k), "q_block long, q_rows binary, q_ids binary, q_v binary, floor binary, need double"),
        "query-blocks",
    )
    pairs = _pairs(asked.select("q_block", "need"), candidates.select("block", "norm"))
    met = pairs.join(asked.drop("need"), "q_block").join(candidates.drop("norm"), "block")
    found = met.repartition(F.col("q_block"), F.col("block")).mapInArrow(
        _search(axes, head, k), "query_row long, query_id long, vec_id long, vec_row long, score long"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM clean q JOIN clean c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
