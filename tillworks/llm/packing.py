"""Token ids of documents, packed into matrices of fixed width and written as binary files.

Each task turns its texts into ids, ends each document with an end id, splits documents longer than a row into pieces of
full rows and a rest, and packs the pieces of about ``BUFFER`` ids at a time by best-fit-decreasing: longest piece first,
each into the fullest row that still holds it. A segment tree over free capacities finds that row. No text is shuffled.

A file holds, one after the other, the id matrix (rows x width), the number of segments of each row, the cumulative segment
lengths of each row (from 0) and its position resets, the places at which position ids start again from 0. Files get new
names in each attempt of a task; only those named in the stored manifest count.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import open_folder, scratch, stored

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
WIDTH, BUFFER = 4096, 1 << 22
IDS = np.dtype("<u2")
LENGTHS = np.dtype("<i4")


class Encoder(dict):
    """Ids of texts as little-endian numbers. Words are encoded once and then looked up.

    The split pattern always breaks before a space unless it stands between white space (or its end), so the parts between
    other spaces can be encoded by themselves.
    """

    def __init__(self, path: str = TOKENIZER, pattern: str = PATTERN) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.unsafe = re.compile(r"\s (?:\s|\Z)")

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), IDS).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.plain(" " + word)
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if len(self) > 1_000_000:
            self.clear()
        if self.unsafe.search(text):
            return np.frombuffer(self.plain(text), IDS)
        head, *rest = text.split(" ")
        return np.frombuffer(self.plain(head) + b"".join(map(self.__getitem__, rest)), IDS)

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode(ids.tolist())


class Capacities:
    """Rows by free capacity, in a segment tree: the least capacity of at least n that some row has, in O(log width)."""

    def __init__(self, width: int) -> None:
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least n, and that capacity; None if there is none."""
        count, node = self.count, n + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Rows as lists of the pieces in them; every length is between 1 and width."""
    free, rows = Capacities(width), []
    for piece in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = free.take(lengths[piece])
        if found is None:
            found = len(rows), width
            rows.append([])
        row, capacity = found
        rows[row].append(piece)
        if capacity > lengths[piece]:
            free.add(row, capacity - lengths[piece])
    return rows


def file_bytes(matrix: np.ndarray, lengths: list[list[int]]) -> bytes:
    sums = [np.append(0, np.cumsum(x)) for x in lengths]
    parts = [matrix.astype(IDS), np.array([len(x) for x in lengths], LENGTHS), np.concatenate(sums).astype(LENGTHS)]
    parts.append(np.concatenate([s[:-1] for s in sums]).astype(LENGTHS))
    return b"".join(p.tobytes() for p in parts)


def read_file(data: bytes, n_rows: int, width: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The id matrix, and the cumulative segment lengths and position resets of each row."""
    matrix = np.frombuffer(data, IDS, n_rows * width).reshape(n_rows, width)
    rest = np.frombuffer(data, LENGTHS, offset=matrix.nbytes)
    counts, rest = rest[:n_rows], rest[n_rows:]
    sums = np.split(rest[: n_rows + counts.sum()], np.cumsum(counts + 1)[:-1])
    return matrix, sums, np.split(rest[n_rows + counts.sum() :], np.cumsum(counts)[:-1])


def positions(cumulative: np.ndarray, width: int) -> np.ndarray:
    """Position ids of a row: they start again from 0 with each segment, and after the last."""
    starts = np.append(cumulative, width)
    return np.arange(width) - np.repeat(starts[:-1], np.diff(starts))


_FIELDS = {
    "file": pa.string(), "row": pa.int32(), "n_rows": pa.int32(), "cu_seqlens": pa.list_(pa.int32()),
    "row_ids": pa.list_(pa.int64()), "doc_ids": pa.list_(pa.int64()), "piece": pa.list_(pa.int32()),
    "pieces": pa.list_(pa.int32()), "ids_crc32": pa.list_(pa.int64()),
}
_PACKED = (
    "file string, row int, n_rows int, cu_seqlens array<int>, row_ids array<long>, doc_ids array<long>, piece array<int>, "
    "pieces array<int>, ids_crc32 array<long>"
)


def _packer(folder: str, tokenizer: str, end: int, width: int, buffer: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder(tokenizer), TaskContext.get()
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        pieces: list[tuple] = []  # row id, doc_id, piece, pieces, ids
        held = written = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, written
            rows = best_fit_decreasing([len(p[4]) for p in pieces], width)
            matrix = np.full((len(rows), width), end, IDS)
            lengths = [[len(pieces[k][4]) for k in row] for row in rows]
            for r, row in enumerate(rows):
                ids = np.concatenate([pieces[k][4] for k in row])
                matrix[r, : len(ids)] = ids
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{written:06d}.bin"
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(file_bytes(matrix, lengths))
            picked = [[pieces[k] for k in row] for row in rows]
            values = [
                [f"{folder}/{name}"] * len(rows), range(len(rows)), [len(rows)] * len(rows),
                [np.append(0, np.cumsum(x)) for x in lengths],
                *([[p[c] for p in row] for row in picked] for c in range(4)),
                [[zlib.crc32(p[4].tobytes()) for p in row] for row in picked],
            ]
            pieces.clear()
            held, written = 0, written + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _FIELDS.values())], list(_FIELDS))

        for batch in batches:
            for row_id, doc_id, text in zip(*(batch.column(c) for c in ("row_id", "doc_id", "text"))):
                ids = np.append(encoder.encode(text.as_py() or ""), IDS.type(end))
                n = -(-len(ids) // width)
                parts = [ids[k * width : (k + 1) * width] for k in range(n)]
                pieces += [(row_id.as_py(), doc_id.as_py(), k, n, part) for k, part in enumerate(parts)]
                held += len(ids)
                if held >= buffer:
                    yield flush()
        if pieces:
            yield flush()

    return run


def packed(
    docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, width: int = WIDTH, buffer: int = BUFFER,
    folder: str | None = None,
) -> DataFrame:
    """Write the matrices of all rows of a table with ``doc_id`` and ``text``; return one row for each packed row.

    ``file`` and ``row`` say where it is, ``cu_seqlens`` where its segments begin and end. ``row_ids`` (of the table's scan),
    ``doc_ids``, ``piece`` (from 0), ``pieces`` and ``ids_crc32`` describe each segment. Every row has at least its end id, also with a null or empty text. A text of any length is kept whole;
    repeated rows are packed as often as they come. Further columns are ignored. An empty table gives no row and no file.
    ``tokenizer`` is a file of ranks that every executor has at that path, with ids and ``end`` below 65,536.
    """
    folder = folder or scratch(docs.sparkSession, "token-ids")
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"), "text")
    return stored(source.mapInArrow(_packer(folder, tokenizer, end, width, buffer), _PACKED), "packed")


def with_ids(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """Packed rows with their ``ids``, read back from the files one matrix at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = matrix = None
        for batch in batches:
            for k, (file, row, n_rows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("file", "row", "n_rows")))):
                if file != held:
                    system, path = open_folder(file)
                    with system.open_input_stream(path) as source:
                        matrix, held = read_file(source.read(), n_rows, width)[0], file
                ids = pa.array([matrix[row].astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, ids], [*batch.schema.names, "ids"])

    return rows.mapInArrow(run, f"{_PACKED}, ids array<int>")


def segments(rows: DataFrame) -> DataFrame:
    """One row for each segment of packed rows."""
    starts = F.slice("cu_seqlens", 1, F.size("cu_seqlens") - 1)
    lengths = F.zip_with(starts, F.slice("cu_seqlens", 2, F.size("cu_seqlens") - 1), lambda a, b: b - a)
    lists = rows.withColumns({"start": starts, "length": lengths})
    names = ("row_ids", "doc_ids", "piece", "pieces", "start", "length", "ids_crc32")
    each = lists.select("file", "row", "n_rows", F.explode(F.arrays_zip(*names)).alias("s"))

    def field(name: str) -> Column:
        return F.col(f"s.{name}").alias(name.replace("_ids", "_id"))

    return each.select("file", "row", "n_rows", *map(field, names))


def _reader(width: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        system, path = open_folder(key[0].as_py())
        with system.open_input_stream(path) as source:
            matrix, sums, _ = read_file(source.read(), table["n_rows"][0].as_py(), width)
        out = [
            matrix[r, s : s + n].astype(np.int32)
            for r, s, n in zip(*(table[c].to_numpy() for c in ("row", "start", "length")))
        ]
        return table.select(["row_id", "doc_id", "piece"]).append_column("ids", pa.array(out, pa.list_(pa.int32())))

    return run


def unpacked(rows: DataFrame, tokenizer: str = TOKENIZER, width: int = WIDTH) -> DataFrame:
    """``row_id``, ``doc_id`` and ``text`` read back from the files that packed rows name."""
    pieces = segments(rows).groupBy("file").applyInArrow(_reader(width), "row_id long, doc_id long, piece int, ids array<int>")
    whole = pieces.groupBy("row_id", "doc_id").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("p"))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            texts = [encoder.decode(np.array(ids[:-1], int)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), pa.array(texts, pa.string())], ["row_id", "doc_id", "text"])

    joined = whole.select("row_id", "doc_id", F.flatten(F.transform("p", lambda x: x.ids)).alias("ids"))
    return joined.mapInArrow(decode, "row_id long, doc_id long, text string")
