"""CSV records with line breaks inside quoted cells, read in splits of a file.

Whether a line starts a record depends on the quotes before it: it does if their number is even. So a first pass counts the
quotes of each split, a running sum over a file's splits tells how each one begins, and a second pass joins lines to records
inside each split. Only the records that a split boundary cuts are put together from pieces, at most two for each split.

Quotes have to be balanced: cells that hold a quote are quoted and double it, as spreadsheet exports do. A file whose number
of quotes is odd is an error; it can be read as a whole (``tabs.scan_tab`` with ``multiline="file"``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the package need not be installed on executors

QUOTE = 34
MOST_SENT = 200_000  # splits whose parity is sent to all tasks, some 20 MB; more are joined by a shuffle
OPTIONS = {"escape": '"', "multiLine": "true"}
_PIECE = "file string, block long, first boolean, starts boolean, ends boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.translate(line, '"', ""))


class Splits:
    """What the lines of all splits of the files below a path say about quotes. One row for each split reaches the driver,
    which plans them one by one in any case."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        counted = _lines(spark, path).groupBy("file", "block").agg(
            F.sum(_quotes(F.col("line"))).alias("n"), F.max(_quotes(F.col("line")) % 2 == 1).alias("broken"),
            F.first(F.col("line").endswith("\r")).alias("crlf"),
        )
        found = sorted((r.file, r.block, r.n, r.crlf, r.broken) for r in counted.collect())
        self.broken = any(broken for *_, broken in found)  # a cell holds a line break, or quotes are not balanced
        # Whether a split begins within a quoted cell, and whether its file's first line ends with a carriage return.
        self.begins: list[tuple[str, int, bool, bool]] = []
        total: dict[str, int] = {}
        for file, block, n, crlf, _ in found:
            ends = self.begins[-1][3] if file in total else crlf
            self.begins.append((file, block, total.get(file, 0) % 2 == 1, ends))
            total[file] = total.get(file, 0) + n
        self.unbalanced = [file for file, n in total.items() if n % 2]


def _joined(lines: pa.Array, inside: bool) -> tuple[pa.Array, np.ndarray, bool]:
    """Lines joined to records at the line breaks within quoted cells; whether each record, the last one too, starts outside
    a cell, and whether the next line would start inside one."""
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + n + 1].astype(np.int64)
    data = lines.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    quotes = np.append(0, np.cumsum(data == QUOTE))[offsets] + int(inside)
    begins = quotes[:-1] % 2 == 0
    first = np.flatnonzero(begins | (np.arange(n) == 0))
    inner = np.setdiff1d(np.arange(1, n), first, assume_unique=True)  # lines that a line break joins to the one before
    joined = np.insert(data, offsets[inner], ord("\n"))
    ends = np.append(offsets[first[1:]], offsets[-1]) + np.searchsorted(inner, np.append(first[1:], n))
    at = np.append(0, ends)
    if at[-1] < 2**31:
        out = pa.StringArray.from_buffers(len(first), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined))
    else:
        out = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at), pa.py_buffer(joined))
    return out, begins[first], bool(quotes[-1] % 2)


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, and pieces of those that its bounds cut. Rows of a split arrive together and in order."""
    split, held, inside, unseen = None, None, False, False  # held: the open record, whose quotes are odd unless it starts inside

    def pieces(records: pa.Array, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        nonlocal unseen
        n, first = len(records), np.zeros(len(records), bool)
        if unseen:
            filled = np.flatnonzero([r.as_buffer().size > 0 and r.as_py().strip("\r﻿") != "" for r in records[:100]])
            if not len(filled) and n > 100:
                filled = np.flatnonzero([r.as_py().strip("\r﻿") != "" for r in records])
            if len(filled):
                first[filled[0]], unseen = True, False
        columns = [pa.array([split[0]] * n), pa.array([split[1]] * n), pa.array(first), pa.array(starts), pa.array(ends)]
        return pa.RecordBatch.from_arrays([*columns, records], ["file", "block", "first", "starts", "ends", "record"])

    def close() -> Iterator[pa.RecordBatch]:
        if held is not None:
            yield pieces(pa.array([held[0]]), np.array([held[1]]), np.array([False]))

    for batch in batches:
        if not len(batch):
            continue
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(batch))):
            here = (files[int(a)].as_py(), int(blocks[a]))
            if here != split:
                yield from close()
                split, held, inside, unseen = here, None, batch.column("inside")[int(a)].as_py(), blocks[a] == 0
            lines = batch.column("line").slice(a, b - a)
            start = inside
            if held is not None:
                lines, start = pa.concat_arrays([pa.array([held[0]]), lines]), not held[1]
            records, starts, inside = _joined(lines, start)
            held = None
            if inside:  # the last record is open
                held = (records[-1].as_py(), bool(starts[-1]))
                records, starts = records[:-1], starts[:-1]
            if len(records):
                yield pieces(records, starts, np.ones(len(records), bool))
    yield from close()


def _assembled(pieces: DataFrame) -> DataFrame:
    """Whole records from the pieces of those that were cut."""
    order = Window.partitionBy("file").orderBy("block", "starts")
    numbered = pieces.withColumn("number", F.sum(F.col("starts").cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "starts", "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    return numbered.groupBy("file", "number").agg(F.max("first").alias("first"), text.alias("record"))


def scan_records(spark: SparkSession, path: str, splits: Splits | None = None) -> DataFrame:
    """All records of the CSV files below a path as text columns, named by the header that each file starts with.

    Gives the rows that Spark's CSV reader gives with ``multiLine``, from splits. Lines end at a line feed, before which a
    carriage return is dropped (in cells, if the file's first line has one); blank lines are skipped. A file with another header fails, as does one with unbalanced
    quotes. ``splits`` are those of the path, if they are known.
    """
    columns = spark.read.options(header=True, **OPTIONS).csv(path).columns
    if not columns:  # no file has a line
        return spark.read.options(header=True, **OPTIONS).csv(path)
    splits = splits or Splits(spark, path)
    if splits.unbalanced:
        raise ValueError(f"quotes are not balanced in {splits.unbalanced[:3]}")
    begins = spark.createDataFrame(splits.begins, "file string, block long, inside boolean, crlf boolean")
    lines = _lines(spark, path)
    if len(splits.begins) <= MOST_SENT:
        lines = lines.join(F.broadcast(begins), ["file", "block"], "left")
    else:
        lines = lines.withColumn("line_id", F.monotonically_increasing_id()).join(begins, ["file", "block"], "left")
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "line_id")
    moved = F.raise_error(F.lit("the files' splits have changed between two scans; scan again"))
    line = F.when(F.col("crlf"), F.regexp_replace("line", r"\r$", "")).otherwise(F.col("line"))
    lines = lines.select("file", "block", F.coalesce("inside", moved).alias("inside"), line.alias("line"))
    pieces = lines.mapInArrow(_records, _PIECE)
    whole = pieces.where("starts and ends").select("file", "first", "record")
    if any(inside for _, _, inside, _ in splits.begins):
        cut = _assembled(pieces.where("not (starts and ends)"))
        whole = whole.unionByName(cut.select("file", "first", "record"))
    return _cells(whole, columns)


def _cells(records: DataFrame, columns: list[str]) -> DataFrame:
    """The cells of records, without headers and blank lines."""
    text = F.regexp_replace("record", r"\r$", "")
    text = F.when(F.col("first"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} string" for n in names)
    parsed = records.select("file", "first", text.alias("record")).where("record <> ''")
    parsed = parsed.select("file", "first", F.from_csv("record", schema, OPTIONS).alias("r"))
    same = F.lit(True)
    for i, (n, column) in enumerate(zip(names, columns)):
        cell = F.coalesce(F.col(f"r.{n}"), F.lit(""))
        same = same & F.lit(column).isin(cell, F.concat(cell, F.lit(str(i))), F.concat(F.lit("_c"), F.lit(str(i))))
    other = F.raise_error(F.concat(F.lit("the header of this file is not that of the first: "), "file")).cast("boolean")
    rows = parsed.where(F.when(~F.col("first"), True).otherwise(F.when(same, False).otherwise(other)))
    return rows.select(*(F.col(f"r.{n}").alias(c) for n, c in zip(names, columns)))
