"""Documents that contain passages of benchmark items, found by spaced seeds.

A seed is a fixed mask over consecutive words; the words under its zeros are ignored, so a seed still matches when one of
them was replaced. Hashes of all masked windows of benchmark and training texts are joined; around each hit the item is laid
over the document on the hit's diagonal. An overlap is a stretch of ``MIN_WORDS`` equal words or more whose beginnings and
ends all score above zero (+1 for an equal word, -``PENALTY`` for a different one). The masks are chosen so that at least one
of them fits into every such stretch. An item too short for that has to occur whole; its mask has no zeros.

Training texts are scanned once. A task keeps a document only if one of its seeds passes a bit filter over the benchmark's
seeds, whose size is fixed; so hits, not texts, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrow_text import Hasher, golden, long_lists, mix, slices, word_hashes
from tillworks.llm.bits import BitFilter
from tillworks.llm.storage import stored, unused

MASKS = (  # six words each; found by a search, tests prove that they fit into every overlap
    "11010111", "11001111", "1100101011", "1110110001", "1100100111", "11011001001", "110101000101", "110000110011", "100100011011",
    "1101001000101", "11001010000101", "11100100100001",
)
MIN_WORDS = 10
PENALTY = 1.5
LEAST_ITEM = 5  # fewer words are no passage


def seeds(words: np.ndarray, offsets: np.ndarray, masks: tuple[str, ...], most: int = 1 << 18) -> Iterator[tuple]:
    """Positions at which each mask fits into its row, the hashes of the words under its ones, and the mask; ``most``
    positions at a time."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    width = max(map(len, masks))
    for first in range(0, len(words), most):
        near = words[first : first + most + width - 1]
        scrambled = [mix(near[k:] + golden(k + 1)) for k in range(min(width, len(near)))]
        for mask in masks:
            n = max(min(most, len(near) - len(mask) + 1), 0)
            at = np.flatnonzero(np.arange(first + len(mask), first + len(mask) + n) <= ends[first : first + n])
            total = np.full(n, golden(int(mask, 2)), np.uint64)
            for k, bit in enumerate(mask):
                if bit == "1" and n:
                    total += scrambled[k][:n]
            yield at + first, mix(total[at]), mask


def _scanner(members: BitFilter | None, masks: tuple[str, ...]):
    """Word hashes and seeds (position, hash) of each document that has seeds among ``members``; of every item if None. A mask
    without zeros belongs to items of its length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, data, rows in slices(batch.column("text")):
                words, offsets = word_hashes(data, rows, hasher)
                places, hashes = [], []
                for at, h, mask in seeds(words, offsets, masks):
                    if "0" not in mask and members is None:
                        whole = np.diff(offsets)[np.searchsorted(offsets, at, "right") - 1] == len(mask)
                        at, h = at[whole], h[whole]
                    hit = np.arange(len(h)) if members is None else members.holds(h)
                    places.append(at[hit])
                    hashes.append(h[hit])
                place, h = np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0, np.uint64), *hashes])
                row = np.searchsorted(offsets, place, "right") - 1
                order = np.argsort(row, kind="stable")
                place, h, row = place[order], h[order], row[order]
                kept = np.unique(row) if members is not None else np.arange(len(rows) - 1)
                length = np.diff(offsets)[kept]
                ends = np.append(0, np.cumsum(length))
                taken = np.repeat(offsets[kept] - ends[:-1], length) + np.arange(ends[-1])
                found = np.append(0, np.cumsum(np.bincount(row, minlength=len(rows) - 1)[kept]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(rows) - 1).take(pa.array(kept)),
                        batch.column("text_key").slice(first, len(rows) - 1).take(pa.array(kept)),
                        long_lists(words[taken], ends), long_lists(h, found),
                        long_lists((place - offsets[row]).astype(np.uint64), found),
                    ],
                    ["id", "text_key", "words", "hashes", "places"],
                )

    return run


_SCANNED = "id long, text_key string, words array<long>, hashes array<long>, places array<long>"


def text_key(text: Column) -> Column:
    """Equal for equal texts; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def _source(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), text_key(F.col("text")).alias("text_key"), F.lower("text").alias("text"))


def _longest_overlap(doc: Column, item: Column, penalty: float) -> Column:
    """Equal words and bounds of the stretch of two aligned word lists that holds the most equal words, among those whose
    beginnings and ends all score above zero; the first of several."""
    zero = F.struct(
        F.lit(0.0).alias("now"), F.lit(0.0).alias("peak"), F.lit(0).alias("n"), F.lit(0).alias("start"), F.lit(0).alias("i"),
        F.lit(0).alias("equal_words"), F.lit(0).alias("low"), F.lit(0).alias("high"),
    )

    def step(s: Column, same: Column) -> Column:
        fresh = s.now <= 0
        now = F.when(fresh, 0.0).otherwise(s.now) + F.when(same, 1.0).otherwise(-penalty)
        peak = F.when(fresh, 0.0).otherwise(s.peak)
        n = F.when(fresh, 0).otherwise(s.n) + same.cast("int")
        start = F.when(fresh, s.i).otherwise(s.start)
        better = (now > peak) & (n > s.equal_words)
        return F.struct(
            now.alias("now"), F.greatest(now, peak).alias("peak"), n.alias("n"), start.alias("start"), (s.i + 1).alias("i"),
            F.when(better, n).otherwise(s.equal_words).alias("equal_words"),
            F.when(better, start).otherwise(s.low).alias("low"), F.when(better, s.i + 1).otherwise(s.high).alias("high"),
        )

    return F.aggregate(F.zip_with(doc, item, lambda x, y: x == y), zero, step)


def leaks(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, penalty: float = PENALTY, masks: tuple[str, ...] = MASKS
) -> DataFrame:
    """One row for each document row (``doc_id``, ``text``) and benchmark item (``item_id``, ``text``) that overlap:
    ``doc_id``, ``text_key``, ``item_id``, ``equal_words``, ``overlap_words``, ``doc_word``, ``item_word`` (of the best
    stretch, positions from 0).

    Words are runs of letters and digits without regard to case; in scripts written without spaces each character is one. An
    item of fewer words than ``min_words`` needs all of them in a row, one of fewer than ``LEAST_ITEM`` matches nothing. The
    default masks lose no overlap at the default ``min_words`` and ``penalty``. Items with equal words count once, under their
    smallest item_id. Null texts match nothing; repeated document rows give repeated result rows; an empty table gives none.
    Further columns are ignored.
    """
    short = tuple("1" * n for n in range(LEAST_ITEM, min_words))
    items = stored(_source(benchmark, "item_id").mapInArrow(_scanner(None, masks + short), _SCANNED), "items")
    distinct = items.groupBy("words").agg(F.min("id").alias("item_id")).withColumn("item", F.monotonically_increasing_id())
    distinct = stored(distinct, "distinct-items")
    sizes = distinct.select(F.size("words").alias("n")).where(F.col("n").between(LEAST_ITEM, min_words - 1)).distinct().collect()
    entries = items.join(distinct, (items.id.eqNullSafe(distinct.item_id)) & (items.words == distinct.words))
    seed = F.explode(F.arrays_zip("hashes", "places")).alias("seed")
    entries = entries.select("item", F.size(items.words).alias("item_words"), seed)
    entries = entries.select("item", "item_words", F.col("seed.hashes").alias("hash"), F.col("seed.places").alias("item_place"))
    entries = stored(entries.distinct(), "seeds")

    members = BitFilter.gather(entries, "hash")
    used = masks + tuple("1" * n for n in sorted(r.n for r in sizes))
    scanned = _source(docs, "doc_id").mapInArrow(_scanner(members, used), _SCANNED)
    found = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "hit-documents")
    hits = found.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("seed"))
    hits = hits.select("row", F.col("seed.hashes").alias("hash"), F.col("seed.places").alias("place"))
    shifts = hits.join(entries, "hash").select("row", "item", "item_words", (F.col("place") - F.col("item_place")).alias("shift"))

    from_doc, from_item = F.greatest("shift", F.lit(0)).cast("int"), F.greatest(-F.col("shift"), F.lit(0)).cast("int")
    laid = shifts.distinct().join(found.select("row", F.col("words").alias("doc_words")), "row")
    laid = laid.select("row", "item", "item_words", from_doc.alias("doc_from"), from_item.alias("item_from"), "doc_words")
    length = F.least(F.size("doc_words") - F.col("doc_from"), F.col("item_words") - F.col("item_from"))
    laid = laid.select("row", "item", "item_words", "doc_from", "item_from", F.slice("doc_words", F.col("doc_from") + 1, length).alias("x"))
    part = laid.join(distinct, "item").withColumn("y", F.slice("words", F.col("item_from") + 1, F.size("x")))
    best = part.withColumn("s", _longest_overlap(F.col("x"), F.col("y"), penalty))
    best = best.where(F.col("s.equal_words") >= F.least(F.lit(min_words), F.col("item_words")))
    best = best.groupBy("row", "item", "item_id").agg(
        F.max(
            F.struct(
                F.col("s.equal_words").alias("equal_words"), (F.col("s.low") - F.col("s.high")).alias("less"),
                (-F.col("doc_from") - F.col("s.low")).alias("doc_word"), (F.col("item_from") + F.col("s.low")).alias("item_word"),
            )
        ).alias("b")
    )
    return best.join(found.select("row", F.col("id").alias("doc_id"), "text_key"), "row").select(
        "doc_id", "text_key", "item_id", "b.equal_words", (-F.col("b.less")).alias("overlap_words"),
        (-F.col("b.doc_word")).alias("doc_word"), "b.item_word",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of a table that overlap with no benchmark item; its columns stay as they are."""
    name = unused(docs, "text_key")
    bad = stored(leaks(docs, benchmark, **options).select(F.col("text_key").alias(name)).distinct(), "leaked-texts")
    return docs.join(bad, text_key(docs["text"]) == bad[name], "left_anti")
