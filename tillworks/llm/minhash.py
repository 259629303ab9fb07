"""Near-duplicate documents by DartMinHash signatures of weighted word shingles, banded joins and exact verification.

A document is the multiset of its runs of ``width`` words (letters and digits, lower case); a text with fewer words is one
run. Darts are thrown at a line of "rank" for each unit of an element's weight, at places that depend only on the element
and the unit. A document keeps, for each coordinate of its signature, the dart of lowest rank that hits one of its units;
two documents agree in a coordinate with the probability of their weighted Jaccard similarity. Only darts below a rank
that leaves a few per coordinate are thrown, so that the work is linear in the text plus a constant for each document.

Documents with equal words are one node. Nodes that share a band are linked after an exact comparison:

1. Each bucket's members are compared with its centre, the member that meets most others in all its buckets.
2. In a small bucket whose members are still in different components, those are all compared with each other.
3. So are those of large ones, but block by block within tasks (``_in_blocks``): a row for each node and block that it
   meets, never one for each pair.

Every two nodes that share a band are compared unless they are in one component by then. The first two steps make a number of
rows that is linear in the nodes. The work of the last grows with the square of a large group of texts that are alike and yet
below the threshold; its memory does not.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrow_text import Hasher, golden, long_lists, mix, row_of, slices, word_hashes
from tillworks.llm.bits import BitFilter
from tillworks.llm.components import components
from tillworks.llm.storage import stored, unused

WIDTH, THRESHOLD = 5, 0.8
PAIRS_UP_TO = 32
BANDS, BAND_ROWS = 28, 5  # a pair at 0.8 shares no band with probability 1.5e-5
BLOCK_NODES, BLOCK_UNITS, COLUMNS = 1024, 1 << 19, 1024  # of a block in a large group, about; units counted at a time


def keys_and_shingles(data: np.ndarray, offsets: np.ndarray, width: int, hasher: Hasher):
    """Two content hashes for each row, and its shingles with their row offsets. Texts without words have no shingle and
    are told apart by their bytes."""
    words, at = word_hashes(data, offsets, hasher)
    n = np.diff(at)
    keys = [np.where(n > 0, hasher.spans(words ^ golden(k), at[:-1], at[1:]), 0) for k in (1, 2)]
    bare = np.flatnonzero(n == 0)
    for k, key in enumerate(keys):
        key[bare] = mix(hasher.spans(data, offsets[bare], offsets[bare + 1]) ^ np.uint64(k + 11))
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=out[1:])
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        total += mix(words[k : k + len(total)] + golden(k + 1)) if len(total) else total
    rows = row_of(out)
    start = at[rows] + np.arange(out[-1]) - out[rows]
    short = n[rows] < width
    shingles = np.where(short, keys[0][rows], total[np.minimum(start, max(len(total) - 1, 0))] if len(total) else 0)
    return keys, mix(shingles.astype(np.uint64)), out


def units(shingles: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each unit of weight: the second occurrence of a shingle in a row differs from the first. Also its
    row; the order changes."""
    place = shingles + mix(rows.astype(np.uint64) + golden(1))
    order = np.argsort(place)
    place, shingles, rows = place[order], shingles[order], rows[order]
    index = np.arange(len(place))
    first = np.append(True, place[1:] != place[:-1]) if len(place) else np.zeros(0, bool)
    occurrence = index - np.maximum.accumulate(np.where(first, index, 0))
    return mix(shingles + occurrence.astype(np.uint64) * golden(1)), rows


def throw(elements: np.ndarray, rows: np.ndarray, n_rows: int, coordinates: int) -> np.ndarray:
    """The earliest dart of each row (with at least one element) and coordinate, as rank and name in one number."""
    best = np.full(n_rows * coordinates, np.iinfo(np.uint64).max, np.uint64)
    weight = np.bincount(rows, minlength=n_rows)
    reach = coordinates * (math.log(coordinates) + 2) / np.maximum(weight, 1)
    open_rows = weight > 0
    while open_rows.any():
        live = np.flatnonzero(open_rows[rows])
        rank, dart = np.zeros(len(live)), 0
        while len(live):
            name = mix(elements[live] + golden(2 * dart + 1))
            rank = rank - np.log(((name >> np.uint64(11)) + np.uint64(1)) * 2.0**-53)
            near = rank <= reach[rows[live]]
            live, rank, name = live[near], rank[near], mix(name[near])
            slot = rows[live] * coordinates + ((name >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64)
            order = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            np.minimum.at(best, slot, order | (name & np.uint64(0xFFFFFFFF)))
            dart += 1
        empty = (best.reshape(n_rows, coordinates) == np.iinfo(np.uint64).max).any(1)
        open_rows &= empty
        reach = np.where(open_rows, reach * 2, reach)
    return best.reshape(n_rows, coordinates)


def _band_hashes(signatures: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    out = np.zeros((len(signatures), bands), np.uint64)
    for k in range(band_rows):
        out = mix(out + signatures[:, k::band_rows][:, :bands])
    return mix(out + np.arange(bands, dtype=np.uint64) * golden(1))


def sketcher(width: int, bands: int, band_rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                n = len(offsets) - 1
                keys, shingles, at = keys_and_shingles(data, offsets, width, hasher)
                full = np.flatnonzero(np.diff(at))
                place = np.zeros(n, np.int64)
                place[full] = np.arange(len(full))
                elements, rows = units(shingles, place[row_of(at)])
                hashes = _band_hashes(throw(elements, rows, len(full), bands * band_rows), bands, band_rows)
                ends = np.zeros(n + 1, np.int64)
                ends[full + 1] = bands
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row_id").slice(first, n), batch.column("doc_id").slice(first, n),
                        *(pa.array(k.view(np.int64)) for k in keys), long_lists(hashes.ravel(), np.cumsum(ends)),
                    ],
                    ["row_id", "doc_id", "k1", "k2", "bands"],
                )

    return run


def _units_of(members: BitFilter, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            for _, data, offsets in slices(batch.column("text")):
                keys, shingles, at = keys_and_shingles(data, offsets, width, hasher)
                wanted = []
                for i in members.holds(keys[0]).tolist():
                    if (name := (keys[0][i], keys[1][i])) not in seen:
                        seen.add(name)
                        wanted.append(i)
                lists = [np.sort(units(shingles[at[i] : at[i + 1]], np.zeros(at[i + 1] - at[i], np.int64))[0]) for i in wanted]
                k1, k2 = (pa.array(k[wanted].view(np.int64)) for k in keys)
                yield pa.RecordBatch.from_arrays([k1, k2, pa.array([x.tobytes() for x in lists], pa.binary())], ["k1", "k2", "units"])

    return run


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(x.as_buffer(), np.uint64) for x in column)


def _similar(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_sets(batch.column("x")), _sets(batch.column("y"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _repeated(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the sets that can be similar to another one, and those of their units that another of them holds, as pairs
    of an index into the places and a number."""
    size = np.array([len(x) for x in sets])
    live, units, rows = np.arange(len(sets)), np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    while True:
        names, count = np.unique(units, return_inverse=True, return_counts=True)[1:]
        shared = count[names] > 1
        enough = np.bincount(rows[shared], minlength=len(sets)) >= threshold * size
        before, live = len(live), live[enough[live]]
        keep = shared & enough[rows]
        units, rows = units[keep], rows[keep]
        if len(live) == before:
            return live, np.searchsorted(live, rows), np.unique(units, return_inverse=True)[1]


def _overlaps(rows: np.ndarray, names: np.ndarray, one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """How many units each of the sets ``one`` shares with each of ``two``, of n sets."""
    both = np.zeros((len(one), len(two)))
    order = np.argsort(names)
    rows, names = rows[order], names[order]
    for first in range(0, names[-1] + 1 if len(names) else 0, COLUMNS):
        at, end = np.searchsorted(names, [first, first + COLUMNS])
        held = np.zeros((n, COLUMNS), np.float32)
        held[rows[at:end], names[at:end] - first] = 1
        both += held[one] @ held[two].T
    return both


def _spanning(pairs: np.ndarray) -> list[int]:
    """The places of those pairs that join what no earlier one has joined."""
    up, out = {}, []

    def top(x: int) -> int:
        while (parent := up.get(x, x)) != x:
            up[x] = up.get(parent, parent)
            x = parent
        return x

    for place, (a, b) in enumerate(pairs.tolist()):
        if (a := top(a)) != (b := top(b)):
            up[a] = b
            out.append(place)
    return out


def _links_of_blocks(threshold: float):
    """Links between similar nodes of two blocks, or within one; no more than join their roots."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, root, second = (table.column(c).to_numpy() for c in ("node", "root", "second"))
        sets = [x for chunk in table.column("units").chunks for x in _sets(chunk)]
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if (root == root[0]).all():
            return none
        live, rows, names = _repeated(sets, threshold)
        one, two = np.flatnonzero(~second[live]), np.flatnonzero(second[live])
        if (key[1], key[2]) == (key[3], key[4]):
            two = one
        size = np.array([len(x) for x in sets])[live]
        both = _overlaps(rows, names, one, two, len(live))
        near = both >= threshold * (size[one][:, None] + size[two] - both)
        i, j = (live[k[at]] for k, at in zip((one, two), np.nonzero(near & (root[live[one]][:, None] != root[live[two]]))))
        if not len(i):
            return none
        roots, first = np.unique(np.stack([root[i], root[j]], 1), axis=0, return_index=True)
        first = first[_spanning(roots)]
        a, b = node[i[first]], node[j[first]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _with_units(pairs: DataFrame, units: DataFrame) -> DataFrame:
    one = units.select(F.col("node").alias("a"), F.col("units").alias("x"))
    two = units.select(F.col("node").alias("b"), F.col("units").alias("y"))
    return pairs.join(one, "a").join(two, "b")


def _verified(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a < b) of nodes whose similarity is at least the threshold."""
    near = F.least(F.length("x"), F.length("y")) >= threshold * F.greatest(F.length("x"), F.length("y"))
    return _with_units(pairs, units).where(near).mapInArrow(_similar(threshold), "a long, b long")


def _in_blocks(members: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """Links between the members (bucket, node, root) of buckets, so many that they join all similar ones with different roots.

    Buckets with a common member are one group, so that two nodes that meet in many buckets are compared once. A group is
    dealt into blocks by size, a class of sizes being so wide that a set can only be similar to one of its own class or the
    next, and each such pair of blocks is a task's work.
    """
    least = members.groupBy("bucket").agg(F.min("node").alias("b"))
    groups = components(members.join(least, "bucket").select(F.col("node").alias("a"), "b").distinct())
    nodes = members.select("node", "root").distinct().join(groups.withColumnRenamed("root", "group"), "node").join(units, "node")
    n = F.length("units") / 8
    nodes = nodes.withColumn("size", F.floor(F.log(n) / (math.log(1 / threshold) + 1e-6)))
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_NODES, F.sum(n) / BLOCK_UNITS)).alias("parts")
    dealt = nodes.groupBy("group", "size").agg(parts)
    dealt = stored(dealt.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("size", "parts"))).alias("parts")), "blocks")
    nodes = nodes.join(dealt, "group")
    part = F.pmod(F.xxhash64("node"), F.element_at("parts", F.col("size")))

    def met(step: int, block) -> Column:
        """Pairs of the node's block and those of a class of sizes."""
        there = F.coalesce(F.element_at("parts", F.col("size") + step), F.lit(0))
        return F.transform(F.filter(F.sequence(F.lit(0).cast("long"), there), lambda q: q < there), block)

    def pair(one: Column, p: Column, two: Column, q: Column) -> Column:
        return F.struct(one.alias("one"), p.alias("p"), two.alias("two"), q.alias("q"))

    size = F.col("size")
    blocks = F.concat(
        met(0, lambda q: pair(size, F.least(part, q), size, F.greatest(part, q))),
        met(1, lambda q: pair(size, part, size + 1, q)),
        met(-1, lambda q: pair(size - 1, q, size, part)),
    )
    meeting = nodes.withColumn("block", F.explode(blocks)).select(
        "group", "block.*", "node", "root", "units", ((size != F.col("block.one")) | (part != F.col("block.p"))).alias("second")
    )
    return meeting.groupBy("group", "one", "p", "two", "q").applyInArrow(_links_of_blocks(threshold), "a long, b long")


def _pair(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS,
    pairs_up_to: int = PAIRS_UP_TO,
) -> DataFrame:
    """Row ``row_id``, ``doc_id``, ``class_id`` (smallest doc_id of its class), ``class_size`` and ``kept`` for every row
    of a stored table with ``doc_id`` and ``text``.

    ``row_id`` is ``monotonically_increasing_id()`` of the table's scan. Exactly one row of each class is ``kept``: that
    with the smallest doc_id (null last), then row_id. ``pairs_up_to`` is the size up to which a bucket's members are simply
    paired; those of larger ones are compared in blocks. Null text reads as empty; texts without any word are alike only if
    equal. Repeated rows are one class. Further columns are ignored. An empty table gives an empty result.
    """
    source = docs.select("doc_id", "text").withColumn("row_id", F.monotonically_increasing_id())
    source = source.select("row_id", "doc_id", F.lower("text").alias("text"))
    rows = stored(
        source.mapInArrow(sketcher(width, bands, band_rows), "row_id long, doc_id long, k1 long, k2 long, bands array<long>"),
        "sketches",
    )
    nodes = stored(rows.groupBy("k1", "k2").agg(F.min("row_id").alias("node")), "first-rows")
    nodes = stored(rows.join(nodes, ["k1", "k2"]).select("row_id", "doc_id", "k1", "k2", "node"), "nodes")

    first = nodes.where("row_id = node").select("node", "k1", "k2")
    entries = rows.select(F.col("row_id").alias("node"), F.explode("bands").alias("bucket"))
    entries = entries.join(first.select("node"), "node", "left_semi")
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(entries.join(crowded, "bucket"), "members")

    centrality = members.groupBy("node").agg(F.sum("size").alias("met"))
    ranked = members.select("node", "bucket").join(centrality, "node")
    centres = stored(ranked.groupBy("bucket").agg(F.max_by("node", "met").alias("centre")), "centres")
    spokes = members.join(centres, "bucket").where("node <> centre").select(*_pair("node", "centre")).distinct()
    spokes = stored(spokes, "spokes")

    wanted = members.select("node").distinct().join(first, "node")
    sets = source.mapInArrow(_units_of(BitFilter.gather(wanted, "k1"), width), "k1 long, k2 long, units binary")
    sets = sets.groupBy("k1", "k2").agg(F.first("units").alias("units"))
    sets = stored(sets.join(wanted, ["k1", "k2"]).select("node", "units"), "units")
    links = stored(_verified(spokes, sets, threshold), "links")
    roots = components(links)

    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    split = stored(labelled.join(split.select("bucket"), "bucket"), "split")
    small = split.where(F.col("size") <= pairs_up_to)
    other = small.select("bucket", F.col("node").alias("other"), F.col("root").alias("other_root"))
    rest = small.join(other, "bucket").where("root < other_root").select(*_pair("node", "other")).distinct()
    rest = rest.join(spokes, ["a", "b"], "left_anti")
    more = _verified(rest, sets, threshold)
    large = stored(split.where(F.col("size") > pairs_up_to).select("bucket", "node", "root"), "crowd")
    if not large.isEmpty():
        more = more.unionByName(_in_blocks(large, sets, threshold))
    more = stored(more, "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    classed = nodes.join(roots, "node", "left").select("row_id", "doc_id", F.coalesce("root", "node").alias("root"))
    classes = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    lowest = classed.join(classes, "root").where("doc_id <=> class_id").groupBy("root").agg(F.min("row_id").alias("keeper"))
    classes = classes.join(lowest, "root")
    return classed.join(classes, "root").select(
        "row_id", "doc_id", "class_id", "class_size", (F.col("row_id") == F.col("keeper")).alias("kept")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of a stored table without all but one row of each class; its columns stay as they are."""
    name = unused(docs, "row_id")
    kept = near_duplicates(docs, **options).where("kept").select(F.col("row_id").alias(name))
    return docs.withColumn(name, F.monotonically_increasing_id()).join(kept, name, "left_semi").drop(name)
