"""Phrase collocations by Rabin-Karp fingerprints.

Words are hashed from prefix polynomials over a batch's bytes, runs of words from prefix polynomials over the words' hashes, so
that all runs of one length take a few vectorised operations. A task counts fingerprints and passes each on with its count and a
pointer to a row that has it; the shuffle adds the counts up. Texts are not shuffled: a phrase is read from the row it points to
only once it is known to be frequent.

A run is frequent only if its first and its last words but one are. So runs are counted in passes over the texts: words, pairs
whose words are frequent, and longer runs whose pairs all are. What is frequent goes to the tasks as a bit filter of fixed size,
which lets a few more runs through but loses none.

Runs are told apart by two independent fingerprints of 64 and 31 bits. Each frequent run is looked up in the texts of its first
and its last pointer; if the two phrases differ, the fingerprints collide and the job fails rather than report a wrong count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.arrow_text import Hasher, golden, lower_ascii, mix, slices, spans_of
from tillworks.llm.bits import BitFilter
from tillworks.llm.storage import stored

LONGEST, LEAST, COVER, FIRST = 5, 100, 100, 2000
FILTER_BITS = 26  # 8 MB
HELD = 1_000_000  # occurrences that a task holds before it counts them
BREAKS = b".,;:!?\n\x0b\x0c\r"  # between pieces
BLANKS = b" \t"  # between words
NO_LANGUAGE = "und"

SCORE = "1000BD * (cast(a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"



def _table(of: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


def words_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """Hashes, first bytes, ends and rows of all words, and a number that words of one piece have in common."""
    breaks = _table(BREAKS)[data]
    starts, ends, row = spans_of(~(breaks | _table(BLANKS)[data]), offsets)
    piece = np.cumsum(breaks)[starts] + row if len(starts) else row
    return hasher.spans(lower_ascii(data), starts, ends), starts, ends, row, piece


class Counter:
    """Counts ``n`` of keys, with one occurrence's values of the other columns, passed on when many are held."""

    def __init__(self, names: list[str], keys: int) -> None:
        self.names, self.keys, self.parts, self.held = names, keys, [], 0

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The first ``keys`` columns are the key, the next is the count."""
        self.parts.append(columns)
        self.held += len(columns[0])
        if self.held > HELD:
            self._merge()
            if self.held > HELD // 2:
                yield from self.rest()

    def _merge(self) -> None:
        columns = [np.concatenate(x) for x in zip(*self.parts)]
        order = np.argsort(columns[0])
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in range(self.keys):
            key = columns[k][order]
            new[1:] |= key[1:] != key[:-1]
        first = np.flatnonzero(new)
        merged = [c[order[first]] for c in columns]
        merged[self.keys] = np.add.reduceat(columns[self.keys][order], first)
        self.parts, self.held = [merged], len(first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._merge()
            arrays = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in self.parts[0]]
            yield pa.RecordBatch.from_arrays(arrays, self.names)
        self.parts, self.held = [], 0


class Runs:
    """The runs of words in a slice of texts, and their fingerprints; ``bits`` of the first are used."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray, hasher: Hasher, bits: int) -> None:
        self.words, self.starts, self.ends, self.row, self.piece = words_of(data, offsets, hasher)
        self.salt = mix(languages[self.row].view(np.uint64)) if len(self.row) else np.zeros(0, np.uint64)
        self.second, self.hasher, self.short = mix(self.words ^ golden(5)), hasher, np.uint64((1 << bits) - 1)

    def prints(self, at: np.ndarray, size: int) -> np.ndarray:
        return mix(self.hasher.spans(self.words, at, at + size) ^ self.salt[at]) & self.short

    def checks(self, at: np.ndarray, size: int) -> np.ndarray:
        mixed = mix(self.hasher.spans(self.second, at, at + size) ^ mix(self.salt[at] + golden(size + 1)))
        return (mixed >> np.uint64(33)).astype(np.int32)

    def longer(self, at: np.ndarray, size: int) -> np.ndarray:
        """Places of the runs of ``size`` words whose first and last words but one are at given places."""
        begins = np.zeros(len(self.words) + 1, bool)
        begins[at] = True
        at = at[begins[at + 1]]
        return at[self.piece[at] == self.piece[at + size - 1]]


def counter(sizes: range, shared, known: int, bits: int):
    """Counts the runs of ``sizes`` words; those of up to ``known`` words in them may all be members of a shared filter. With
    runs of one word also each language's words, as a run of no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, hasher, counts = shared and shared.value, Hasher(), Counter(["fp", "check", "n", "row_id"], 2)
        for batch in batches:
            ids, languages = (batch.column(c).to_numpy() for c in ("row_id", "language"))
            for first, data, offsets in slices(batch.column("text")):
                runs = Runs(data, offsets, languages[first:], hasher, bits)

                def counted(at: np.ndarray, size: int, fp: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
                    yield from counts.add([fp, runs.checks(at, size), n, ids[first + runs.row[at]]])

                if 1 in sizes:
                    _, at, n = np.unique(runs.salt, return_index=True, return_counts=True)
                    yield from counted(at, 0, runs.prints(at, 0), n)
                at = np.arange(len(runs.words))
                for size in range(1, sizes.stop):
                    at = runs.longer(at, size) if size > 1 else at
                    fp = runs.prints(at, size)
                    if size <= known:
                        left = np.sort(members.holds(fp))
                        at, fp = at[left], fp[left]
                    if size in sizes:
                        yield from counted(at, size, fp, np.ones(len(at), np.int64))
        yield from counts.rest()

    return run


def reader(longest: int, bits: int):
    """The phrases of the fingerprints that are wanted of each row, words lower-cased and joined by single spaces."""
    blank = bytes.maketrans(b"\t", b" ")

    def name(row: np.ndarray, fp: np.ndarray, check: np.ndarray) -> np.ndarray:
        return mix(fp.view(np.uint64) + mix(row.astype(np.uint64) + (check.astype(np.uint64) << np.uint64(32))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids, languages = (batch.column(c).to_numpy() for c in ("row_id", "language"))
            fps, checks = batch.column("fps"), batch.column("checks")
            for first, data, offsets in slices(batch.column("text")):
                runs, n = Runs(data, offsets, languages[first:], hasher, bits), len(offsets) - 1
                want_fp, want_check = fps.slice(first, n).flatten().to_numpy(), checks.slice(first, n).flatten().to_numpy()
                want_row = np.repeat(np.arange(n), fps.slice(first, n).value_lengths().to_numpy())
                wanted = name(want_row, want_fp, want_check)
                order = np.argsort(wanted)
                wanted, open_, found, at = wanted[order], np.ones(len(order), bool), [], np.arange(len(runs.words))
                for size in range(longest + 1):
                    at = runs.longer(at, size) if size > 1 else at
                    fp, check = runs.prints(at, size), runs.checks(at, size)
                    key = name(runs.row[at], fp, check)
                    place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                    hit = np.flatnonzero(wanted[place] == key)
                    hits, first_of = np.unique(place[hit], return_index=True)
                    for to, one in zip(hits, hit[first_of]):
                        w = order[to]
                        if open_[to] and (want_fp[w], want_check[w], want_row[w]) == (fp[one].view(np.int64), check[one], runs.row[at[one]]):
                            open_[to] = False
                            start, end = runs.starts[at[one]], runs.ends[at[one] + size - 1] if size else runs.starts[at[one]]
                            words = data[start:end].tobytes().translate(blank).lower().split(b" ")
                            found.append((ids[first + want_row[w]], want_fp[w], want_check[w], b" ".join(filter(None, words)).decode()))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 4, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["row_id", "fp", "check", "phrase"])

    return run


def frequent(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = 64) -> DataFrame:
    """All runs of up to ``longest`` words that occur ``least`` times in their language, as a stored table ``lang``, ``size``,
    ``phrase`` (words joined by spaces) and ``n``; the run of no words has the number of all words of the language.

    ``docs`` is a stored table with ``lang`` (null: ``und``) and ``text``.
    """
    spark, lang = docs.sparkSession, F.coalesce("lang", F.lit(NO_LANGUAGE))
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), lang.alias("lang"), "text")
    texts = source.select("row_id", F.xxhash64("lang").alias("language"), "text")
    found, shared, known = [], None, 0
    for sizes in (range(1, 2), range(2, min(longest, 2) + 1), range(3, longest + 1)):
        if not sizes:
            break
        rows = texts.mapInArrow(counter(sizes, shared, known, bits), "fp long, check int, n long, row_id long")
        counted = rows.groupBy("fp", "check").agg(F.sum("n").alias("n"), F.first("row_id").alias("first"), F.last("row_id").alias("last"))
        found.append(stored(counted.where(F.col("n") >= least), f"runs-of-{sizes.start}"))
        known = sizes[-1]
        if known < longest:
            members = BitFilter.gather(reduce(DataFrame.unionByName, found), "fp", FILTER_BITS)
            shared = spark.sparkContext.broadcast(members)
    runs = reduce(DataFrame.unionByName, found)

    places = runs.select("fp", "check", F.explode(F.array_distinct(F.array("first", "last"))).alias("row_id"))
    places = places.groupBy("row_id").agg(F.collect_list(F.struct("fp", "check")).alias("wanted"))
    places = stored(places.select("row_id", F.col("wanted.fp").alias("fps"), F.col("wanted.check").alias("checks")), "pointers")
    read = texts.join(places, "row_id").mapInArrow(reader(longest, bits), "row_id long, fp long, check int, phrase string")
    read = read.join(source.select("row_id", "lang"), "row_id").groupBy("fp", "check").agg(
        F.min("phrase").alias("phrase"), F.max("phrase").alias("other"), F.min("lang").alias("lang"), F.max("lang").alias("other_lang"),
    )
    clash = (F.col("phrase") != F.col("other")) | (F.col("lang") != F.col("other_lang"))
    collides = F.raise_error(F.concat(F.lit("fingerprints of two phrases collide: "), "phrase", F.lit(" / "), "other"))
    phrase = F.when(clash, collides).otherwise(F.col("phrase"))
    size = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    named = runs.join(read, ["fp", "check"]).select("lang", size.alias("size"), phrase.alias("phrase"), "n")
    return stored(named, "phrases")


def _joined(words: Column, first, length) -> Column:
    return F.array_join(F.slice(words, first, length), " ")



def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover: int = COVER, first: int = FIRST, bits: int = 64
) -> DataFrame:
    """The best collocations of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    ``docs`` is a stored table with ``lang`` (null: ``und``) and ``text`` (null: empty); further columns are ignored. Texts are
    lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs. A candidate is a
    phrase of 2 to ``longest`` words that occurs ``a`` >= ``least`` times in its language, overlaps and repeated rows included.
    Its ``score`` is the least of floor(1000 a n / (l r)) over its cuts into two, ``l`` and ``r`` being the counts of the two
    sides and ``n`` that of all words; the earliest cut counts. Candidates inside a longer one with at least ``cover`` percent
    of their count are dropped. Ties in score and count are ranked by the phrase's bytes. An empty table gives an empty result.
    """
    runs = frequent(docs, longest, least, bits)
    sides = runs.where("size > 0").select("lang", F.col("phrase").alias("side"), F.col("n").alias("times"))
    totals = stored(runs.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = F.split("phrase", " ")
    candidates = runs.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), words.alias("words"))

    cuts = candidates.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    for name, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(sides.select("lang", F.col("side").alias(name), F.col("times").alias(count)), ["lang", name])
    cuts = cuts.join(totals, "lang").select("lang", "phrase", "a", "k", "l", "r", "n")
    cuts = cuts.withColumn("score", F.expr(SCORE))
    best = cuts.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("best"))

    starts = F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)
    lengths = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    inner = candidates.where("size > 2").select("lang", "size", "a", "words", lengths)
    parts = F.array_distinct(F.transform(starts, lambda s: _joined(F.col("words"), s, F.col("length"))))
    inner = inner.select("lang", "a", F.explode(parts).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.select("lang", "phrase", "best.*").join(inner, ["lang", "phrase"], "left")
    covered = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * cover
    kept = kept.where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH pieces AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]') AS parts
    FROM documents
), piece AS (
    SELECT doc, lang, generate_subscripts(parts, 1) AS place, unnest(parts) AS piece FROM pieces
), words AS (
    SELECT doc, lang, place, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece
), runs AS (
    SELECT lang, size, array_to_string(w[s : s + size - 1], ' ') AS phrase, count(*) AS f FROM (
        SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM words, (SELECT unnest(range(1, {LONGEST + 1})) AS size)
    ) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM runs WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM runs WHERE size > 1 AND f >= {LEAST}
), cuts AS (
    SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM candidates
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN runs x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
        JOIN runs y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ') JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = b.lang AND len(c.w) > len(string_split(b.phrase, ' ')) AND 100 * c.a >= {COVER} * b.a
            AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')
    )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
    l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {FIRST}
"""
