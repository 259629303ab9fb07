"""Scores of texts by a probabilistic suffix tree over words.

Symbols are words in ASCII lower case and one end of text. A context of up to ``DEPTH`` words becomes a state if it is
frequent and some next symbols diverge from what its parent state (the context without its first word) predicts; each such
symbol gets a probability of its own, smoothed towards the parent, and all others share the rest as under the parent. The
root is the add-one unigram distribution over all training words. A token is scored in the longest state its context ends
with.

Everything is counted over all training texts. How often a context or a symbol has to occur does not grow with the corpus
beyond ``LEAST_STATE`` and ``LEAST_SYMBOL``, so the tree grows with it: levels, states and symbols are stored tables, built by
joins. The logarithm of a token's probability is a sum of weights, one for each state that its context ends with and one for
each of them that has the symbol as its own; so a text's score is the sum of the weights of its distinct keys, which are
joined with the table of weights. A bounded number of the most frequent words and weights is sent to all tasks instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrow_text import Hasher, golden, lower_ascii, mix, slices, spans_of
from tillworks.llm.bits import BitFilter
from tillworks.llm.storage import discard, stored

DEPTH = 3  # words of the longest context
WORD_SHARE, LEAST_SYMBOL = 1e-6, 4  # share of all tokens that a state's symbol needs, and the count that is always enough
STATE_SHARE, LEAST_STATE = 5e-5, 10  # the same for a context
HEAD = 1_000_000  # words, and weights, that are sent to all tasks; at most a quarter of them
FILTER_BITS = 26  # 8 MB
SIGNIFICANT = 10.0  # n ln(n / expected) of a diverging symbol
LEAST_DIVERGENCE = 1e-3  # of a state, in nats
PRIOR = 20.0  # weight of the parent's distribution, in tokens
END = np.uint64(0x5EEDE27D0C5EA1ED)
HELD = 2_000_000  # distinct numbers that a task holds before it passes them on
ID_BITS = 20  # of a frequent word's number
HASHED = np.uint64(1 << 63)  # set in all other numbers of words and grams
STATE = np.uint64(1 << 62)  # tells a state's key from that of the gram of the same words


def words_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's words followed by its end, and the offsets of the rows."""
    starts, ends, row = spans_of((data != 32) & ((data < 9) | (data > 13)), offsets)
    n = len(offsets) - 1
    at = np.append(0, np.cumsum(np.bincount(row, minlength=n) + 1))
    out = np.full(at[-1], END, np.uint64)
    out[np.arange(len(row)) + row] = hasher.spans(lower_ascii(data), starts, ends)
    return out, at


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    hasher = Hasher()
    for batch in batches:
        for first, data, offsets in slices(batch.column("text")):
            yield batch, first, *words_of(data, offsets, hasher)


class Tally:
    """Counts of numbers, passed on when they become many."""

    def __init__(self) -> None:
        self.raw, self.keys, self.counts, self.size = [], np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(self, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.raw.append(numbers)
        self.size += len(numbers)
        if self.size > 2 * HELD:
            self._merge()
            if self.size > HELD // 2:
                yield from self.rest()

    def _merge(self) -> None:
        if self.raw:
            key, n = np.unique(np.concatenate(self.raw), return_counts=True)
            if len(self.keys):
                key, n = np.concatenate([self.keys, key]), np.concatenate([self.counts, n])
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                key, n = key[first], np.add.reduceat(n, first)
            self.raw, self.keys, self.counts, self.size = [], key, n, len(key)

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        if self.size:
            yield pa.RecordBatch.from_arrays([pa.array(self.keys.view(np.int64)), pa.array(self.counts)], ["key", "n"])
        self.keys, self.counts, self.size = self.keys[:0], self.counts[:0], 0


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for _, _, words, _ in _texts(batches):
        yield from tally.add(words)
    yield from tally.rest()


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted array, -1 if absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _frequent(counted: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted) and counts that reach a least count; at most all tokens divided by it."""
    table = counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
    key, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(key)
    return key[order], n[order]


def _words(texts: DataFrame, paths: list[str] | None = None) -> tuple[DataFrame, int, int]:
    """Stored counts ``n`` of all word hashes ``key``, and the numbers of tokens and of words."""
    counts = texts.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts", paths)
    return counts, *(int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())


class Places:
    """Places of keys in a sorted array of hashes, found by their first bits."""

    def __init__(self, hashes: np.ndarray) -> None:
        bits = max(len(hashes).bit_length() + 1, 8)
        self.hashes, self.shift = hashes, np.uint64(64 - bits)
        sizes = np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 if absent."""
        bucket = (keys >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end, keys = at[left], end[left], keys[left]
        while len(left):
            here = self.hashes[at]
            found = here == keys
            out[left[found]] = at[found]
            at = at + 1
            more = np.flatnonzero((here < keys) & (at < end))
            left, at, end, keys = left[more], at[more], end[more], keys[more]
        return out


def _coded(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Numbers of words: one more than the id of a frequent word, else the hash."""
    return np.where(ids >= 0, (ids + 1).astype(np.uint64), words | HASHED)


def _gram(context: np.ndarray, up: np.ndarray, k: int) -> np.ndarray:
    """Number of k + 1 words from those of the first k and the last k: frequent words' numbers side by side, else a hash."""
    if (k + 1) * ID_BITS >= 62:
        return mix(mix(context + golden(k)) + up) | HASHED
    gram = (context << np.uint64(ID_BITS)) | (up & np.uint64((1 << ID_BITS) - 1))
    rare = np.flatnonzero((context | up) >= HASHED)
    gram[rare] = mix(mix(context[rare] + golden(k)) + up[rare]) | HASHED
    return gram


def _grams(codes: np.ndarray, offsets: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each context length up to ``depth``: the tokens that have such a context in their row, and for all tokens the
    numbers of context, last words and both (right for these tokens only)."""
    place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
    up = codes
    for k in range(1, depth + 1):
        context = np.append(up[:1], up[:-1])
        gram = _gram(context, up, k)
        yield np.flatnonzero(place >= k), context, up, gram
        up = gram


class GramTally:
    """Counts of grams, with their context and last words unless the gram's number says both."""

    def __init__(self) -> None:
        self.packed, self.parts, self.size = Tally(), [], 0

    def take(self, context: np.ndarray, up: np.ndarray, gram: np.ndarray) -> Iterator[pa.RecordBatch]:
        packed = gram < HASHED
        for batch in self.packed.add(gram[packed]):
            yield self._named(batch)
        hashed = np.flatnonzero(~packed)
        if len(hashed):
            key, first, n = np.unique(gram[hashed], return_index=True, return_counts=True)
            self.parts.append((key, context[hashed[first]], up[hashed[first]], n))
            self.size += len(key)
            if self.size > HELD:
                self._merge()
                if self.size > HELD // 2:
                    yield from self._hashed()

    def _merge(self) -> None:
        gram, context, up, n = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(gram, kind="stable")
        gram, n = gram[order], n[order]
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        self.parts = [(gram[first], context[order[first]], up[order[first]], np.add.reduceat(n, first))]
        self.size = len(first)

    @staticmethod
    def _named(batch: pa.RecordBatch) -> pa.RecordBatch:
        nothing = pa.nulls(batch.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("key"), nothing, nothing, batch.column("n")], ["gram", "context", "up", "n"])

    def _hashed(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._merge()
            gram, context, up, n = self.parts[0]
            columns = [*(pa.array(x.view(np.int64)) for x in (gram, context, up)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "context", "up", "n"])
        self.parts, self.size = [], 0

    def rest(self) -> Iterator[pa.RecordBatch]:
        for batch in self.packed.rest():
            yield self._named(batch)
        yield from self._hashed()


def _count_grams(shared, filters, k: int):
    """Counts of the grams (context, last k words) of all tokens whose k words before them may be a frequent context and whose last k
    words may be frequent enough for a symbol: a gram is never more frequent than its last words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, (members, lasts), tally = Places(shared.value[0]), filters.value, GramTally()
        for _, _, words, offsets in _texts(batches):
            for inside, context, up, gram in _grams(_coded(words, places.find(words)), offsets, k):
                pass
            used = inside[members.holds(context[inside])]
            used = used[lasts.holds(up[used])]
            yield from tally.take(context[used], up[used], gram[used])
        yield from tally.rest()

    return run


def _name_words(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(shared.value[0])
        for batch in batches:
            words = batch.column("key").to_numpy().view(np.uint64)
            code = _coded(words, places.find(words))
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), batch.column("n")], ["gram", "n"])

    return run


def _head(df: DataFrame, most: int = HEAD) -> int:
    """The least ``n`` that at most ``most`` rows, and a quarter of them, reach."""
    sizes = sorted(((r.n, r.rows) for r in df.groupBy("n").agg(F.count("*").alias("rows")).collect()), reverse=True)
    most, held, least = min(most, sum(rows for _, rows in sizes) // 4), 0, 1 + max((n for n, _ in sizes), default=0)
    for n, rows in sizes:
        if (held := held + rows) > most:
            break
        least = n
    return least


def weights(
    texts: DataFrame, depth: int = DEPTH, state_share: float = STATE_SHARE, least_state: float = LEAST_STATE,
    word_share: float = WORD_SHARE, least_symbol: float = LEAST_SYMBOL, significant: float = SIGNIFICANT,
    divergence: float = LEAST_DIVERGENCE, head: int = HEAD,
) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray], int, int]:
    """The tree of a stored table with ``text`` as a stored table of weights (natural logarithms), the frequent words with
    their counts, and the numbers of tokens and of words.

    ``key`` is a state (``weight``: the factor on what its parent gives to all but its own symbols), a gram of a state and
    one of its own symbols (what the symbol has beyond that) or a rare word (``word``; what it has beyond an unseen word).
    ``n`` is how often it occurs. A context needs a share of all tokens, but never more than ``least_state`` of them; so do
    symbols of states.
    """
    spark, paths = texts.sparkSession, []
    counts, tokens, distinct = _words(texts, paths)
    frequent = _frequent(counts, _head(counts, head))
    shared = spark.sparkContext.broadcast(frequent)
    least_state, least_symbol = (
        max(min(share * tokens, least), 2) for share, least in ((state_share, least_state), (word_share, least_symbol))
    )
    unseen = float(tokens + distinct + 1)
    lower = counts.mapInArrow(_name_words(shared), "gram long, n long").withColumn("chance", F.log((F.col("n") + 1) / F.lit(unseen)))
    lower = stored(lower, "words", paths)
    rare = lower.where("gram < 0")
    out = [rare.select(F.col("gram").alias("key"), (F.col("chance") + float(np.log(unseen))).alias("weight"), "n", F.lit(True).alias("word"))]
    grams = lower
    for k in range(1, depth + 1):
        contexts = grams.where(F.col("n") >= least_state).select(F.col("gram").alias("context"), F.col("n").alias("total"))
        members = BitFilter.gather(contexts, "context", FILTER_BITS)
        if not members.words.any():
            break
        lasts = BitFilter.gather(grams.where(F.col("n") >= least_symbol), "gram", FILTER_BITS)
        filters = spark.sparkContext.broadcast((members, lasts))
        counted = texts.mapInArrow(_count_grams(shared, filters, k), "gram long, context long, up long, n long")
        # A task's grams are distinct and sorted, so they are shuffled as they are: in that order they compress best.
        counted = counted.repartition("gram").groupBy("gram", "context", "up").agg(F.sum("n").alias("n")).where(F.col("n") >= least_symbol)
        counted = counted.withColumns({
            "context": F.coalesce("context", F.shiftright("gram", ID_BITS)),
            "up": F.coalesce("up", F.col("gram").bitwiseAND(F.lit((1 << k * ID_BITS) - 1))),
        })
        above = lower.select(F.col("gram").alias("up"), F.col("chance").alias("expected"))  # none: the parent is no state
        grams = counted.join(contexts, "context").join(above, "up", "left").drop("up")
        grams = grams.withColumn("gain", F.log(F.col("n") / F.col("total")) - F.col("expected"))
        grams = stored(grams.withColumn("own", F.col("n") * F.col("gain") >= significant), f"grams-{k}", paths)
        chance = (F.col("n") + PRIOR * F.exp("expected")) / (F.col("total") + PRIOR)
        states = grams.where("own").groupBy("context").agg(
            F.max("total").alias("n"), F.sum(F.col("n") / F.col("total") * F.col("gain")).alias("spread"),
            F.log(F.greatest(1 - F.sum(chance), F.lit(1e-12)) / F.greatest(1 - F.sum(F.exp("expected")), F.lit(1e-12))).alias("spare"),
        )
        states = stored(states.where(F.col("spread") >= divergence).drop("spread"), f"states-{k}", paths)
        inside = grams.where("expected is not null").join(states.select("context", "spare"), "context")
        inside = inside.withColumn("others", F.col("expected") + F.col("spare"))
        inside = inside.withColumn("chance", F.when(F.col("own"), F.log(chance)).otherwise(F.col("others")))
        lower = stored(inside.select("gram", "n", "own", "others", "chance"), f"level-{k}", paths)
        salted = F.col("context").bitwiseXOR(F.lit(int(STATE)))
        own = lower.where("own")
        out.append(states.select(salted.alias("key"), F.col("spare").alias("weight"), "n", F.lit(False).alias("word")))
        out.append(own.select(F.col("gram").alias("key"), (F.col("chance") - F.col("others")).alias("weight"), "n", F.lit(False).alias("word")))
    table = stored(reduce(DataFrame.unionByName, out), "weights")
    discard(spark, paths)
    return table, frequent, tokens, distinct


def _scorer(shared, depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent, counts, unseen), (heads, head_weights), members = shared.value
        hasher, frequent, heads = Hasher(), Places(frequent), Places(heads)
        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                words, at = words_of(data, offsets, hasher)
                n = len(at) - 1
                row = np.repeat(np.arange(n), np.diff(at))
                ids = frequent.find(words)
                known = ids >= 0
                root = np.log((np.where(known, counts[ids] if len(counts) else 0, 0) + 1) / unseen)
                codes = _coded(words, ids)
                gain = np.zeros(len(words))
                keys, rows = [codes[~known]], [row[~known]]

                def weigh(tokens: np.ndarray, key: np.ndarray) -> np.ndarray:
                    """Adds the weights that are at hand; tokens whose key has one or may have one in the table."""
                    place = heads.find(mix(key))
                    found = np.flatnonzero(place >= 0)
                    gain[tokens[found]] += head_weights[place[found]]
                    left = np.flatnonzero(place < 0)
                    left = left[members.holds(key[left])]
                    keys.append(key[left])
                    rows.append(row[tokens[left]])
                    return np.sort(tokens[np.append(found, left)])

                alive = np.ones(len(words), bool)
                for inside, context, _, gram in _grams(codes, at, depth):
                    inside = inside[alive[inside]]
                    inside = weigh(inside, context[inside] ^ STATE)
                    weigh(inside, gram[inside])
                    alive = np.zeros(len(words), bool)
                    alive[inside] = True
                key, key_row = np.concatenate(keys), np.concatenate(rows)
                # By row, then by key as far as 44 bits tell: what they leave apart is only added up later.
                order = np.argsort((key_row.astype(np.uint64) << np.uint64(44)) | (mix(key) >> np.uint64(20)))
                key, key_row = key[order], key_row[order]
                new = np.append(True, (np.diff(key) != 0) | (np.diff(key_row) != 0))[: len(key)]
                times = np.diff(np.append(np.flatnonzero(new), len(key)))
                row_id = batch.column("row_id").slice(first, n).to_numpy()
                own = pa.StructArray.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n), batch.column("held_out").slice(first, n), pa.array(np.diff(at)),
                        pa.array(np.bincount(row[known], minlength=n)), pa.array(np.bincount(row, root, n)),
                        pa.array(np.bincount(row, gain, n)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_frequent", "base", "gain"],
                )
                names = ["row_id", "key", "times", "own"]
                spread = pa.array(mix(row_id.view(np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(row_id), spread, pa.array(np.zeros(n, np.int64)), own], names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row_id[key_row[new]]), pa.array(key[new].view(np.int64)), pa.array(times),
                        pa.nulls(len(times), own.type),
                    ],
                    names,
                )

    return run


# One row for each row's own sums, with no times of any key, and one for each of its keys.
_SCORED = (
    "row_id long, key long, times long, "
    "own struct<doc_id: long, held_out: boolean, n_tokens: long, n_frequent: long, base: double, gain: double>"
)


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 7


def scored(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of every
    row of a stored table with ``doc_id`` and ``text``.

    Learns from rows whose crc32(doc_id) mod 7 is not 2; rows without doc_id are scored, but neither learned from nor held
    out. A null text is empty and has only its end. Repeated rows count as often as they come. Further columns are ignored.
    Without training text every token is unknown. An empty table gives an empty result.
    """
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    spark = docs.sparkSession
    depth, head = options.get("depth", DEPTH), options.get("head", HEAD)
    table, frequent, tokens, distinct = weights(docs.where(remainder(F.col("doc_id")) != 2).select("text"), **options)
    least = _head(table.where("not word"), head)
    at_hand = table.where(~F.col("word") & (F.col("n") >= least)).select("key", "weight").toArrow()
    key, weight = mix(at_hand["key"].to_numpy().view(np.uint64)), at_hand["weight"].to_numpy()
    order = np.argsort(key)
    table = table.where(F.col("word") | (F.col("n") < least))
    members = BitFilter.gather(table.where("not word"), "key", FILTER_BITS)
    shared = spark.sparkContext.broadcast(((*frequent, tokens + distinct + 1), (key[order], weight[order]), members))
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", held_out.alias("held_out"), "text")
    parts = source.mapInArrow(_scorer(shared, depth), _SCORED)
    # The table's keys are distinct and hashed, so its partitions are even and small; the keys of the texts need no sort.
    parts = parts.join(table.select("key", "weight", "word").hint("shuffle_hash"), "key", "left")
    own, word, added = F.col("own").isNotNull(), F.col("word"), F.col("times") * F.col("weight")
    rows = parts.groupBy("row_id").agg(
        *(F.max(f"own.{c}").alias(c) for c in ("doc_id", "held_out", "n_tokens")),
        F.sum(F.when(own, F.col("own.n_frequent")).when(word, F.col("times"))).alias("n_known"),
        F.sum(F.when(own, F.col("own.base")).when(word, added)).alias("base"),
        F.sum(F.when(own, F.col("own.gain")).when(~word, added)).alias("gain"),
    )
    base, gain = (F.col(c) / float(np.log(10)) for c in ("base", "gain"))
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + gain).alias("score"),
    )
