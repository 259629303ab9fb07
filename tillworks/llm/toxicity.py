"""Toxicity of documents by a support vector machine on a gapped subsequence kernel.

The strings compared are words: lower case, punctuation removed, bound by two end marks; words of one letter in a row are
joined ("i d i o t"). Two words are alike as far as they share subsequences of three symbols; a subsequence that is
stretched by inserted characters counts less by ``DECAY`` for each place it spans, up to ``SPAN`` places. The kernel is
scaled by word length. Labels are those of documents, so a sentence's words are its instances: words that labelled toxic
documents hold significantly more often (copies of a text count once) are positive, words of other documents negative.

Landmarks (positive and negative words) give a Nyström map of the kernel, in which a linear machine with squared hinge loss
is trained. Its decision is a weighted sum of kernels with the landmarks, which is a sum over the word's subsequences of
one weight each: words are scored from that table, every distinct word of a run of texts once. A logistic regression turns
what the words of a document score into a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrow_text import Hasher, slices, spans_of
from tillworks.llm.storage import stored

SYMBOLS = 64  # 0 none, 1-26 letters, 27-36 digits, 37 and 38 end marks, 40-63 other letters
START, END = 37, 38
SPAN, DECAY = 7, 0.7
LONGEST = 24  # longer words are read through overlapping windows
MAX_DOCUMENTS, MAX_WORDS, MAX_TOXIC_WORDS = 20_000, 10_000, 4_000
TOXIC_LANDMARKS, OTHER_LANDMARKS = 384, 64
SIGNIFICANT = 20.0  # likelihood ratio statistic of a positive word
STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def symbols(data: np.ndarray) -> np.ndarray:
    """The symbol of each UTF-8 byte; 0 for punctuation and all but the first byte of a letter."""
    table = np.zeros(256, np.uint8)
    table[97:123], table[65:91], table[48:58] = np.arange(1, 27), np.arange(1, 27), np.arange(27, 37)
    out = table[data]
    lead = np.flatnonzero(data >= 0xC3)
    follow = data[np.minimum(lead + 1, len(data) - 1)] if len(data) else data
    out[lead] = 40 + (follow.astype(np.int64) + data[lead].astype(np.int64) * 7) % 24
    out[lead[(data[lead] == 0xE2) & ((follow == 0x80) | (follow == 0x81))]] = 0
    return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, and starts, ends and row of each word among them."""
    starts, ends, row = spans_of((data != 32) & ((data < 9) | (data > 13)), offsets)
    code = symbols(data)
    place = np.append(0, np.cumsum(code > 0))
    code, starts, ends = code[code > 0], place[starts], place[ends]
    filled = ends > starts
    starts, ends, row = starts[filled], ends[filled], row[filled]
    single = ends - starts == 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1])
    last = np.append(~joined[1:], True)[: len(starts)]
    starts, ends, row = starts[~joined], ends[last], row[~joined]
    step = LONGEST // 2
    pieces = np.maximum(-((LONGEST - (ends - starts)) // step), 0) + 1
    word = np.repeat(np.arange(len(starts)), pieces)
    piece = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[word] + step * piece
    return code, begin, np.minimum(begin + LONGEST, ends[word]), row[word]


def matrix(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row for each word: its symbols between the end marks, then zeros."""
    length = ends - starts
    at = np.arange(LONGEST + 2)
    inside = (at[None, :] > 0) & (at[None, :] <= length[:, None])
    out = np.zeros((len(starts), LONGEST + 2), np.int32)
    out[inside] = code[(starts[:, None] + at[None, :] - 1)[inside]]
    out[:, 0] = START
    out[np.arange(len(starts)), length + 1] = END
    return out


def _subsequences(m: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Numbers of the three-symbol subsequences (0 in any place: none) with their weight, by the places they span."""
    wide = m.shape[1]
    for i, j in STEPS:
        a, b, c = m[:, : wide - j], m[:, i : wide - j + i], m[:, j:]
        yield np.where(c > 0, (a * SYMBOLS + b) * SYMBOLS + c, 0), DECAY ** (j + 1)


def _scale(m: np.ndarray) -> np.ndarray:
    """One over the kernel norm of a word of as many different symbols."""
    n = (m > 0).sum(1)
    return 1 / np.sqrt(sum(DECAY ** (2 * j + 2) * np.maximum(n - j, 0) for _, j in STEPS) + 1e-9)


def against(m: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The scaled sum of the table's weights over each word's subsequences."""
    total = np.zeros(len(m))
    for number, weight in _subsequences(m):
        total += weight * table[number].sum(1)
    return total * _scale(m)


def features(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences that occur in a few words, and the words' vectors over them as columns."""
    used = np.unique(np.concatenate([number.ravel() for number, _ in _subsequences(m)]))
    used = used[used > 0]
    out = np.zeros((len(used) + 1, len(m)), np.float32)
    words = np.arange(len(m))[:, None]
    for number, weight in _subsequences(m):
        at = np.where(number > 0, np.searchsorted(used, number), len(used))
        np.add.at(out, (at, np.broadcast_to(words, number.shape)), weight)
    out *= _scale(m)[None, :].astype(np.float32)
    return used, out[:-1]


def _table(used: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(SYMBOLS**3)
    out[used] = weights.ravel()
    return out


def kernel(m: np.ndarray, used: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The kernel of words with the words whose vectors (columns over the subsequences ``used``) are given."""
    out, step = np.zeros((len(m), columns.shape[1]), np.float32), 250
    for first in range(0, len(m), step):
        part = m[first : first + step]
        for number, weight in _subsequences(part):
            word, place = np.nonzero(number)
            number = number[word, place]
            at = np.minimum(np.searchsorted(used, number), len(used) - 1)
            hit = used[at] == number
            word, at = word[hit], at[hit]
            if len(word):
                starts = np.flatnonzero(np.append(True, np.diff(word)))
                out[first + word[starts]] += weight * np.add.reduceat(columns[at], starts, axis=0)
        out[first : first + step] *= _scale(part)[:, None].astype(np.float32)
    return out


def spread_out(m: np.ndarray, most: int) -> list[int]:
    """Words that span the others best: each next one is that of which the kernel leaves most unexplained (pivoted
    Cholesky)."""
    left, rows, chosen = np.zeros(len(m)), [], []
    for k in range(len(m)):
        left[k] = (features(m[k : k + 1])[1] ** 2).sum()
    for _ in range(min(most, len(m))):
        k = int(np.argmax(left))
        if left[k] < 1e-3:
            break
        column = against(m, _table(*features(m[k : k + 1])))
        for row in rows:
            column = column - row[k] * row
        rows.append(column / np.sqrt(left[k]))
        left = left - rows[-1] ** 2
        chosen.append(k)
    return chosen


def _newton(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of the linear machine with squared hinge loss; the last column of z is the constant."""
    v = np.zeros(z.shape[1])
    for _ in range(50):
        active = y * (z @ v) < 1
        a = z[active]
        b = a * cost[active, None].astype(np.float32)
        new = np.linalg.solve(ridge * np.eye(len(v)) + b.T @ a, b.T.astype(float) @ y[active])
        if np.abs(new - v).max() < 1e-6:
            break
        v = new
    return v


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    table: np.ndarray  # weight of each subsequence
    bias: float
    logistic: np.ndarray
    learned: bool = True  # False: a constant, as nothing was found to tell documents apart

    def words(self, m: np.ndarray) -> np.ndarray:
        return against(m, self.table) + self.bias

    def documents(self, data: np.ndarray, offsets: np.ndarray, hasher: Hasher, known: dict) -> np.ndarray:
        """What the words of each row score: largest value, counts and share of those above 0, and the constant."""
        code, starts, ends, row = words_of(data, offsets)
        names, first, inverse = np.unique(hasher.spans(code, starts, ends), return_index=True, return_inverse=True)
        values = np.array([known.get(k, np.nan) for k in names.tolist()], np.float64)
        new = np.flatnonzero(np.isnan(values))
        for part in np.array_split(new, len(new) // 20_000 + 1):
            values[part] = self.words(matrix(code, starts[first[part]], ends[first[part]]))
        if len(known) > 1_000_000:
            known.clear()
        known.update(zip(names[new].tolist(), values[new].tolist()))
        n, value = len(offsets) - 1, values[inverse]
        top = np.full(n, -2.0)
        np.maximum.at(top, row, value)
        high = value > 0
        count = np.bincount(row[high], minlength=n)
        strong = np.bincount(row[high], np.minimum(value[high], 2), minlength=n)
        share = np.log((count + 0.05) / (np.bincount(row, minlength=n) + 20))
        top = np.clip(top, -2, 2)
        hit = (top > 0).astype(float)
        return np.stack([top, hit, np.log1p(count), np.log1p(strong), share * hit, hit * top * share, np.ones(n)], 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30)))


def _count_words():
    """Each word's symbols, the numbers of toxic and other rows that hold it, and for both a bit for (the hash of) the word
    before it in each row, for each run of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for first, data, offsets in slices(batch.column("text")):
                code, starts, ends, row = words_of(data, offsets)
                name = hasher.spans(code, starts, ends)
                order = np.lexsort((row, name))
                new = np.append(True, (np.diff(name[order]) != 0) | (np.diff(row[order]) != 0))[: len(order)]
                order = order[new]
                names, at, inverse = np.unique(name[order], return_index=True, return_inverse=True)
                label = toxic[first + row[order]]
                texts = [code[starts[k] : ends[k]].tobytes() for k in order[at]]
                inner = (order > 0) & (row[order - 1] == row[order])
                bit = np.uint64(1) << (np.where(inner, name[order - 1], np.uint64(0)) >> np.uint64(58))
                columns = [pa.array(texts, pa.binary())]
                for v in (1, 0):
                    before = np.zeros(len(names), np.uint64)
                    np.bitwise_or.at(before, inverse[label == v], bit[label == v])
                    columns.append(pa.array(np.bincount(inverse, label == v, minlength=len(names)).astype(np.int64)))
                    columns.append(pa.array(before.view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["word", "n_toxic", "b_toxic", "n_other", "b_other"])

    return run


def _document_features(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), {}
        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                x = model.documents(data, offsets, hasher, known)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(first, len(x)), lists], ["toxic", "x"])

    return run


def _apart(kind: str) -> Column:
    """The rows that hold a word, as far as different words stand before it: copies of one text count once. (An estimate
    from 64 hash bits; where most are set, the word is too common for copies to matter.)"""
    rows, bits = F.col(f"n_{kind}").cast("double"), F.bit_count(F.col(f"b_{kind}"))
    return F.when(bits < 48, F.least(rows, -64 * F.log(1 - bits / F.lit(64.0)))).otherwise(rows)


def _codes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return matrix(data, ends - [len(w) for w in words], ends)


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_words: int = MAX_WORDS) -> Model:
    """Learn from labelled documents: ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1; null: no label).

    At most ``max_documents`` labelled documents, chosen by a hash of doc_id, ``MAX_TOXIC_WORDS`` words of toxic ones, and
    ``max_words`` frequent and as many other negative words are used. Equal rows (doc_id and text) of a chosen doc_id count
    once, and if its texts differ, at most ``max_documents`` of all, chosen by a hash of the text. A doc_id with contradicting labels is toxic. Without two kinds of labels, or without any
    significant word, every document gets the share of toxic ones.
    """
    chosen = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    sample = docs.select("doc_id", F.lower("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = sample.dropDuplicates(["doc_id", "text"]).orderBy(F.xxhash64("text", "doc_id"), "text", "doc_id").limit(max_documents)
    sample = stored(sample.select("text", F.col("toxic").cast("long").alias("toxic")), "labelled-documents")
    sizes = {int(r.toxic): r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
    constant = Model(np.zeros(SYMBOLS**3), -1.0, np.array([0, 0, 0, 0, 0, 0, np.log(rate / (1 - rate))]), False)
    if len(sizes) < 2:
        return constant

    counted = sample.mapInArrow(_count_words(), "word binary, n_toxic long, b_toxic long, n_other long, b_other long")
    counted = counted.groupBy("word").agg(
        *(F.sum(c).alias(c) for c in ("n_toxic", "n_other")), *(F.bit_or(c).alias(c) for c in ("b_toxic", "b_other"))
    )
    counted = stored(counted.select("word", _apart("toxic").alias("t"), _apart("other").alias("o")), "labelled-words")
    share = F.lit(sizes[1] / (sizes[0] + sizes[1]))
    n = F.col("t") + F.col("o")

    def entropy(k: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)

    ratio = 2 * (entropy(F.col("t"), share) + entropy(F.col("o"), 1 - share)) * F.signum(F.col("t") / n - share)
    counted = counted.withColumn("ratio", ratio)
    positive = counted.where(F.col("ratio") >= SIGNIFICANT).orderBy(F.desc("ratio"), "word").limit(MAX_TOXIC_WORDS).collect()
    if not positive:
        return constant
    clean = counted.where((F.col("o") > 0) & (F.col("ratio") < SIGNIFICANT / 4))
    negative = clean.orderBy(F.desc("o"), "word").limit(max_words).collect()
    negative += clean.orderBy(F.xxhash64("word"), "word").limit(max_words).collect()
    common = sorted({bytes(r.word) for r in negative})
    found = [bytes(r.word) for r in positive]

    order = np.random.default_rng(7).permutation(len(common))[:OTHER_LANDMARKS]
    words = _codes(found + common)
    marks = spread_out(words[: len(found)], TOXIC_LANDMARKS) + [len(found) + k for k in sorted(order)]
    used, columns = features(words[marks])
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(float))
    large = values > 1e-4
    nystroem = vectors[:, large] / np.sqrt(values[large])
    z = np.hstack([kernel(words, used, columns) @ nystroem.astype(np.float32), np.ones((len(words), 1), np.float32)])
    y = np.where(np.arange(len(words)) < len(found), 1.0, -1.0)
    v = _newton(z, y, np.where(y > 0, len(common) / len(found) / 4, 1.0), 1.0)
    model = Model(_table(used, columns @ (nystroem @ v[:-1])), float(v[-1]), constant.logistic)

    rows = sample.mapInArrow(_document_features(model), "toxic long, x array<double>").toArrow()
    x = np.stack(rows["x"].to_numpy(zero_copy_only=False))
    model.logistic = _logistic(x, rows["toxic"].to_numpy().astype(float))
    return model


def scorer(spark, model: Model):
    """A column function: the probability that a lower-cased text is toxic. Empty and null texts have one too."""
    shared = spark.sparkContext.broadcast((model.table.astype(np.float32), model.bias, model.logistic))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher, known, model = Hasher(), {}, Model(*shared.value)
        for texts in batches:
            parts = [model.probability(model.documents(d, at, hasher, known)) for _, d, at in slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null doc_id is not held out, but has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows whose score is below 0.5, learned as in ``scored``; columns stay as they are. A model that found nothing to
    tell documents apart rejects none."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    if not model.learned:
        return docs
    return docs.where(scorer(docs.sparkSession, model)(F.lower("text")) < 0.5)


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` (clashing ones replaced) and ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from 0.5).

    Learns from labelled rows that are not held out. Repeated rows get equal scores; an empty table gives none.
    """
    model = train(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    score = scorer(docs.sparkSession, model)
    return docs.withColumns({"held_out": held_out(F.col("doc_id")), "score": score(F.lower("text"))}).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
