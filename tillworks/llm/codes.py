"""Product-quantised vector codes with codebooks trained by Lloyd rounds that skip distances by norm-of-sum bounds.

Vectors are cut into equal parts, each of which has a codebook of its own. After a full search a part keeps, for each group of
entries, a lower bound on the distance to the group's nearest entry (its own aside) and the round that the bound was made in.
As all rounds' codebooks are retained, a later round lowers the bound by how far an entry has really moved since then, the
length of the sum of its moves, and not by the sum of their lengths. Only groups whose bound does not exceed the exact
distance to the part's own entry are searched again, in whole numbers; their bounds get a new stamp, the others keep theirs.

Every round is one pass over the stored vectors and their bounds; each task adds the sums of its parts as one further row, so
that new codebooks need no second pass. The driver holds the codebooks only, whose size is set by the parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import stored

PARTS, ENTRIES, ROUNDS, GROUPS = 16, 64, 2, 4
SLACK = 1e-9  # of bounds, above the rounding of square roots


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries; exact for whole numbers that the type holds."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def _below(d2: np.ndarray) -> np.ndarray:
    """Square roots, rounded down to single precision."""
    return np.nextafter(np.sqrt(d2.astype(float)).astype(np.float32), np.float32(0))


class History:
    """The codebooks of all rounds so far, [round][part, entry, component], and what they imply for bounds."""

    def __init__(self, books: list[np.ndarray], groups: int) -> None:
        self.books, entries = books, books[-1].shape[1]
        self.starts = np.unique(np.linspace(0, entries, min(groups, entries) + 1).astype(int)[:-1])
        self.ends = np.append(self.starts[1:], entries)
        self.group_of = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)

    def moves(self) -> np.ndarray:
        """[round, part, group]: how far an entry of the group at most has come from that round until now."""
        now = self.books[-1].astype(float)
        length = [np.sqrt(((now - then.astype(float)) ** 2).sum(2)) for then in self.books]
        return np.stack([np.maximum.reduceat(m, self.starts, axis=1) for m in length])

    def search(self, x: np.ndarray, part: int) -> tuple[np.ndarray, ...]:
        """Nearest entries, their squared distances and each group's bound, without any bound to start from."""
        d2 = squares(x, self.books[-1][part])
        code, rows = d2.argmin(1), np.arange(len(x))
        others = d2.astype(float)
        others[rows, code] = np.inf
        return code, d2[rows, code], _below(np.minimum.reduceat(others, self.starts, axis=1))

    def search_again(self, x: np.ndarray, part: int, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray, moves: np.ndarray):
        """The same from a former round's entries, bounds and stamps; the latter two are brought up to date in place. Also
        the number of distances computed."""
        book, now, rows = self.books[-1][part], len(self.books) - 1, np.arange(len(x))
        own = ((x - book[code]) ** 2).sum(1)
        reach = np.sqrt(own.astype(float)) * (1 + SLACK) + SLACK
        low = bound - moves[stamp, part, np.arange(len(self.starts))] * (1 + SLACK)
        open_ = low <= reach[:, None]
        best, new, computed = own.copy(), code.copy(), len(x)
        first, second = np.full(low.shape, np.inf), np.full(low.shape, np.inf)
        nearest = np.full(low.shape, -1)
        for g, (start, end) in enumerate(zip(self.starts, self.ends)):
            r = np.flatnonzero(open_[:, g])
            if not len(r):
                continue
            d2 = squares(x[r], book[start:end])
            computed += d2.size
            k, at = d2.argmin(1), np.arange(len(r))
            least = d2[at, k]
            wins = (least < best[r]) | ((least == best[r]) & (k + start < new[r]))
            new[r[wins]], best[r[wins]] = (k + start)[wins], least[wins]
            others = d2.astype(float)
            others[at, k] = np.inf
            first[r, g], second[r, g], nearest[r, g] = least, others.min(1), k + start
        searched = np.where(nearest == new[:, None], second, first)
        bound[open_] = _below(searched[open_])
        stamp[open_] = now
        left = rows[(new != code) & ~open_[rows, self.group_of[code]]]  # the entry it leaves belongs to the others now
        g = self.group_of[code[left]]
        bound[left, g] = np.minimum(np.nextafter(low[left, g].astype(np.float32), np.float32(-np.inf)), _below(own[left]))
        stamp[left, g] = now
        return new, best, computed


def _cells(values: np.ndarray) -> pa.Array:
    """One binary cell for each row of an array."""
    data, n = np.ascontiguousarray(values), len(values)
    width = data.nbytes // n if n else 0
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _values(column: pa.Array, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape).copy()


def _dense(lists: pa.Array, parts: int, width: int, kind: type) -> np.ndarray:
    length = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), parts * width), kind)
    out[np.arange(parts * width)[None, :] < length[:, None]] = lists.flatten().to_numpy()
    return out.reshape(len(lists), parts, width)


def _sums(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """[entry, components and count] of one part's rows."""
    out = np.zeros((entries, x.shape[1] + 1), np.int64)
    if x.dtype == np.float64:  # below 2^53 in total, as each is below 2^26
        for k in range(x.shape[1]):
            out[:, k] = np.bincount(code, x[:, k], entries)
    else:
        np.add.at(out[:, :-1], code, x)
    out[:, -1] = np.bincount(code, minlength=entries)
    return out


def _pass(history: History, kind: type, last: bool):
    """One round over rows ``vec_id``, ``label``, ``v`` and, but in the first, ``code``, ``bound`` and ``stamp``."""
    parts, entries, width = history.books[-1].shape
    groups, now = len(history.starts), len(history.books) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = History([b.astype(kind) for b in history.books], groups)
        moves = here.moves()
        total, seen, kept = np.zeros((parts, entries, width + 1), np.int64), False, None
        for batch in batches:
            if not len(batch):
                continue
            x, n = _dense(batch.column("v"), parts, width, kind), len(batch)
            code, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            if now:
                before = _values(batch.column("code"), np.uint8, (parts,)).astype(np.int64)
                bound = _values(batch.column("bound"), np.float32, (parts, groups))
                stamp = _values(batch.column("stamp"), np.uint16, (parts, groups))
            else:
                bound, stamp = np.zeros((n, parts, groups), np.float32), np.zeros((n, parts, groups), np.uint16)
            for p in range(parts):
                if now:
                    own, d2, _ = here.search_again(x[:, p], p, before[:, p], bound[:, p], stamp[:, p], moves)
                else:
                    own, d2, bound[:, p] = here.search(x[:, p], p)
                code[:, p] = own
                error += d2.astype(np.int64)
                if not last:
                    total[p] += _sums(x[:, p], own, entries)
            kept = [batch.column("vec_id"), batch.column("label")]
            if last:
                yield pa.RecordBatch.from_arrays([*kept, _cells(code), pa.array(error)], ["vec_id", "label", "code", "error"])
                continue
            seen = True
            none = pa.nulls(n, pa.list_(pa.int64()))
            columns = [*kept, batch.column("v"), _cells(code), _cells(bound), _cells(stamp), none]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "code", "bound", "stamp", "sums"])
        if seen:
            row = [pa.nulls(1, kept[0].type), pa.nulls(1, kept[1].type), pa.nulls(1, pa.list_(pa.int64()))]
            row += [pa.nulls(1, pa.binary())] * 3 + [pa.array([total.ravel()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(row, ["vec_id", "label", "v", "code", "bound", "stamp", "sums"])

    return run


def _updated(book: np.ndarray, state: DataFrame) -> np.ndarray:
    """The next codebook: floors of the means; entries without parts stay."""
    rows = state.where("sums is not null").select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    parts, entries, width = book.shape
    sums = np.zeros(parts * entries * (width + 1), object)
    for at, s in rows.collect():
        sums[at] = s
    sums = sums.reshape(parts, entries, width + 1)
    out = book.copy()
    for p, e in zip(*np.nonzero(sums[:, :, -1])):
        out[p, e] = [int(s) // int(sums[p, e, -1]) for s in sums[p, e, :-1]]
    return out


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS
) -> tuple[DataFrame, np.ndarray]:
    """Codes of a stored table of ``vec_id``, ``label`` and ``v`` (whole numbers), and the codebooks [part, entry, component].

    The codes are a stored table ``vec_id``, ``label``, ``code`` (a byte for each part) and ``error`` (sum of squares). Rows
    whose ``v`` is null are dropped; shorter vectors, and the last part, are filled up with 0. Codebooks start from the rows
    with the smallest vec_id (null last, then by ``v``), fewer if there are fewer. Ties go to the lower entry. Repeated rows count
    each. Further columns are ignored. An empty table gives an empty result and codebooks of no entry. Squared distances that a
    long cannot hold are an error.
    """
    if not 0 < entries <= 256 or not 0 <= rounds < 1 << 16:
        raise ValueError("at most 256 entries and 65535 rounds")
    kept = vectors.select("vec_id", "label", "v").where("v is not null")
    far = F.array_max(F.transform("v", lambda x: F.greatest(x, -x)))
    dims, most = kept.agg(F.max(F.size("v")), F.max(far)).first()
    width, most = -(-(dims or 0) // parts), most or 0
    if 4 * (width + 1) * (most + 1) ** 2 >= 2**63:
        raise OverflowError("a squared distance does not fit into a long")
    kind = np.float64 if 4 * (width + 1) * (most + 1) ** 2 < 2**52 and most < 2**26 else np.int64
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    label = kept.schema["label"].dataType.simpleString()
    coded = f"vec_id long, label {label}, code binary, error long"
    book = np.zeros((parts, len(first), width), np.int64)
    if not len(first):
        return kept.sparkSession.createDataFrame([], coded), book
    for e, row in enumerate(first):
        book[:, e] = np.pad(np.array(row.v, np.int64), (0, parts * width - len(row.v))).reshape(parts, width)
    books, state = [book], kept
    kinds = f"vec_id long, label {label}, v array<long>, code binary, bound binary, stamp binary, sums array<long>"
    for k in range(rounds):
        state = stored(state.mapInArrow(_pass(History(books, groups), kind, False), kinds), f"round-{k}")
        books.append(_updated(books[-1], state))
        state = state.where("sums is null").drop("sums")
    return stored(state.mapInArrow(_pass(History(books, groups), kind, True), coded), "codes"), books[-1]


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """The vectors that codes stand for: ``vec_id`` and ``v``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.shape
        for batch in batches:
            code = _values(batch.column("code"), np.uint8, (parts,))
            v = books[np.arange(parts)[None, :], code].reshape(len(batch), parts * width)
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * parts * width
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "v"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, v array<long>")


def reported(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``code`` (two hex digits a part), ``error``, ``label_error`` (the sum of ``error`` over equal labels, nulls
    together) and ``codebooks_sha256`` of a stored table of codes."""
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    rows = codes.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return rows.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _oracle_rounds(rounds: int) -> str:
    out = []
    for k in range(rounds + 1):
        out.append(f"""a{k} AS (
    SELECT rid, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
        SELECT rid, x.p, e, (x1 - c1) ** 2 + (x2 - c2) ** 2 + (x3 - c3) ** 2 + (x4 - c4) ** 2 AS d FROM x JOIN b{k} ON x.p = b{k}.p
    ) GROUP BY rid, p
)""")
        mean = ", ".join(f"coalesce(m{i}, c{i}) AS c{i}" for i in range(1, 5))
        means = ", ".join(f"((sum(x{i}) - ((sum(x{i}) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m{i}" for i in range(1, 5))
        out.append(f"""b{k + 1} AS (
    SELECT b{k}.p, b{k}.e, {mean} FROM b{k} LEFT JOIN (
        SELECT x.p, a{k}.e, {means} FROM x JOIN a{k} ON x.rid = a{k}.rid AND x.p = a{k}.p GROUP BY x.p, a{k}.e
    ) m ON m.p = b{k}.p AND m.e = b{k}.e
)""")
    return ", ".join(out[:-1])


ORACLE = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
    SELECT rid, p, v[4 * p + 1] AS x1, v[4 * p + 2] AS x2, v[4 * p + 3] AS x3, v[4 * p + 4] AS x4
    FROM kept, (SELECT unnest(range({PARTS})) AS p)
), b0 AS (
    SELECT p, rid - 1 AS e, x1 AS c1, x2 AS c2, x3 AS c3, x4 AS c4 FROM x WHERE rid <= {ENTRIES}
), {_oracle_rounds(ROUNDS)}, books AS (
    SELECT sha256(string_agg(c1 || ',' || c2 || ',' || c3 || ',' || c4, ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS}
), done AS (
    SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM done JOIN kept USING (rid), books
"""
