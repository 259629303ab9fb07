"""Words of whole Arrow batches as arrays of 64-bit hashes, without a Python object for each word.

A batch of texts is one run of UTF-8 bytes. Word bounds come from a byte mask, word hashes from differences of a running
polynomial sum, so that the work for each byte is a few vectorised operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E6C63D0876A9A63
SLICE_BYTES = 1 << 20
# General, ideographic, vertical, small and full-width punctuation.
SEPARATORS = (
    (0x2000, 0x206F), (0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x303D, 0x303F), (0x30A0, 0x30A0), (0x30FB, 0x30FB),
    (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
)
# Thai to Myanmar, Khmer, radicals, marks, kana and bopomofo, ideographs, their compatibility forms, half-width kana.
UNSPACED = (
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F), (0x3190, 0x9FFF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F),
)


def golden(k: int) -> np.uint64:
    """The k-th multiple of a constant that spreads small numbers over 64 bits."""
    return np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of runs of rows of about ``most`` bytes each. Null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


class Hasher:
    """Hashes of spans of a sequence; equal spans have equal hashes wherever they stand."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, SLICE_BYTES + 1)

            def powers(base: int) -> np.ndarray:
                out = np.full(size, base, np.uint64)
                out[0] = 1
                return np.cumprod(out, dtype=np.uint64)

            self.power, self.inverse = powers(BASE), powers(pow(BASE, -1, 1 << 64))

    def spans(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(codes)
        self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        value = (total[ends] - total[starts]) * self.inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64) * golden(1))


def spans_of(inside: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at row offsets and at ``cuts``, and the row of each."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge[cuts] = True
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    after = np.append(inside, False)
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _within(code: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    at = np.searchsorted([low for low, _ in ranges], code, "right") - 1
    return (at >= 0) & (code <= np.array([high for _, high in ranges])[at])


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True for bytes of letters and digits, and where words are cut within them.

    ASCII alphanumerics and all of UTF-8's longer sequences but Latin-1's and ``SEPARATORS`` are letters. Scripts that are
    written without spaces (``UNSPACED``) are cut before and after each character, so that each is a word.
    """
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    inside = table[data]
    c2 = np.flatnonzero(data[:-1] == 0xC2)
    inside[c2] = inside[c2 + 1] = False
    lead = np.flatnonzero(data >= 0xE0)
    four = data[lead] >= 0xF0
    three, four = lead[~four], lead[four]
    wide = data[three].astype(np.int64), data[three + 1].astype(np.int64), data[three + 2].astype(np.int64)
    code = (wide[0] & 15) << 12 | (wide[1] & 63) << 6 | wide[2] & 63
    between = _within(code, SEPARATORS)
    for k in range(3):
        inside[three[between] + k] = False
    alone = three[~between & _within(code, UNSPACED)]
    ideographs = four[(data[four] == 0xF0) & (data[four + 1] >= 0xA0)]  # U+20000-3FFFF
    return inside, np.concatenate([alone, alone + 3, ideographs, ideographs + 4])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, single characters of unspaced scripts) of lower-cased texts, and the
    offsets of each row's words."""
    inside, cuts = letters(data)
    starts, ends, row = spans_of(inside, offsets, cuts)
    return hasher.spans(data, starts, ends), np.searchsorted(row, np.arange(len(offsets)))


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each element."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def long_lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(values.view(np.int64)))
