"""The suffix tree as one object in the driver's memory, for small tables. The library makes the same tree as tables."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tillworks.llm.suffix_tree import (
    END, LEAST_DIVERGENCE, PRIOR, SIGNIFICANT, STATE_SHARE, WORD_SHARE, Tally, _find, _frequent, _texts, _words,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Level:
    """States of one context length. A context is its parent state's number times the words plus the word before it."""

    contexts: np.ndarray  # sorted
    counts: np.ndarray
    pairs: np.ndarray  # state number times the words plus the symbol, sorted
    chances: np.ndarray  # natural logarithms
    spare: np.ndarray  # logarithm of the factor on what the parent gives to all other symbols


@dataclass
class Tree:
    words: np.ndarray  # hashes, sorted; the place is the id
    counts: np.ndarray
    tokens: int
    distinct: int
    levels: list[Level] = field(default_factory=list)

    def root(self, n: np.ndarray) -> np.ndarray:
        return np.log((n + 1) / (self.tokens + self.distinct + 1))

    def states(self, ids: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """For each level the state number of the context of that length before each token, or -1."""
        out, state = [], np.zeros(len(ids), np.int64)
        place = np.arange(len(ids)) - np.repeat(offsets[:-1], np.diff(offsets))
        for k, level in enumerate(self.levels, 1):
            before = np.full(len(ids), -1, np.int64)
            before[k:] = ids[:-k]
            known = np.flatnonzero((state >= 0) & (before >= 0) & (place >= k))
            state, last = np.full(len(ids), -1, np.int64), state
            state[known] = _find(level.contexts, last[known] * len(self.words) + before[known])
            out.append(state)
        return out

    def gains(self, ids: np.ndarray, states: list[np.ndarray]) -> np.ndarray:
        """Logarithm of each token's probability, less that under the root."""
        gain = np.zeros(len(ids))
        for level, state in zip(self.levels, states):
            inside = np.flatnonzero(state >= 0)
            gain[inside] += level.spare[state[inside]]
            symbol = inside[ids[inside] >= 0]
            pair = _find(level.pairs, state[symbol] * len(self.words) + ids[symbol])
            own = symbol[pair >= 0]
            gain[own] = level.chances[pair[pair >= 0]] - self.root(self.counts[ids[own]])
        return gain

    def parts(self) -> tuple:
        return self.words, self.counts, self.tokens, self.distinct, [tuple(vars(x).values()) for x in self.levels]

    @classmethod
    def of(cls, parts: tuple) -> Tree:
        return cls(*parts[:4], [Level(*x) for x in parts[4]])


def _count_contexts(shared, depth: int):
    """Counts of (state of the level above, word before its context); numbered as ``Level.contexts``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, tally = Tree.of(shared.value), Tally()
        for _, _, words, offsets in _texts(batches):
            ids = _find(tree.words, words)
            state = tree.states(ids, offsets)[-1]
            before = np.full(len(ids), -1, np.int64)
            before[depth:] = ids[:-depth]
            place = np.arange(len(ids)) - np.repeat(offsets[:-1], np.diff(offsets))
            used = (state >= 0) & (before >= 0) & (place >= depth)
            yield from tally.add((state[used] * len(tree.words) + before[used]).astype(np.uint64))
        yield from tally.rest()

    return run


def _count_symbols(shared):
    """Counts of (state of the last level, next symbol); numbered as ``Level.pairs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, tally = Tree.of(shared.value), Tally()
        for _, _, words, offsets in _texts(batches):
            ids = _find(tree.words, words)
            state = tree.states(ids, offsets)[-1]
            used = (state >= 0) & (ids >= 0)
            yield from tally.add((state[used] * len(tree.words) + ids[used]).astype(np.uint64))
        yield from tally.rest()

    return run


def _expected(tree: Tree, level: Level, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Logarithm of what the parent of each state (of a level not yet in the tree) gives to a symbol."""
    chance = tree.root(tree.counts[symbols])
    if tree.levels:
        parent = level.contexts[states].astype(np.int64) // len(tree.words)
        above = tree.levels[-1]
        pair = _find(above.pairs, parent * len(tree.words) + symbols)
        lower = _expected(Tree(tree.words, tree.counts, tree.tokens, tree.distinct, tree.levels[:-1]), above, parent, symbols)
        chance = np.where(pair >= 0, above.chances[np.maximum(pair, 0)] if len(above.pairs) else 0, lower + above.spare[parent])
    return chance


def _grown(tree: Tree, level: Level, pairs: np.ndarray, n: np.ndarray, significant: float, divergence: float) -> Level:
    """The level with the symbols that diverge, and without contexts that don't diverge enough."""
    wide = len(tree.words)
    state, symbol = pairs // wide, pairs % wide
    expected = _expected(tree, level, state, symbol)
    total = level.counts[state]
    kept = n * (np.log(n / total) - expected) >= significant
    state, symbol, n, expected, total = (x[kept] for x in (state, symbol, n, expected, total))
    spread = np.bincount(state, n / total * (np.log(n / total) - expected), len(level.contexts))
    used = np.flatnonzero(spread >= divergence)
    number = np.full(len(level.contexts), -1)
    number[used] = np.arange(len(used))
    kept = number[state] >= 0
    state, symbol, n, expected, total = (x[kept] for x in (number[state], symbol, n, expected, total))
    chance = (n + PRIOR * np.exp(expected)) / (total + PRIOR)
    own, theirs = (np.bincount(state, x, len(used)) for x in (chance, np.exp(expected)))
    spare = np.log(np.maximum(1 - own, 1e-12) / np.maximum(1 - theirs, 1e-12))
    return Level(level.contexts[used], level.counts[used], state * wide + symbol, np.log(chance), spare)


def learn(
    texts: DataFrame, depth: int = 2, word_share: float = WORD_SHARE, state_share: float = STATE_SHARE,
    significant: float = SIGNIFICANT, divergence: float = LEAST_DIVERGENCE,
) -> tuple[Tree, DataFrame]:
    """The tree of a small stored table with ``text`` in the driver's memory, and the stored counts ``n`` of all word hashes
    ``key``. Its least counts are shares of all tokens."""
    spark = texts.sparkSession
    counts, tokens, distinct = _words(texts)
    tree = Tree(*_frequent(counts, max(word_share * tokens, 1)), tokens, distinct)
    least = max(state_share * tokens, 2)
    for k in range(1, depth + 1):
        if k == 1:
            ids = np.flatnonzero((tree.counts >= least) & (tree.words != END))
            contexts, n = ids.astype(np.int64), tree.counts[ids]
        else:
            shared = spark.sparkContext.broadcast(tree.parts())
            found, n = _frequent(texts.mapInArrow(_count_contexts(shared, k), "key long, n long"), least)
            contexts = found.astype(np.int64)
        level = Level(contexts, n, np.zeros(0, np.int64), np.zeros(0), np.zeros(len(contexts)))
        if not len(contexts):
            break
        shared = spark.sparkContext.broadcast(Tree(tree.words, tree.counts, tokens, distinct, [*tree.levels, level]).parts())
        pairs, n = _frequent(texts.mapInArrow(_count_symbols(shared), "key long, n long"), max(word_share * tokens, 2))
        tree.levels.append(_grown(tree, level, pairs.astype(np.int64), n, significant, divergence))
    return tree, counts
