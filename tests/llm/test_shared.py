"""Word hashes, the bit filter, components."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from brute import words
from tillworks.llm import components as module
from tillworks.llm.arrow_text import Hasher, slices, word_hashes
from tillworks.llm.bits import BitFilter
from tillworks.llm.components import components


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = ["the cat, the cat", "", None, "ñandú «cat» — the…", "x" * 100_000 + " the"]
    names, hasher = {}, Hasher()
    for first, data, offsets in slices(pa.array(texts), 50):
        hashes, at = word_hashes(data, offsets, hasher)
        for i in range(len(offsets) - 1):
            words = re.findall(r"[^\W_]+", texts[first + i] or "")
            own = hashes[at[i] : at[i + 1]].tolist()
            assert len(own) == len(words)
            for w, h in zip(words, own):
                assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names) == 4


def test_characters_of_scripts_without_spaces_are_words():
    texts = ["東京は、日本の首都です。Tokyo ２０２０年", "ภาษาไทย กขค", "한국어 문장입니다", "𠀀𠀁 x", "カタカナ・テスト（々〇）ｱｲ｡", "😀a naïve", "語" * 5000]
    hasher = Hasher()
    for first, data, offsets in slices(pa.array(texts), 60):
        hashes, at = word_hashes(data, offsets, hasher)
        for i in range(len(offsets) - 1):
            own = hashes[at[i] : at[i + 1]].tolist()
            found = words(texts[first + i].replace("😀", "z"))
            assert len(own) == len(found) and len(set(own)) == len(set(found))


def test_bit_filter_has_no_false_negatives(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    df = spark.createDataFrame([(int(v),) for v in values[:2500]], "h long")
    held = BitFilter.gather(df, "h", 18)
    inside = held.holds(values.view(np.uint64))
    assert set(range(2500)) <= set(inside.tolist()) and len(inside) < 2600
    assert len(BitFilter.gather(df.limit(0), "h", 18).holds(values.view(np.uint64))) == 0


def test_components_of_a_chain_a_star_and_repeated_links(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 3), (7, 3), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 130)} | {200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_meet_all_links_in_one_round_only(spark, monkeypatch):
    """A large group with many links a node: later rounds have only the links between what is still apart."""
    links, stored = [], module.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "links":
            links.append(out.count())
        return out

    monkeypatch.setattr(module, "stored", counted)
    rng = np.random.default_rng(4)
    nodes = rng.permutation(10**6)[:400]
    pairs = {(int(nodes[i]), int(nodes[j])) for i, j in rng.integers(0, 400, (4000, 2)) if i < j}
    got = {r.node: r.root for r in components(spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert got == {x: min(got) for x in got} and set(got) == {x for p in pairs for x in p}
    assert links[0] == len(pairs) and sum(links[1:]) < len(pairs) / 4 and links[-1] == 0
