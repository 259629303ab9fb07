"""Near-duplicate classes against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import classes
from tillworks.llm import minhash

SF = "/root/testdata/sf0.001"


def table(spark, tmp_path, rows, schema="doc_id long, text string"):
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def components(n, links):
    """The smallest number of the component of each."""
    root, before = list(range(n)), None
    while root != before:
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def found(df, **options):
    return {r.doc_id: r.class_id for r in minhash.near_duplicates(df, **options).collect()}


def test_as_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = {rows[i][0]: rows[c][0] for i, c in enumerate(classes([t for _, t in rows]))}
    assert found(docs) == want


@pytest.mark.parametrize("pairs_up_to", [1, 1000])
def test_copies_around_one_text(spark, tmp_path, pairs_up_to):
    """Copies near to and far from their text, some of the far ones alike among themselves."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]

    def edited(text, edits):
        text = list(text)
        for _ in range(edits):
            k = rng.randrange(len(text))
            text[k : k + 1] = rng.choice([[], [f"e{rng.randrange(10**6)}"], [text[k], "x"]])
        return text

    texts = [base] + [edited(base, rng.randrange(1, 6)) for _ in range(60)]
    for _ in range(5):
        texts += [far := edited(base, 9), edited(far, 1), edited(far, 2), edited(far, 9)]
    texts = [" ".join(t) for t in texts]
    want = classes(texts)
    assert len(set(want)) > 2
    got = found(table(spark, tmp_path, list(enumerate(texts))), pairs_up_to=pairs_up_to)
    assert [got[i] for i in range(len(texts))] == want


def test_links_deep_in_a_large_bucket(spark, tmp_path, monkeypatch):
    """Many texts that are alike and below the threshold, among them pairs just above it; blocks smaller than the group."""
    monkeypatch.setattr(minhash, "BLOCK_NODES", 64, raising=False)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(400)]

    def edited(text, at):
        return [f"e{rng.randrange(10**12)}" if k in at else w for k, w in enumerate(text)]

    texts = []
    for _ in range(300):
        far = edited(base, rng.sample(range(400), 6))
        first = rng.randrange(362)
        texts += [far, edited(far, range(first, first + 37))]
    sets = [{tuple(t[k : k + 5]) for k in range(396)} for t in texts]
    pairs = ((i, j, len(sets[i] & sets[j])) for i in range(len(sets)) for j in range(i))
    want = components(len(texts), [(i, j) for i, j, both in pairs if both >= 0.8 * (2 * 396 - both)])
    assert 200 < len(set(want)) < 300
    got = found(table(spark, tmp_path, [(i, " ".join(t)) for i, t in enumerate(texts)]))
    assert [got[i] for i in range(len(texts))] == want


def test_blocks_join_what_all_pairs_join():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 90).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: rng.integers(40, 90)], rng.integers(0, 2**63, 8).astype(np.uint64)])) for _ in range(60)]
    root, second = np.arange(60) // 2, np.arange(60) % 3 == 0
    for threshold in (0.7, 0.8):
        for alone in (True, False):
            part = second & (not alone)
            want = {
                (root[i], root[j]) for i in range(60) for j in range(60)
                if root[i] != root[j] and (alone or part[i] < part[j])
                and (both := len(np.intersect1d(sets[i], sets[j]))) >= threshold * (len(sets[i]) + len(sets[j]) - both)
            }
            table = pa.table({
                "node": np.arange(60), "root": root, "second": part, "units": pa.array([x.tobytes() for x in sets], pa.binary()),
            })
            links = minhash._links_of_blocks(threshold)((0, 1, 0, 1, 0 if alone else 1), table).to_pylist()
            assert all((root[x["a"]], root[x["b"]]) in want or (root[x["b"]], root[x["a"]]) in want for x in links)
            assert components(30, [(root[x["a"]], root[x["b"]]) for x in links]) == components(30, want) != list(range(30))


def test_odd_rows(spark, tmp_path):
    long = " ".join(f"t{k % 977}" for k in range(50_000))
    rows = [
        (1, None, 0), (2, "", 1), (3, "!!!", 2), (4, "???", 3), (5, "!!!", 4), (6, "One two", 5), (7, "one, TWO.", 6), (8, long, 7),
        (9, long + " end", 8), (10, "one two three", 9), (None, "no id at all here", 10), (None, "no id at all here", 11),
        (11, "same id here", 12), (11, "same id here", 13), (12, "a b c d e " * 50, 14), (13, "a b c d e " * 25, 15),
    ]
    docs = table(spark, tmp_path, rows, "doc_id long, text string, row_id long")
    out = minhash.near_duplicates(docs)
    got = {r.doc_id: r.class_id for r in out.collect() if r.doc_id is not None}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 3, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10, 11: 11, 12: 12, 13: 13}
    nulls = out.where("doc_id is null").collect()
    assert [r.class_id for r in nulls] == [None, None] and sum(r.kept for r in nulls) == 1
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 6, 8, 10, 11, 12, 13]
    assert {r.row_id for r in kept.collect()} <= set(range(16))


def test_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    assert minhash.near_duplicates(docs).count() == 0 and minhash.keep_one(docs).count() == 0


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    for _ in range(2):
        sets = [np.concatenate([common, a]), np.concatenate([common, b])]
        names = np.concatenate(sets)
        signature = minhash.throw(names, np.repeat([0, 1], 800), 2, 2000)
        assert abs((signature[0] == signature[1]).mean() - 0.6) < 0.04
        assert (minhash.throw(names[:1], np.zeros(1, int), 1, 64) < np.iinfo(np.uint64).max).all()
