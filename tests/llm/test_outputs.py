"""Archives, shards, mixes, packed ids, searches and language-model scores."""

from __future__ import annotations

import gzip
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

import tree_in_memory
from test_minhash import table
from tillworks.llm import mixing, packing, queries, sharding, suffix_tree, topk, warc
from tillworks.llm.storage import open_folder

SF = "/root/testdata/sf0.001"

PAGES = [
    (1, "http://a/", "<p>same</p>", 0), (5, None, "<p>same</p>", 0), (3, "http://c/\r\nX: y", "<p>same</p>", 0), (2, "u", None, 0),
    (4, "u", "", 0), (None, "u", "", 0), (None, "v", "nullé", 0), (None, "v", "nullé", 0), (7, "w", "twice", 0), (7, "w", "twice", 0),
    (8, "w", "x" * 3_000_000 + "é", 0), (9, "w", "\r\n\r\nWARC/1.1\r\n\x1f\x8b\x08", 0),
]


def test_archives_read_back(spark, tmp_path):
    pages = table(spark, tmp_path, PAGES, "page_id long, url string, html string, row_id int")
    files = warc.write_archives(pages, file_bytes=2000)
    records = warc.read_archives(files, range_bytes=700, own_only=True).collect()
    assert len(records) == len(PAGES)
    payloads = Counter(p[2] or "" for p in PAGES)
    by_payload = defaultdict(list)
    for r in records:
        if r.record_type == "response":
            text = bytes(r.payload).decode()
            assert r.payload_bytes == len(r.payload) and r.payload_digest == warc.base32_sha1(bytes(r.payload))
            by_payload[text].append(r)
    assert {k: len(v) for k, v in by_payload.items()} == dict.fromkeys(payloads, 1)
    names = {v[0].record_id: (k, v[0]) for k, v in by_payload.items()}
    for r in records:
        if r.record_type == "revisit":
            text, response = names[r.refers_to]
            assert (r.payload_digest, r.payload_bytes, r.payload) == (response.payload_digest, len(text.encode()), None)
    out = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.archived(spark, pages).collect())
    assert out[5, "response", None] == out[1, "revisit", 5] == out[3, "revisit", 5] == 1
    assert out[4, "response", None] == out[2, "revisit", 4] == out[None, "revisit", 4] == 1
    assert out[7, "response", None] == out[7, "revisit", 7] == 1
    whole = b"".join(gzip.decompress(open(r.file.removeprefix("file:"), "rb").read()) for r in files.collect())
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)
    assert warc.archived(spark, pages.limit(0)).count() == 0


def test_foreign_archives_and_bytes_that_are_no_record(spark, tmp_path):
    inner = gzip.compress(warc.record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:inner>"}, b"in"), 0)
    blocks = [b"one", inner, b"\x1f\x8b\x08" * 50, b""]
    made = [warc.record({"WARC-Type": "resource", "WARC-Record-ID": f"<urn:{k}>"}, b) for k, b in enumerate(blocks)]
    data = b"\x1f\x8b\x08junk" + b"".join(map(gzip.compress, made)) + b"\0\0" + gzip.compress(b"no record") + gzip.compress(made[0])[:40]
    (tmp_path / "x.warc.gz").write_bytes(data)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    rows = [(str(tmp_path / "x.warc.gz"), len(data)), (str(tmp_path / "empty.warc.gz"), 0)]
    files = spark.createDataFrame(rows, "file string, bytes long")
    for size in (1, 64, 1 << 20):
        found = warc.read_archives(files, range_bytes=size).collect()
        assert sorted((r.record_id, bytes(r.payload)) for r in found) == [(f"urn:{k}", b) for k, b in enumerate(blocks)]
    assert warc.read_archives(files, own_only=True).count() == 0


def test_members_inside_stored_payloads_are_not_records(spark, tmp_path):
    inner = warc.gzip_member(warc.record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:inner>"}, b"in"), 0)
    outer = warc.gzip_member(warc.record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:outer>"}, inner), 0, level=0)
    assert inner in outer
    (tmp_path / "x.warc.gz").write_bytes(outer)
    files = spark.createDataFrame([(str(tmp_path / "x.warc.gz"), len(outer))], "file string, bytes long")
    assert [r.record_id for r in warc.read_archives(files, range_bytes=20).collect()] == ["urn:outer"]


@pytest.mark.parametrize("rows", [2000, 40, 0])
def test_shards(spark, tmp_path, rows):
    rng = random.Random(rows)
    docs = [(i, " ".join(["word"] * rng.randrange(1, 200)) + str(rng.randrange(rows // 2 + 1)), 1) for i in range(rows)]
    docs += [(None, None, 1), (1, "", 1), (1, "", 1), (3, "long " * 3000, 1)] + [(k, "copy", 1) for k in range(rows // 2)]
    df = table(spark, tmp_path, docs if rows else [], "doc_id long, text string, shard int")
    out = sharding.sharded(df).toPandas()
    assert len(out) == (len(docs) if rows else 0)
    if not rows:
        return
    assert (out["size"] >= 1).all() and Counter(zip(out.doc_id.fillna(-1), out["size"])) == Counter(
        (-1 if i is None else i, len((t or "").encode()) + 1) for i, t, _ in docs)
    for _, shard in out.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    if rows == 2000:
        for column in ("size", "tokens"):
            sums = out.groupby("shard")[column].sum()
            assert len(sums) == 8 and sums.max() < 1.02 * sums.min()
        counts = out.groupby("shard").doc_id.size()
        assert counts.max() < 1.06 * counts.min()
        single = out[out.text_crc32 != zlib.crc32(b"copy")]  # more rows than a shard holds: cut
        assert single.groupby("text_crc32").shard.nunique().max() == 1


def test_placing_goes_to_the_highest_dot_product():
    items = np.array([[0.6, 0.1], [0.6, 0.1], [0.1, 0.7], [0.2, 0.2]])
    assert sharding.place(items, 2).tolist() == [1, 0, 0, 1]
    assert sharding.place(np.zeros((0, 3)), 4).tolist() == []


def test_mix_keeps_to_its_targets(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, "w " * rng.randrange(1, 50), rng.choice(["a", "b", "c", "é", None]), 1) for i in range(3000)]
    docs += [(5000, "huge " * 9000, "a", 1), (5001, None, "empty", 1), (5002, "", "empty", 1), (None, "no id", "z", 1)]
    docs += [(6000, "same words here", "z", 1)] * 500
    df = table(spark, tmp_path, docs, "doc_id long, text string, source string, copies int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)] + [(0, 1), (None, 1), (3, None)], "doc_id long, quality int")
    weights = mixing.quality_weights(labels)
    out = mixing.mixed(df, weights).toPandas()
    again = mixing.mixed(df, weights).toPandas()
    assert Counter(zip(out.doc_id.fillna(-1), out.taken)) == Counter(zip(again.doc_id.fillna(-1), again.taken))
    assert len(out) == len(docs) and (out.taken <= 2 * out["size"]).all() and sorted(out.taken) == sorted(again.taken)
    for source, rows in out.groupby("source", dropna=False):
        target, size = rows.target.iloc[0], rows["size"].sum()
        assert rows.source_size.iloc[0] == size and target <= 2 * size + 1e-9
        assert abs(rows.taken.sum() - target) <= rows["size"].max() / 2 + 1e-9, source
    assert abs(out.groupby("source", dropna=False).target.first().sum() - 1.5 * out["size"].sum()) < 1e-6
    repeated = mixing.repeated(df, weights)
    assert repeated.columns == df.columns and repeated.count() == out.copies.sum()
    assert mixing.mixed(df.limit(0), weights).count() == 0


def test_better_documents_are_taken_more_often(spark, tmp_path):
    docs = [(i, f"one two {i}", "ab"[i % 2]) for i in range(4000)]
    df = table(spark, tmp_path, docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, (i // 2) % 2) for i in range(4000)], "doc_id long, quality int")
    out = mixing.mixed(df, mixing.quality_weights(labels), shares=(1,), total=0.5).toPandas()
    assert out.taken.sum() == 6000 and out[(out.doc_id // 2) % 2 == 1].copies.mean() > 2 * out[(out.doc_id // 2) % 2 == 0].copies.mean()


def naive_best_fit(lengths, width):
    free, rows = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fitting = [c for c in free if c >= lengths[k]]
        if fitting:
            r = free.index(min(fitting))
            free[r] -= lengths[k]
        else:
            free.append(width - lengths[k])
            rows.append(None)
    return sorted(free)


def test_best_fit_decreasing():
    rng = random.Random(0)
    for width in (1, 7, 64):
        lengths = [rng.randrange(1, width + 1) for _ in range(300)]
        rows = packing.best_fit_decreasing(lengths, width)
        assert sorted(k for row in rows for k in row) == list(range(300))
        assert sorted(width - sum(lengths[k] for k in row) for row in rows) == naive_best_fit(lengths, width)
    assert packing.best_fit_decreasing([], 8) == []


def test_packed_ids_give_the_texts_back(spark, tmp_path):
    odd = ["a  b", " lead", "tail ", "\n \n x", "tabs\t \t and  spaces", "ünï 漢字 🙂", "x" * 5000, "word " * 3000, "  ", "\x1c \x1d y"]
    docs = [(i, t, 1) for i, t in enumerate(odd)] + [(None, None, 1), (50, "", 1), (50, "", 1), (51, "same", 1), (51, "same", 1)]
    df = table(spark, tmp_path, docs, "doc_id long, text string, row_id int")
    rows = packing.packed(df, width=256, buffer=4096)
    back = Counter((r.doc_id, r.text) for r in packing.unpacked(rows, width=256).collect())
    assert back == Counter((i, t or "") for i, t, _ in docs)
    for r in packing.with_ids(rows, 256).collect():
        system, path = open_folder(r.file)
        with system.open_input_stream(path) as f:
            matrix, sums, resets = packing.read_file(f.read(), r.n_rows, 256)
        assert matrix[r.row].tolist() == r.ids and sums[r.row].tolist() == r.cu_seqlens
        at = packing.positions(sums[r.row], 256)
        assert np.flatnonzero(at == 0)[: len(resets[r.row])].tolist() == resets[r.row].tolist() and (np.diff(at)[at[1:] > 0] == 1).all()
        for k, crc in enumerate(r.ids_crc32):
            assert crc == zlib.crc32(matrix[r.row][sums[r.row][k] : sums[r.row][k + 1]].tobytes())
    encoder = packing.Encoder()
    for text in odd:
        assert encoder.encode(text).tolist() == encoder.encoding.encode_ordinary(text)
    assert packing.packed(df.limit(0)).count() == 0


def brute_top(rows, every, k):
    out = []
    for i, (q, x) in enumerate(rows):
        if q is not None and q % every == 0 and x is not None:
            scores = [
                (-sum(a * b for a, b in zip(x, y)), math.inf if v is None else v) for j, (v, y) in enumerate(rows) if j != i and y is not None
            ]
            out += [(q, r, v, -s) for r, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_top_k(spark, tmp_path, scale):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * (1 + i % 5) * scale).tolist()) for i in range(400)]
    rows += [(400, [0.0] * 8), (401, None), (402, [float("nan")] * 8), (403, [1.0, None]), (404, [float("inf")]), (405, [3.0 * scale]), (410, [])]
    rows += [(500 + i, [scale] * 8) for i in range(60)] + [(7, [scale] * 8), (7, [scale] * 8), (None, [9 * scale] * 8)]
    df = table(spark, tmp_path, [(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    vectors = df.select("vec_id", topk.integers(F.col("embedding")).alias("v"), "score")
    whole = [(r.vec_id, r.v) for r in vectors.collect()]
    assert sum(v is None for _, v in whole) == 4
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5, block=64).collect()
    assert sorted((r.query_id, r.rank, math.inf if r.vec_id is None else r.vec_id, r.score) for r in got) == brute_top(whole, 50, 5)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(vectors.where("vec_id < 3"), F.col("vec_id") % 2 == 0, 5).count() == 4


def test_suffix_tree_probabilities_sum_to_one(spark, tmp_path):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["a b c d", "b a", "x y", f"r{rng.randrange(999)}"]) for _ in range(40)), 1) for i in range(300)]
    tree, counts = tree_in_memory.learn(table(spark, tmp_path, docs, "doc_id long, text string, n int").select("text"), state_share=1e-3)
    n = {np.uint64(r.key & (1 << 64) - 1): r.n for r in counts.collect()}
    assert sum(n.values()) == tree.tokens and len(n) == tree.distinct and len(tree.levels) == 2
    root = sum(math.exp(tree.root(np.array([c]))[0]) for c in n.values()) + math.exp(tree.root(np.array([0]))[0])
    assert abs(root - 1) < 1e-9
    wide = len(tree.words)
    contexts = [(c, -1) for c in tree.levels[0].contexts] + [
        (tree.levels[0].contexts[c // wide], c % wide) for c in tree.levels[1].contexts]
    assert any(b >= 0 for _, b in contexts)
    for last, before in contexts:
        rows = [[*([before] if before >= 0 else []), last, k] for k in range(wide)] + [[*([before] if before >= 0 else []), last, -1]]
        at = np.arange(len(rows) + 1) * len(rows[0])
        flat = np.array(rows).ravel()
        gain = tree.gains(flat, tree.states(flat, at))[at[1:] - 1]
        seen = np.exp(gain[:-1] + tree.root(tree.counts)).sum()
        others = tree.tokens + tree.distinct + 1 - (tree.counts + 1).sum()
        assert abs(seen + np.exp(gain[-1]) * others / (tree.tokens + tree.distinct + 1) - 1) < 1e-9


def test_scores(spark, tmp_path):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["The cat sat", "on a mat.", f"r{rng.randrange(99)}"]) for _ in range(30)), 1) for i in range(200)]
    docs += [(900, None, 1), (901, "", 1), (None, "the cat", 1), (902, "ÄÖ\x0bthe\x1fcat " * 3, 1), (903, "unseen-word " * 20_000, 1), (903, "twice", 1), (903, "twice", 1)]
    out = suffix_tree.scored(table(spark, tmp_path, docs, "doc_id long, text string, base int")).collect()
    tokens = lambda t: [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w] + [None]
    left = lambda i: zlib.crc32(str(i).encode()) % 7
    seen = Counter(w for i, t, _ in docs if i is not None and left(i) != 2 for w in tokens(t))
    total, distinct = sum(seen.values()), len(seen)
    want = Counter()
    for i, t, _ in docs:
        w = tokens(t)
        base = sum(math.log10((seen[x] + 1) / (total + distinct + 1)) for x in w)
        want[i, i is not None and left(i) == 2, len(w), sum(seen[x] > 0 for x in w), total, round(base, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


@pytest.mark.parametrize("head", [0, 10**6])
def test_scores_from_tables_are_those_of_the_tree_in_memory(spark, tmp_path, head):
    rng = random.Random(5)
    phrases = ["a b c d", "x b c e", "b a", "x y", "y c d a b c"]
    docs = [(i, " ".join(rng.choice([*phrases, f"r{rng.randrange(99)}"]) for _ in range(40))) for i in range(300)]
    df = table(spark, tmp_path, docs)
    tree, counts = tree_in_memory.learn(df.where(suffix_tree.remainder(F.col("doc_id")) != 2).select("text"), depth=3)
    assert len(tree.levels) == 3 and all(len(level.contexts) for level in tree.levels)
    names = {r.key & (1 << 64) - 1: r.n for r in counts.collect()}
    out = {r.doc_id: r.score - r.base_score for r in suffix_tree.scored(df, head=head).collect()}
    assert len(names) == tree.distinct and len(out) == len(docs)
    for i, text in docs:
        words, at = suffix_tree.words_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), suffix_tree.Hasher())
        ids = suffix_tree._find(tree.words, words)
        assert abs(tree.gains(ids, tree.states(ids, at)).sum() / math.log(10) - out[i]) < 1e-6


def test_contexts_need_no_share_of_a_large_corpus(spark, tmp_path):
    """Twelve occurrences make a state among 400,000 tokens (a share of 3e-5), also of three words."""
    rng = random.Random(6)
    docs = [[f"w{rng.randrange(2000)}" for _ in range(1000)] for _ in range(400)]
    for words in docs[:14]:
        words[500:502] = ["pure", "quartz"]
    for words in docs[20:120]:
        words[300:304] = rng.choice([["one", "thin", "red", "line"], ["two", "thin", "red", "stones"]])
    for words in docs[130:230]:
        words[300:302] = ["red", "apples"]
    rows = [(7 * i, " ".join(words)) for i, words in enumerate(docs)] + [(-1, "pure quartz"), (-2, "one thin red line"), (-3, "two thin red line")]
    out = {r.doc_id: r for r in suffix_tree.scored(table(spark, tmp_path, rows)).collect()}
    assert out[-1].train_tokens > 300_000
    assert out[-1].score > out[-1].base_score + 1
    assert out[-2].score - out[-2].base_score > out[-3].score - out[-3].base_score + 0.3


def test_only_grams_that_may_count_are_shuffled(spark):
    """A gram is passed on if its context and its last words may be frequent, and as one number if that says both."""
    words = [suffix_tree.words_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]), suffix_tree.Hasher())[0] for t in (b"a", b"b", b"c")]
    a, b, c = (int(w[0]) for w in words)
    frequent = np.sort(np.array([a, b], np.uint64))
    ids = {w: int(np.searchsorted(frequent, np.uint64(w))) + 1 for w in (a, b)}

    class Filter:
        def __init__(self, *codes):
            self.codes = np.array(codes, np.uint64)

        def holds(self, codes):
            return np.flatnonzero(np.isin(codes, self.codes))

    class Shared:
        def __init__(self, value):
            self.value = value

    filters = Shared((Filter(ids[a]), Filter(ids[b], c | 1 << 63)))
    batch = pa.RecordBatch.from_pylist([{"text": "a b a a b"}, {"text": "a c b c"}, {"text": "a"}])
    out = [r for x in suffix_tree._count_grams(Shared((frequent, None)), filters, 1)([batch]) for r in x.to_pylist()]
    assert len(out) == 2
    assert {"gram": ids[a] << 20 | ids[b], "context": None, "up": None, "n": 2} in out
    assert [(r["context"], r["up"] & (1 << 64) - 1, r["n"]) for r in out if r["gram"] < 0] == [(ids[a], c | 1 << 63, 1)]


@pytest.mark.parametrize("n", [0, 1, 1000, 70_000])
def test_places_of_hashes(n):
    rng = np.random.default_rng(n)
    keys = np.unique(np.append(rng.integers(0, 1 << 64, n, np.uint64), np.uint64([0, (1 << 64) - 1][: n])))
    wanted = np.concatenate([keys[::3], rng.integers(0, 1 << 64, 500, np.uint64), np.array([0, 5, (1 << 64) - 1], np.uint64)])
    assert (suffix_tree.Places(keys).find(wanted) == suffix_tree._find(keys, wanted)).all()


def test_tables_that_are_read_no_more_are_deleted(spark, tmp_path):
    from tillworks.llm.storage import scratch

    folder, path = open_folder(scratch(spark, "x").rsplit("/", 1)[0])
    names = lambda: {f.base_name for f in folder.get_file_info(fs.FileSelector(path, allow_not_found=True))}
    before = names()
    df = table(spark, tmp_path, [(i, "a b c d") for i in range(40)])
    assert suffix_tree.scored(df).count() == 40
    assert [n.split("-")[0] for n in names() - before] == ["weights"]


def test_empty_tables(spark, tmp_path):
    empty = table(spark, tmp_path, [])
    assert suffix_tree.scored(empty).count() == 0
    unlearned = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in suffix_tree.scored(unlearned).orderBy("n_tokens").collect()] == [(1, 0, 0), (3, 0, 0)]


def test_queries_with_sql(spark):
    from testbed.compare import compare
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in queries.oracle_sql().items():
        assert compare(queries.queries()[name](spark, SF), con, sql) is None, name
