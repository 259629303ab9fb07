"""The pipeline's stages, each against plain versions on what the one before has kept."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from brute import classes, words
from tillworks.llm import mixing, packing, toxicity
from tillworks.llm.storage import stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest given tables with planted copies, near copies, benchmark passages and odd rows."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(COLUMNS).collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rng = random.Random(5)
    long = [d for d in docs if d[1] and len(words(d[1])) > 120][:12]
    extra = []
    for k, (_, text, lang, source, _) in enumerate(long):
        changed = text.split(" ")
        changed[len(changed) // 2] = f"changed{k}"
        extra += [(9000 + k, text, lang, source, len(text)), (9100 + k, " ".join(changed), lang, source, len(text))]
    for k, item in enumerate(items[:8]):
        before, after = (" ".join(f"x{rng.randrange(10**6)}" for _ in range(40)) for _ in range(2))
        extra.append((9200 + k, f"{before} {item} {after}", "en", "web", 1))
    extra += [(9300, None, None, None, None), (9301, "", "en", "web", 0), (None, "no id " * 30, "en", None, 1), (9302, "word " * 30_000, "en", "web", 1)]
    spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage reads, and last what the last one returns."""
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], folder), name))
    return frames


def rows(df):
    return Counter(map(tuple, df.select(COLUMNS).collect()))


def test_stages_keep_the_columns_and_only_drop_rows(kept):
    for before, after in zip(kept[:3], kept[1:4]):
        assert after.columns == COLUMNS and after.schema == before.schema
        assert not rows(after) - rows(before)
    assert set(rows(kept[4])) <= set(rows(kept[3]))


def test_toxic_documents_go(spark, folder, kept):
    scores = toxicity.scored(kept[0].select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = Counter(r.doc_id for r in scores.where("predicted = 1").collect())
    gone = rows(kept[0]) - rows(kept[1])
    assert Counter(r[0] for r in gone.elements()) == toxic


def test_one_document_of_each_class_stays(kept):
    found = sorted(rows(kept[1]).elements(), key=lambda r: (r[0] is None, r[0] or 0))
    root = classes([r[1] for r in found])
    assert sorted(rows(kept[2]).elements(), key=str) == sorted((r for i, r in enumerate(found) if root[i] == i), key=str)
    left = {r[0] for r in rows(kept[2])}
    assert not left & set(range(9000, 9200)) and len(found) > len(left) + 20


def test_benchmark_passages_go_and_clean_documents_stay(spark, folder, kept):
    items = [words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    runs = {tuple(i[k : k + 8]) for i in items for k in range(len(i) - 7)}
    gone = {r[0] for r in rows(kept[2]) - rows(kept[3])}
    assert gone >= {r[0] for r in rows(kept[2])} & set(range(9200, 9208)) and len(gone) >= 8
    for doc_id, text, *_ in rows(kept[2]):
        said = words(text)
        if not any(tuple(said[k : k + 8]) in runs for k in range(len(said) - 7)):
            close = max((len(set(said) & set(i)) for i in items), default=0)
            assert doc_id not in gone or close >= 8


def test_documents_are_repeated_as_the_sql_says(spark, folder, kept, tmp_path):
    con = duckdb.connect()
    kept[3].write.parquet(str(tmp_path / "documents"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    con.execute(f"CREATE VIEW labels AS SELECT * FROM '{folder}/labels.parquet/*.parquet'")
    rel = con.sql(mixing.ORACLE)
    taken, sizes = Counter(), {}
    for r in rel.fetchall():
        row = dict(zip(rel.columns, r))
        taken[row["doc_id"]] += row["taken"]
        sizes[row["doc_id"]] = row["size"]
    times = Counter(r[0] for r in rows(kept[4]).elements())
    assert {d: n for d, n in taken.items() if n} == {d: times[d] * sizes[d] for d in times if sizes[d]}
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) == sizes[d] for d, t, *_ in rows(kept[4]))


def test_packed_ids_are_the_mixed_texts(spark, folder, kept):
    back = packing.unpacked(kept[5].drop("ids")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in rows(kept[4]).elements())


def test_run_is_all_stages(spark, folder, kept):
    whole = packing.unpacked(corpus_pipeline.run(spark, folder).drop("ids")).collect()
    assert Counter((r.doc_id, r.text) for r in whole) == Counter((r[0], r[1] or "") for r in rows(kept[4]).elements())


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        schema = spark.read.parquet(f"{SF}/{name}.parquet").schema
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
