"""CSV records that span lines, read in splits, against Spark's reader of whole files."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tillworks.sources import records, tabs

PIECES = ["a", "b c", "\n", '""', "\r\n", ",", "é🙂", " ", "\n\n", "7", "\\", "  \n"]
NOTE = "x" * 5000 + "\n"


def write(folder, seed, files=3, rows=120):
    rng = random.Random(seed)

    def cell():
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 6)))
        return f'"{text}"' if rng.random() < 0.6 or set(text) & set('\n\r,"') else text

    folder.mkdir()
    for f in range(files):
        end = "\n" if f else "\r\n"
        out = ("﻿" if f == 1 else "") + ("\n\n" if f == 2 else "") + f'"Time, stamp",b,"c ""x""",b{end}'
        for k in range(rows):
            cells = [cell() for _ in range(rng.choice([4, 4, 4, 3, 5]))]
            if k == rows // 2:
                cells[1] = f'"{NOTE * 3}"'  # a record over many splits
            out += ",".join(cells) + end + rng.choice(["", "", end])
        (folder / f"p{f}.csv").write_bytes(out.removesuffix(end if f == 2 else "").encode())
    return str(folder)


def splits_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture(autouse=True)
def restored(spark):
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("size, seed, most", [(1 << 27, 1, 1 << 20), (3000, 2, 1 << 20), (1500, 3, 5)])
def test_as_whole_files(spark, tmp_path, monkeypatch, size, seed, most):
    monkeypatch.setattr(records, "MOST_SENT", most)
    path = write(tmp_path / "t", seed)
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    splits_of(spark, size)
    mine = tabs.scan_tab(spark, path)
    assert mine.columns == whole.columns
    assert Counter(map(tuple, mine.collect())) == Counter(map(tuple, whole.collect()))


def test_one_file_is_read_by_many_tasks_without_a_shuffle_of_its_lines(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text("a,b\n" + "".join(f'{k},"line {k}\nand more"\n' for k in range(3000)))
    splits_of(spark, 4000)
    mine = tabs.scan_tab(spark, str(tmp_path / "t"), multiline=True)
    assert sorted(map(tuple, mine.collect())) == sorted((str(k), f"line {k}\nand more") for k in range(3000))
    sizes = mine.rdd.glom().map(len).collect()
    assert sum(n > 0 for n in sizes) > 10 and max(sizes) < 300
    plan = mine.where("a is not null")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_plain_lines_take_the_csv_reader(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text('a,b\n1,"x, ""y"""\n')
    plain = tabs.scan_tab(spark, str(tmp_path / "t"))
    assert "MapInArrow" not in plain._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in plain.collect()] == [("1", 'x, "y"')]


def test_unbalanced_quotes_and_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text('a,b\n1,5" pipe\n2,x\n')
    with pytest.raises(ValueError, match="not balanced"):
        tabs.scan_tab(spark, str(tmp_path / "t"))
    assert [tuple(r) for r in tabs.scan_tab(spark, str(tmp_path / "t"), multiline="file").collect()] == [("1", '5" pipe'), ("2", "x")]
    (tmp_path / "t" / "x.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "t" / "y.csv").write_text('b,a\n1,"x\ny"\n')
    with pytest.raises(Exception, match="header"):
        tabs.scan_tab(spark, str(tmp_path / "t")).collect()


def test_no_records(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text('"a\nb",c\n')
    empty = tabs.scan_tab(spark, str(tmp_path / "t"))
    assert empty.columns == ["a\nb", "c"] and empty.count() == 0
    (tmp_path / "t" / "x.csv").write_text("")
    assert tabs.scan_tab(spark, str(tmp_path / "t"), multiline=True).count() == 0
