"""Decontamination, toxicity and URL verdicts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import words
from test_minhash import table
from tillworks.llm import decontaminate, queries, toxicity, urls

SF = "/root/testdata/sf0.001"


def test_verbatim_passages_are_found_and_nothing_else(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op3_decontaminate(spark, SF).collect()}
    docs = {r.doc_id: " ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: " ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert got == {(d, i) for d, text in docs.items() for i, item in items.items() if f" {item} " in f" {text} "} and got


def test_substitutions_and_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    item = [f"q{rng.randrange(10**6)}" for _ in range(30)]
    noise = [f"n{rng.randrange(10**6)}" for _ in range(3000)]
    swapped = list(item)
    for k in (4, 11, 18, 25):
        swapped[k] = "other"
    docs = [
        (1, " ".join(noise[:50] + swapped + noise[50:90]), "a"), (2, " ".join(noise + item[5:25]), "b"),
        (3, " ".join(noise[:200] + item[:7] + noise[200:]), "c"), (4, None, "d"), (5, "", "e"),
        (None, " ".join(item).upper() + "!", "f"), (6, " ".join(item), "g"), (6, " ".join(item), "g"), (7, "short", None),
    ]
    bench = [(1, " ".join(item), 0), (2, None, 0), (3, "", 0), (4, " ".join(item), 0), (None, "alone here", 0), (5, "short", 0)]
    benchmark = spark.createDataFrame(bench, "item_id long, text string, doc_id int")
    df = table(spark, tmp_path, docs, "doc_id long, text string, text_key string")
    rows = {r.doc_id: r for r in decontaminate.leaks(df, benchmark).collect()}
    assert set(rows) == {1, 2, 6, None} and {r.item_id for r in rows.values()} == {1}
    assert (rows[1].equal_words, rows[1].overlap_words, rows[1].doc_word, rows[1].item_word) == (26, 30, 50, 0)
    assert (rows[2].equal_words, rows[2].doc_word, rows[2].item_word) == (20, 3000, 5)
    kept = decontaminate.without_leaks(df, benchmark)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7]
    assert decontaminate.leaks(df.limit(0), benchmark).count() == 0
    assert decontaminate.without_leaks(df, benchmark.limit(0)).count() == df.count()


def overlap(doc, item, penalty=decontaminate.PENALTY):
    """The most equal words of a stretch, on any diagonal, whose beginnings and ends all score above zero."""
    most = 0
    for shift in range(1 - len(item), len(doc)):
        same = [doc[k] == item[k - shift] for k in range(max(shift, 0), min(len(doc), shift + len(item)))]
        for a in range(len(same)):
            now, peak, n = 0.0, 0.0, 0
            for x in same[a:]:
                now, n = now + (1 if x else -penalty), n + x
                if now <= 0:
                    break
                if now > peak:
                    peak, most = now, max(most, n)
    return most


def test_replaced_words_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    items = {i: [f"v{rng.randrange(60)}x{i}" for _ in range(n)] for i, n in enumerate((40, 25, 16, 13, 11, 10, 9, 7, 5, 4))}
    docs = {}
    for d in range(400):
        item = items[rng.randrange(len(items))]
        low = rng.randrange(max(1, len(item) - 9))
        part = [w if rng.random() > rng.choice((0, 0.1, 0.25, 0.35)) else "other" for w in item[low : low + rng.randrange(4, 26)]]
        before, after = ([f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(12))] for _ in range(2))
        docs[d] = before + part + after
    docs[400] = items[0][:9] + ["other"] * 8 + items[0][17:23] + ["other"] * 2 + items[0][25:29]
    bench = [(i, " ".join(w)) for i, w in items.items()]
    df = table(spark, tmp_path, [(d, " ".join(w)) for d, w in docs.items()])
    found = decontaminate.leaks(df, spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = {
        (d, i): overlap(doc, item) for d, doc in docs.items() for i, item in items.items()
        if len(item) >= decontaminate.LEAST_ITEM and overlap(doc, item) >= min(len(item), decontaminate.MIN_WORDS)
    }
    assert {(r.doc_id, r.item_id): r.equal_words for r in found} == want and len(want) > 100 and want[400, 0] == 10
    assert {i for _, i in want} == set(range(9))


def test_some_mask_fits_every_overlap():
    """Walks over all alignments that no mask fits into: state is what masks still see, score, highest score and equal words.
    None may reach a new highest score with ``MIN_WORDS`` equal words, which would be an overlap."""
    masks, seen = [(int(m, 2), len(m)) for m in decontaminate.MASKS], set()
    wide = max(n for _, n in masks) - 1
    todo = [(1, 1, 1.0, 1.0, 1)]
    while todo:
        bits, n, now, peak, equal = todo.pop()
        for same in (1, 0):
            score, seen_bits = now + (1 if same else -decontaminate.PENALTY), bits << 1 | same
            if score <= 0 or any(n + 1 >= m and seen_bits & mask == mask for mask, m in masks):
                continue
            words = min(equal + same, decontaminate.MIN_WORDS)
            assert score <= peak or words < decontaminate.MIN_WORDS
            state = (seen_bits & (1 << wide) - 1, min(n + 1, wide), score, max(score, peak), words)
            if state not in seen:
                seen.add(state)
                todo.append(state)
    assert len(seen) > 1000


def test_seeds_do_not_depend_on_blocks():
    words, offsets = np.arange(1000, dtype=np.uint64) % np.uint64(37), np.array([0, 3, 3, 500, 507, 1000])
    whole, parts = ({(m, p, h) for at, hs, m in decontaminate.seeds(words, offsets, decontaminate.MASKS, most) for p, h in zip(at.tolist(), hs.tolist())}
                    for most in (5000, 17))
    assert whole == parts and len(whole) > 10_000


def test_passages_in_scripts_without_spaces(spark, tmp_path):
    chinese = "人工智能正在改变我们的生活方式和工作方法"
    thai = "ภาษาไทยเขียนโดยไม่เว้นวรรคระหว่างคำ"
    bench = spark.createDataFrame([(1, chinese), (2, thai)], "item_id long, text string")
    docs = [
        (1, f"他说：「{chinese}。」"), (2, f"今天，{chinese[:6]}、{chinese[7:]}很好"), (3, "今天天气很好，我们去公园散步吧。"), (4, f"คำ {thai} คำ"),
        (5, "ประเทศของเรา"),
    ]
    found = decontaminate.leaks(table(spark, tmp_path, docs), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.equal_words) for r in found) == [(1, 1, 20), (2, 1, 13), (4, 2, len(thai))]


def labelled(n=1500, seed=2):
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "tor", "en", "sa", "ri", "du"]
    insults = ["gromble", "vexnik", "snurdle"]
    rows = []
    for i in range(n):
        text = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(40)]
        if toxic := rng.random() < 0.3:
            text[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity_of_held_out_and_disguised_words(spark, tmp_path):
    rows = labelled()
    plain = " ".join(["kalo", "mitor", "ensa"] * 12)
    odd = {
        9001: f"{plain} g r o m b l e {plain}", 9002: f"{plain} grom-ble", 9003: f"{plain} GROMxBLE.", 9004: plain, 9005: None,
        9006: "", 9007: "kalo " * 60_000 + "snurdle", 9008: f"{plain} vex*nik", None: f"{plain} vexnik",
    }
    docs = [(i, t, "x", 0.5) for i, t, _ in rows] + [(k, t, None, 0.5) for k, t in odd.items()]
    df = table(spark, tmp_path, docs, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows] + [(None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.scored(df, labels).collect()}
    held = [(out[i].predicted, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert np.mean([p == y for p, y in held]) > 0.97
    assert [k for k in odd if out[k].predicted] == [9001, 9002, 9003, 9007, 9008, None]
    assert all(0 <= r.score <= 1 for r in out.values())
    kept = toxicity.without_toxic(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in out.items() if not r.predicted}
    assert toxicity.scored(df.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.scored(df.limit(5), labels.limit(0)).collect()} == {1}


def test_a_model_without_evidence_rejects_nothing(spark, tmp_path):
    rows = [(i, f"kalo mitor {i}") for i in range(40)]
    df = table(spark, tmp_path, rows)
    for labels in ([], [(i, None) for i in range(40)], [(i, 1) for i in range(40)], [(i, int(i % 4 > 0)) for i in range(40)]):
        marked = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert sorted(r.doc_id for r in toxicity.without_toxic(df, marked).collect()) == list(range(40))


def test_rows_of_a_repeated_document_are_sampled_too(spark, tmp_path, monkeypatch):
    rows = labelled(300)
    docs = [(i, t) for i, t, _ in rows] + [(1, f"kalo mitor {k}") for k in range(500)] + [(2, "kalo ensa")] * 500
    sizes = []
    keep = toxicity.stored

    def watched(df, name):
        out = keep(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(toxicity, "stored", watched)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    df = table(spark, tmp_path, docs)
    toxicity.train(df, labels, max_documents=400)
    toxicity.train(df, labels, max_documents=2000)
    assert [n for name, n in sizes if name == "labelled-documents"] == [400, 300 + 500 + 1]


def test_kernel_table_equals_sums_over_landmarks():
    codes = toxicity._codes([b"\x01\x02\x03\x04", b"\x05\x02\x03", b"\x01\x02\x01\x02\x03"])
    used, maps = toxicity.features(codes)
    gram = maps.T @ maps
    assert np.allclose(toxicity.kernel(codes, used, maps), gram) and sorted(toxicity.spread_out(codes, 9)) == [0, 1, 2]
    for k in range(3):
        assert np.allclose(toxicity.against(codes, toxicity._table(used, maps[:, k])), gram[:, k])


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.COM/x?y", "a.com", "/x", "com/", "allow"),
    ("https://www.example.com/en/1#t", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://blog.example.com/en/1", "blog.example.com", "/en/1", "example.com/en/", "block"),
    ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("https://x.net/fr/a/b?c#d", "x.net", "/fr/a/b", "net/fr/", "block"),
    ("https://x.net/fr", "x.net", "/fr", None, "allow"),
    ("https://a.com", "a.com", "", None, "allow"),
    ("x://ÄB.com:80/p://q", "Äb.com:80", "/p://q", None, "allow"),
    ("no scheme/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http:///en/\nx?", "", "/en/\nx", None, "allow"),
])
def test_fixed_rules(spark, tmp_path, url, host, path, rule, verdict):
    rows = spark.createDataFrame([(url,)], "url string").select(
        urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path")
    )
    where = F.col("host"), F.col("path")
    r = rows.withColumns({"rule": urls.fixed_rule(*where, urls.RULES, 0), "v": urls.fixed_rule(*where, urls.RULES, 1)}).first()
    assert (r.host, r.path, r.rule, r.v or "allow") == (host, path, rule, verdict)


def test_mined_rules(spark, tmp_path):
    rng = random.Random(1)
    seen, marked = [], []
    for i in range(600):
        tokens = [rng.choice(["casino", "news"]), rng.choice(["win", "read"]), rng.choice("abcdef")]
        bad = tokens[0] == "casino" and tokens[1] == "win"
        seen.append((i, f"http://{tokens[0]}.site.org/{tokens[2]}/{tokens[1]}/{rng.randrange(10**5)}"))
        marked.append((i, 0 if bad and i % 10 else 1, 0))
    extra = [(1000, None), (1001, ""), (1000, "http://casino.site.org/zz/win"), (None, "http://casino.other.org/win?a=1" + "&k=v" * 20_000)]
    pages = table(spark, tmp_path, seen + extra, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("row_id", F.lit("r"))
    labels = spark.createDataFrame(marked + [(0, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    mined = urls.mine(urls.labelled_pages(pages, labels))
    both = {"host:casino", "path:win"}
    assert mined.count() and all(both <= set(r.antecedent) and r.confidence > 0.8 for r in mined.collect())
    out = urls.judged(pages, mined)
    assert out.count() == len(seen) + len(extra) and "row_id" in out.columns
    for r in out.collect():
        assert r.verdict == ("block" if "casino" in (r.url or "") and "win" in r.url else "allow"), r
    assert urls.mine(urls.labelled_pages(pages, labels.limit(0))).count() == 0
    assert urls.judged(pages.limit(0), mined).count() == 0


def test_rules_are_counted_in_all_tokens(spark):
    """Clean URLs have 16 tokens that tell more than x, which all URLs have."""
    long = "/".join(f"g{'abcdefghijklmnop'[k]}" for k in range(16))
    rows = [(f"http://h.org/x/{'' if i % 2 else long}", bool(i % 2)) for i in range(200)]
    assert urls.mine(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0


def test_copies_of_one_url_do_not_fill_the_sample(spark):
    rows = [(i, "http://hot.org/a" if i < 900 else f"http://casino.org/{'abcdefghij'[i % 10]}", i >= 900) for i in range(1000)]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - int(b), 0) for i, _, b in rows], "doc_id long, quality int, toxic int")
    for hot in ("http://hot.org/a", "http://hot.org/b", "http://hot.org/c", "http://hot.org/d"):
        named = pages.withColumn("url", F.when(F.col("url") == "http://hot.org/a", hot).otherwise(F.col("url")))
        mined = urls.mine(urls.labelled_pages(named, labels), max_labelled=500)
        assert any(r.antecedent == ["host:casino"] and 0.06 < r.support < 0.14 for r in mined.collect())
