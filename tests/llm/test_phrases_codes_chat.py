"""Collocations, vector codes and chat transcripts against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_minhash import table
from tillworks.llm import chat, codes, phrases, topk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, longest=5, least=2, cover=100, first=10**9):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in known.items():
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in known.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= cover * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), " ".join(p), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -score))
    return sorted(out)


def found_phrases(docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.mark.parametrize("cover, first", [(100, 10**9), (60, 7)])
def test_phrases_as_counted_by_hand(spark, tmp_path, cover, first):
    rng = random.Random(3)
    words = ["a", "b", "A", "the", "né", "É", "x-y", "中文", "“q”", "w" * 300]
    rows = [(rng.choice(["en", "de", "und", None, ""]), "".join(
        rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), ("en", ""), (None, "a a a a a a a"), ("en", "long " * 30_000), ("en", "of the day. of the day")] + [("de", "of the day")] * 5
    docs = table(spark, tmp_path, [(i, *r, 0, 0) for i, r in enumerate(rows)], "doc_id long, lang string, text string, row_id int, fp int")
    assert found_phrases(docs, least=4, cover=cover, first=first) == brute_phrases(rows, least=4, cover=cover, first=first)


def test_phrases_of_other_lengths_and_no_rows(spark, tmp_path):
    rows = [("en", "a b c d e f g"), ("en", "a b c d e f g"), ("fr", "b a")]
    docs = table(spark, tmp_path, rows, "lang string, text string")
    for longest in (2, 3, 7):
        assert found_phrases(docs, least=2, longest=longest) == brute_phrases(rows, longest, 2)
    assert phrases.collocations(docs.limit(0)).count() == 0 and phrases.collocations(docs).count() == 0


def test_colliding_fingerprints_are_told_apart(spark, tmp_path):
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(40))) for _ in range(20)]
    docs = table(spark, tmp_path, rows, "lang string, text string")
    assert found_phrases(docs, least=3, bits=3) == brute_phrases(rows, least=3)


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 9 * 10**12, 8 * 10**14, 10**13 + 1, 10**13 + 3
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").select(F.expr(phrases.SCORE).alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)


def brute_codes(vectors, parts, entries, rounds):
    """Codes, errors and codebooks of (vec_id, whole numbers) by full searches."""
    kept = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v in kept) // parts)
    x = np.array([list(v) + [0] * (parts * width - len(v)) for _, v in kept], object).reshape(len(kept), parts, width)
    book = x[:entries].swapaxes(0, 1).copy()

    def assign():
        d = ((x[:, :, None, :] - book[None]) ** 2).sum(3).astype(object)
        return d.argmin(2), d.min(2).sum(1)

    for _ in range(rounds):
        code, _ = assign()
        for p in range(parts):
            for e in range(book.shape[1]):
                members = x[code[:, p] == e, p]
                if len(members):
                    book[p, e] = [int(s) // len(members) for s in members.sum(0)]
    code, error = assign()
    return sorted((r[0] is None, r[0] or 0, bytes(c.tolist()), int(e)) for r, c, e in zip(kept, code, error)), book.astype(np.int64)


def found_codes(vectors, **options):
    rows, book = codes.compressed(vectors, **options)
    return sorted((r.vec_id is None, r.vec_id or 0, bytes(r.code), r.error) for r in rows.collect()), book


@pytest.mark.parametrize("scale, rounds, groups", [(300, 2, 4), (3, 5, 3), (2**28, 3, 64), (300, 0, 1)])
def test_codes_as_by_full_search(spark, tmp_path, scale, rounds, groups):
    rng = random.Random(scale)
    rows = [(i // 2 if i % 7 else None, [rng.randint(-scale, scale) for _ in range(rng.choice([12, 12, 12, 10]))], 0, "x") for i in range(400)]
    rows += rows[:20]
    vectors = table(spark, tmp_path, [(*r[:2], None, *r[2:]) for r in rows], "vec_id long, v array<long>, label int, code int, error string")
    want, book = brute_codes([r[:2] for r in rows], 4, 16, rounds)
    got, mine = found_codes(vectors, parts=4, entries=16, rounds=rounds, groups=groups)
    assert got == want and np.array_equal(mine, book)
    decoded = codes.decoded(codes.compressed(vectors, parts=4, entries=16, rounds=rounds)[0], book).collect()
    assert len(decoded) == len(rows) and all(len(r.v) == 12 for r in decoded)


def test_bounds_spare_distances_and_hold():
    rng = np.random.default_rng(5)
    centres = rng.integers(-500, 500, (64, 4))
    x = (centres[rng.integers(0, 64, 5000)] + rng.integers(-20, 20, (5000, 4))).astype(float)
    books, full, searched = [x[None, :64].copy()], 0, 0
    history = codes.History(books, 8)
    code, _, bound = history.search(x, 0)
    stamp = np.zeros(bound.shape, np.uint16)
    for _ in range(6):
        sums = codes._sums(x, code, 64)
        book = books[-1].copy()
        used = sums[:, -1] > 0
        book[0, used] = sums[used, :-1] // sums[used, -1:]
        books = [*books, book]
        history = codes.History(books, 8)
        want, d2, _ = history.search(x, 0)
        code, best, computed = history.search_again(x, 0, code, bound, stamp, history.moves())
        assert np.array_equal(code, want) and np.array_equal(best, d2)
        others = codes.squares(x, books[-1][0])
        others[np.arange(len(x)), code] = np.inf
        true = np.sqrt(np.minimum.reduceat(others, history.starts, axis=1))
        assert (bound - history.moves()[stamp, 0, np.arange(8)] <= true + 1e-6).all()
        full, searched = full + d2.size * 64, searched + computed
    assert searched < full / 3 and len(np.unique(stamp)) > 1


def test_codes_of_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [None, 1.0], None), (5, [inf, 0.0], 2), (6, [0.5, 0.0], None),
            (7, [], None), (7, [], None)]
    raw = table(spark, tmp_path, rows, "vec_id long, embedding array<float>, label int")
    vectors = raw.select("vec_id", "label", topk.integers(F.col("embedding")).alias("v"))
    out = codes.reported(*codes.compressed(vectors, parts=3, entries=2, rounds=1)).collect()
    assert sorted(r.vec_id for r in out) == [1, 6, 7, 7] and {len(r.code) for r in out} == {6}
    by_label = defaultdict(int)
    for r in out:
        by_label[r.vec_id != 1] += r.error
    assert all(r.label_error == by_label[r.vec_id != 1] for r in out) and len({r.codebooks_sha256 for r in out}) == 1
    empty, book = codes.compressed(vectors.limit(0))
    assert codes.reported(empty, book).count() == 0
    with pytest.raises(OverflowError):
        codes.compressed(spark.createDataFrame([(1, [2**40], 0)], "vec_id long, v array<long>, label int"))


def test_log_is_folded(spark):
    say = lambda message, seq, kind, text, turn=None, role=None, conv=1: (conv, message, seq, kind, turn, role, text, "x")
    log = [
        say(1, 1, "open", "", 0, "user"), say(1, 2, "delta", "hel"), say(1, 3, "delta", "lo"), say(1, 3, "delta", "lo"),
        say(2, 1, "open", "draft", 1, "assistant"), say(2, 5, "delta", "!"), say(2, 9, "regenerate", None), say(2, 12, "delta", "b"),
        say(2, 11, "delta", "a"), say(2, 13, "typing", "?"), say(3, 1, "open", None, 2, "user"), say(3, 2, "delta", "x"),
        say(3, 4, "delta", "z"), say(3, 3, "edit", "y"), say(4, 1, "delta", "lost"), say(1, 1, "open", "other", None, None, conv=None),
        say(None, None, "open", "?", 0, "user"),
    ]
    random.Random(1).shuffle(log)
    schema = "conv_id long, message long, seq long, kind string, turn long, role string, text string, part string"
    got = chat.messages(spark.createDataFrame(log, schema).repartition(5)).collect()
    assert {(r.conv_id, r.message): (r.turn, r.role, r.text) for r in got} == {
        (1, 1): (0, "user", "hello"), (1, 2): (1, "assistant", "ab"), (1, 3): (2, "user", "yz"), (1, 4): (None, None, "lost"),
        (None, 1): (None, None, "other"), (1, None): (0, "user", "?"),
    } and len(got) == 6
    assert chat.messages(spark.createDataFrame([], schema)).count() == 0


def test_marks_in_texts_are_escaped():
    rng = random.Random(2)
    parts = ["\\", "<turn:", "</turn>", "</turn>\n", "<", ">", "/turn>", "turn:", "\n", "t", "\\/", "é", "🙂", "<\\turn:user>", chat.CONTROL]
    said = [("".join(rng.choices(parts, k=rng.randint(0, 6))), "".join(rng.choices(parts, k=rng.randint(0, 12)))) for _ in range(500)]
    made = [chat.turn(*s) for s in said]
    assert list(chat.turns("".join(m[0] for m in made))) == said
    assert [chat.unescape(m[a:b]) for m, a, b in made] == [text for _, text in said]
    assert all(m.count("</turn>") == 1 and m.count("<turn:") == 1 for m, _, _ in made)


@pytest.mark.parametrize("chunk_chars", [1, 50, 1 << 20])
def test_conversations_read_back(spark, tmp_path, chunk_chars):
    rng = random.Random(7)
    texts = [None, "", "a", chat.CONTROL, "é🙂" * 700, "</turn>\n<turn:assistant>", "\\"]
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", None]), rng.choice(texts)) for _ in range(60)]
    rows += [(9, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(200)] + [(9, 7, "assistant", "turn 7")] * 2
    rows += [(10, 0, "assistant", "long" * 500_000)]
    source = table(spark, tmp_path, [(*r, i, "") for i, r in enumerate(rows)], "conv_id long, turn long, role string, text string, message int, seq string")
    chunks = chat.conversations(source.drop("message"))
    if chunk_chars < 1 << 20:
        said = source.select("conv_id", F.monotonically_increasing_id().alias("message"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
        chunks = chat.formatted(said, chunk_chars=chunk_chars)
        assert chunks.groupBy("conv_id").count().where("conv_id = 9").first()["count"] > 10
    held = defaultdict(list)
    for r in rows + ([] if chunk_chars < 1 << 20 else [(-7, 0, "user", chat.CONTROL), (-7, 1, "assistant", chat.CONTROL)]):
        held[r[0]].append(r)
    got = {r.conv_id: r for r in chat.digests(chunks).collect()}
    assert got.keys() == held.keys()
    for conv, said in held.items():
        r = got[conv]
        assert r.n_turns == len(said) and r.loss_chars == sum(len(t or "") for _, _, role, t in said if role == "assistant")
        if conv in (9, 10, -7):
            said.sort(key=lambda s: s[1])
            whole = "".join(f"{role}\n{t}\n" for _, _, role, t in said)
            assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
            loss = "".join(t for _, _, role, t in said if role == "assistant")
            assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
            assert r.formatted_chars == sum(len(chat.turn(role, t)[0]) for _, _, role, t in said)
    assert chat.digests(chat.formatted(chat.messages(chat.log_of(source.limit(0).withColumn("message", F.lit(1)))))).count() == 0
