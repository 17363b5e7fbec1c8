import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from faremill.llm import queries, repeats
from faremill.llm.words import Words
from tests.llm.conftest import frame, messy_rows, prose, words


def brute_runs(w, least=6, times=4):
    """Every maximal stretch of each lag, with its smallest period by trying all."""
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            stretch = w[s : i + q]
            if len(stretch) >= max(least, times * q) and not any(
                stretch[p:] == stretch[:-p] for p in range(1, q)
            ):
                out.append((s, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def in_one_slice(texts, plan=repeats.Runs()):
    w = Words(pa.array(texts))
    runs = repeats.found(w, plan)
    out = [[] for _ in texts]
    for s, n, q in runs.tolist():
        doc = int(w.doc[s])
        out[doc].append((s - int(w.first[doc]), n, q))
    return out, repeats.collapsed(w, runs).to_pylist()


def test_small_alphabets():
    """Few different words: nested, overlapping and touching runs of all kinds."""
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        n = rng.randint(0, 120)
        texts.append(" ".join(rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(n)))
    runs, kept = in_one_slice(texts)
    for text, found, rest in zip(texts, runs, kept, strict=True):
        assert found == brute_runs(words(text))
        assert rest == brute_kept(words(text), found)
    assert sum(map(len, runs)) > 150


@pytest.mark.parametrize("short", [1, 2, 8])
def test_every_period_is_found(short):
    """Runs of each period and fractional length, inside other words, several in a text."""
    rng = random.Random(short)
    texts = []
    for q in [*range(1, 70), 100, 128, 129, 255, 256, 257, 300]:
        piece = [f"p{rng.randint(0, 3 if q < 20 else 9)}" for _ in range(q)]
        n = 4 * q + rng.randint(-1, q)
        run = [piece[i % q] for i in range(n)]
        head, tail = prose(q, rng.randint(0, 40)), prose(q + 1000, rng.randint(0, 40))
        again = " ".join(run[: rng.randint(3 * q, n)])
        texts.append(" ".join(filter(None, (head, " ".join(run), tail, again))))
    runs, kept = in_one_slice(texts, repeats.Runs(short=short))
    for text, found, rest in zip(texts, runs, kept, strict=True):
        assert found == brute_runs(words(text))
        assert rest == brute_kept(words(text), found)
    assert {q for found in runs for *_, q in found} >= {1, 9, 16, 17, 33, 64, 65, 128, 129}


def test_nested_runs():
    """Periods inside periods: a word repeated within a piece that is itself repeated."""
    piece = "a " * 9 + "b c " * 5 + "d e f " * 6
    texts = [piece * 4, piece * 5 + "x " + piece * 4, ("q " + piece) * 7]
    runs, kept = in_one_slice(texts)
    for text, found, rest in zip(texts, runs, kept, strict=True):
        assert found == brute_runs(words(text))
        assert rest == brute_kept(words(text), found)


def test_marks_are_window_minima():
    rng = np.random.default_rng(1)
    grams = rng.integers(1, 50, 200).astype(np.uint64)
    room = np.concatenate((np.arange(120, 0, -1), np.arange(80, 0, -1)))
    for width in (1, 2, 8, 16):
        expected = set()
        for low, high in ((0, 120), (120, 200)):
            for j in range(low, high - width + 1):
                window = grams[j : j + width]
                expected |= {j + int(i) for i in np.flatnonzero(window == window.min())}
        assert set(repeats.marks(grams, room, width).tolist()) == expected


def expected_row(doc_id, text):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(brute_kept(w, runs).encode()).hexdigest(), n,
    )


def test_messy_rows(spark):
    rows = messy_rows()
    rows += [(i, prose(i, 30 + i % 50), "en") for i in range(100, 400)]
    rows += [(500, "x " * 5, "en"), (501, "x " * 6, "en"), (502, "a b " * 4, "en"), (503, "a b " * 4 + "a", "en")]
    found = repeats.with_digest(repeats.collapse(repeats.planted(frame(spark, rows).repartition(5))))
    expected = [expected_row(i, text) for i, text, _ in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sum(row[1] > 0 for row in expected) > 10


def test_real_outputs(spark):
    docs = frame(spark, [(1, "go go go go go go now\nand then", "en"), (2, None, "en")])
    rows = {r.doc_id: r for r in repeats.collapse(docs).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 6, 1)]
    assert rows[1].text == "go now and then" and rows[1].n_words == 9
    assert rows[2].runs == [] and rows[2].text == ""


def test_no_rows(nothing):
    assert repeats.with_digest(repeats.collapse(repeats.planted(nothing))).count() == 0


def test_impossible_plans():
    for plan in ({"times": 3}, {"short": 3}, {"least": 0}):
        with pytest.raises(ValueError):
            repeats.Runs(**plan)


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = [expected_row(r.doc_id, r.text) for r in rows]
    found = queries.QUERIES["op11_scaled_minimizers"](spark, small).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
