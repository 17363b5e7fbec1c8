import base64
import random
from collections import Counter

import pytest

from faremill.llm import quality, queries
from tests.llm.conftest import messy_rows, prose, words

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def check(found, rows):
    mine = sorted(((r.doc_id, *(r[c] for c in BASE)) for r in found), key=str)
    assert mine == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert not [r for r in found if r.kept and r.base_failed]


def test_messy_rows(messy):
    check(quality.judge(messy).collect(), [(i, t) for i, t, _ in messy_rows()])
    kept = quality.keep_good(messy)
    assert kept.columns == messy.columns
    good = sorted(str(r.doc_id) for r in quality.judge(messy).collect() if r.kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == good


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (" ".join(f"the word {i} again and again {i} the same" for i in range(2000)), False),
        (base64.b64encode(random.Random(1).randbytes(9000)).decode().replace("A", " "), False),
        (" ".join(prose(s, 12).capitalize() + "." for s in range(40)), True),
    ],
)
def test_bands(text, kept):
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    assert quality.compression(text.encode(), packer, quality.Bands())[0] == kept


def test_empty_table(nothing):
    assert quality.judge(nothing).count() == 0
    assert quality.keep_good(nothing).count() == 0


def test_query_and_labels(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op9_compression_bands"](spark, small).collect()
    check(found, rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    good = [r.kept for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in found if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(good) >= 0.99 * len(good) > 0
    assert sum(bad) < 0.6 * max(1, len(bad))


@pytest.mark.parametrize("size", [2000, 4000, 16000])
@pytest.mark.parametrize("noise", [0.0, 0.35, 0.45])
def test_noise_in_the_tail_of_good_text(spark, small, size, noise):
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    good = [r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    clean = [r for r in docs if r.doc_id in set(good) and r.lang == "en"]
    text = " ".join(dict.fromkeys(r.text for r in clean)).encode()[:size]
    junk = base64.b64encode(random.Random(size).randbytes(size)).decode().replace("A", " ").encode()
    cut = round(size * noise)
    text = text[: size - cut] + junk[:cut]
    assert len(text) == size
    kept, _, chunks, bad = quality.compression(text, packer, quality.Bands())
    assert chunks == -(-size // 1024) and kept == (not noise)
    assert (bad > 0) == bool(noise)
