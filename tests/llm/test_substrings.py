import hashlib

import pytest

from faremill.llm import queries, substrings
from tests.llm.conftest import frame, messy_rows, words


def brute(rows, length=20):
    """Expected (n_words, n_removed, sha256) of each row."""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, text, *_ in order:
        w = words(text)
        for k in range(len(w) - length + 1):
            place = (i is None, i or 0, k)
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, place), place)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] != (i is None, i or 0, k):
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [1, 2048])
def test_messy_rows(messy, part):
    rows = substrings.with_digest(substrings.dedup(messy, substrings.Windows(part=part))).collect()
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows]
    assert sorted(found, key=str) == brute(messy_rows())


def test_repeats_inside_one_text_and_across(spark):
    w = [f"w{i}" for i in range(50)]
    rows = [
        (1, " ".join(w[:30] + w[:30]), "en"),
        (2, " ".join(w[5:40]), "en"),
        (3, "x " * 45, "en"),
        (4, " ".join(w[25:45] + ["y"] + w[25:44]), "en"),
    ]
    found = substrings.with_digest(substrings.dedup(frame(spark, rows))).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)
    assert found == brute(rows)


def test_empty_table(nothing):
    assert substrings.dedup(nothing).count() == 0


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op1_doubled_windows"](spark, small).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)
    assert found == brute(rows)
