from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from faremill.llm import minhash, queries
from faremill.llm.components import components
from faremill.llm.storage import written
from faremill.llm.words import Words
from tests.llm.conftest import frame, messy_rows, prose, words


def shingles(text, n=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(rows):
    """Least id of each document's component."""
    sets = {i: shingles(t) for i, t in rows}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = set()
    for ids in where.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    both = sum((sets[a] & sets[b]).values())
                    if both >= 0.8 * sum((sets[a] | sets[b]).values()):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("changes", [1, 3, 8])
def test_signatures_estimate_weighted_similarity(changes):
    a = (prose(1, 30) + " ") * 4 + prose(2, 40)
    w = a.split()
    for c in range(changes):
        w[7 + 13 * c] = f"x{c}"
    b = " ".join(w)
    x, y = shingles(a), shingles(b)
    true = sum((x & y).values()) / sum((x | y).values())
    s = minhash.signatures(minhash.Shingles(Words(pa.array([a, b, ""])), 5), 3000)
    assert abs((s[0] == s[1]).mean() - true) < 0.04
    assert not s[2].any()


def test_messy_rows(messy):
    rows = minhash.find(messy).collect()
    assert len(rows) == len(messy_rows())
    expected = brute([(i, t) for i, t, _ in messy_rows() if i is not None])
    for r in rows:
        if r.doc_id is not None:
            assert r.class_id == expected[r.doc_id] and r.kept == (r.class_id == r.doc_id)
    kept = minhash.keep_one(messy).collect()
    ids = [r.doc_id for r in kept]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in expected.items() if i == c)
    assert kept[0].__fields__ == messy.columns


def test_group_around_an_original(spark):
    """Copies that are like the original but not like each other, and a chain beside them."""
    base = prose(11, 300).split()
    rows = [(500, " ".join(base), "en")]
    for i in range(40):
        w = list(base)
        for k in range(1 + i % 9):
            w[(37 * i + 31 * k) % 300] = f"e{i}x{k}"
        rows.append((i, " ".join(w), "en"))
    for i in range(12):
        rows.append((1000 - i, " ".join(prose(99, 200).split()[i * 4 : i * 4 + 120]), "en"))
    found = {r.doc_id: r.class_id for r in minhash.find(frame(spark, rows)).collect()}
    assert found == brute([(i, t) for i, t, _ in rows])


def test_bound_never_refuses_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b, c = (Counter(rng.integers(0, 12, rng.integers(1, 14)).tolist()) for _ in range(3))
        own_a = sum(n for x, n in a.items() if x not in b and x not in c)
        own_b = sum(n for x, n in b.items() if x not in a and x not in c)
        ta, tb = sum(a.values()), sum(b.values())
        similar = sum((a & b).values()) / sum((a | b).values())
        bound = min(ta - own_a, tb - own_b) / max(ta + own_b, tb + own_a)
        assert similar <= bound + 1e-12


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 13), (13, 14), (14, 10), (7, 7), (None, 3), (3, 2)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(200, i) for i in range(201, 230)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {1: 1, 2: 1, 3: 1} | {i: 10 for i in range(10, 15)}
    expected |= {100 + i: 100 for i in range(41)} | {i: 200 for i in range(200, 230)}
    assert found == expected


def test_few_links_are_followed_in_one_step(spark, monkeypatch):
    """A long chain takes one written table; where there are more links, rounds of joins end alike."""
    from faremill.llm import components as module

    made = []
    monkeypatch.setattr(module, "written", lambda rows, name: (made.append(name), written(rows, name))[1])
    links = [(i, i - 1) for i in range(-50, 150) if i % 40] + [(1000, 7), (None, 5), (3, 3), (7, 1000)]
    frame_ = spark.createDataFrame(links, "a long, b long").repartition(4)
    found = {r.id: r.component for r in components(frame_).collect()}
    assert len(made) == 1
    expected = {i: max(-51, 40 * (i // 40)) for i in range(-51, 150)} | {1000: 0}
    assert found == expected
    assert {r.id: r.component for r in components(frame_, 10).collect()} == expected
    assert len(made) > 2
    assert components(frame_.filter("a = b")).count() == 0


def test_empty_table(nothing):
    assert minhash.find(nothing).count() == 0
    assert minhash.keep_one(nothing).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op6_dart_minhash"](spark, small).collect()
    assert {r.doc_id: r.class_id for r in found} == brute([tuple(r) for r in rows])


def test_unlike_texts_under_one_id_are_documents_of_their_own(spark):
    rows = [
        (1, prose(1), "en"), (1, prose(2), "en"), (1, prose(2), "en"), (2, prose(2), "en"),
        (3, prose(3), "en"), (3, prose(3), "en"), (4, prose(1) + " tail", "en"), (None, prose(9), "en"),
    ]
    docs = frame(spark, rows).repartition(3)
    found = minhash.find(docs).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert len(by[1]) == 2  # both texts are linked, each to its own class
    assert by[2] <= by[1] and by[4] <= by[1] and by[2] != by[4]
    assert by[3] == {3}
    kept = minhash.keep_one(docs.withColumn("_id", docs.doc_id).withColumn("dedup_id", docs.n_chars))
    texts = sorted(r.text.removesuffix(" tail") for r in kept.collect())
    assert texts == sorted(prose(k) for k in (1, 2, 3, 9))
    assert all(r.dedup_id == r.n_chars and r._id == r.doc_id for r in kept.collect())
    again = [sorted((r.doc_id or 0, r.text) for r in minhash.keep_one(docs.repartition(n)).collect()) for n in (1, 5)]
    assert again[0] == again[1]
