import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faremill.llm import language_id as li
from faremill.llm import queries
from tests.llm.conftest import messy_rows


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    k, lengths = 3, np.array([4, 1, 3])
    scores = rng.normal(size=(3, 4, k)) * (np.arange(4)[None, :, None] < lengths[:, None, None])
    moves, first = rng.normal(size=(k, k)), rng.normal(size=k)
    chance, expected, log_z = li.forward_backward(scores, lengths, moves, first)
    all_moves = np.zeros((k, k))
    for c in range(3):
        n = lengths[c]
        marginal, z = np.zeros((n, k)), 0.0
        pairs = np.zeros((k, k))
        for path in itertools.product(range(k), repeat=int(n)):
            w = first[path[0]] + sum(scores[c, t, y] for t, y in enumerate(path))
            w += sum(moves[a, b] for a, b in itertools.pairwise(path))
            w = np.exp(w)
            z += w
            for t, y in enumerate(path):
                marginal[t, y] += w
            for a, b in itertools.pairwise(path):
                pairs[a, b] += w
        assert np.allclose(chance[c, :n], marginal / z)
        assert log_z[c] == pytest.approx(np.log(z))
        all_moves += pairs / z
    assert np.allclose(expected, all_moves)


def test_messy_rows(messy):
    rows = li.identify(messy, li.Tagger(epochs=5)).collect()
    assert len(rows) == len(messy_rows())
    texts = {i: t for i, t, _ in messy_rows()}
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not lettered)
            assert r.lang_pred in ("und", "en", "de", "fr")


def test_nothing_to_learn_and_empty(spark, nothing, messy):
    assert li.identify(nothing).count() == 0
    rows = li.identify(messy.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_held_out_accuracy(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = [r for r in queries.QUERIES["op4_code_switch_crf"](spark, small).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0


def test_switches_inside_a_text_are_seen(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    field = li.learn(docs)
    by = {r.lang: r.text for r in docs.filter("n_chars > 1500").collect()}
    mixed = " ".join(by["en"].split()[:30] + by["de"].split()[:90])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([False]), pa.array([mixed])], names=["doc_id", "held_out", "text"]
    )
    row = next(li.tag([batch], li.Tagger(), field)).to_pylist()[0]
    assert row["lang_pred"] == "de" and 0.6 < row["score"] < 0.9
