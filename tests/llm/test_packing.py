import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faremill.llm import packing, queries
from tests.llm.conftest import messy_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [x.ids + [1] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_sequences(pieces, length=2048):
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length
    return {k: sum(n for _, n in v) for k, v in by.items()}


def test_messy_rows_round_trip(messy):
    pieces = packing.pack(messy, packing.Packing(PATH)).collect()
    check_sequences(pieces)
    expected = sorted(zip([i for i, *_ in messy_rows()], ids_of(t for _, t, _ in messy_rows())), key=str)
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
    for doc_id in {i for i, _ in expected}:
        want = sorted(str(x) for i, x in expected if i == doc_id)
        parts = sorted(by[doc_id], key=lambda x: x[0])
        if len(want) == 1:
            assert str([t for _, ids, _ in parts for t in ids]) == want[0]
        assert sum(len(ids) for _, ids, _ in parts) == sum(len(x) for i, x in expected if i == doc_id)


def test_one_window_at_a_time_equals_all_at_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").coalesce(1)
    totals = []
    for flush in (3000, 1 << 20):
        pieces = packing.pack(docs, packing.Packing(PATH, flush=flush)).collect()
        check_sequences(pieces)
        totals.append(sum(p.length for p in pieces))
    assert totals[0] == totals[1]


def best_cost(at, costs, plan):
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            size = at[j] - at[i]
            if size <= plan.length:
                pad = 0 if size & (size - 1) == 0 else plan.length - size
                best[j] = min(best[j], best[i] + pad + plan.window_cost + costs[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_optimal(seed):
    rng = np.random.default_rng(seed)
    plan = packing.Packing("", length=32, exact=1)
    at = np.concatenate(([0], np.cumsum(rng.integers(1, 20, 60))))
    costs = np.where(rng.random(61) < 0.5, 0.0, rng.integers(1, 30, 61).astype(float))
    cuts = packing.choose_cuts(at, costs, plan)
    assert cuts[-1] == at[-1]
    cost, last, price = 0.0, 0, dict(zip(at.tolist(), costs.tolist()))
    for c in cuts:
        size = c - last
        assert 0 < size <= 32
        cost += (0 if size & (size - 1) == 0 else 32 - size) + plan.window_cost + price[c]
        last = c
    assert cost == pytest.approx(best_cost(at.tolist(), costs.tolist(), plan))


def test_empty_table(nothing):
    assert packing.pack(nothing, packing.Packing(PATH)).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    pieces = queries.QUERIES["op3_queue_packing"](spark, small).collect()
    sizes = check_sequences(pieces)
    whole = dict(zip([r.doc_id for r in rows], ids_of(r.text for r in rows)))
    seen = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = whole[p.doc_id]
        assert p.start == seen[p.doc_id] and p.doc_tokens == len(ids)
        part = np.array(ids[p.start : p.start + p.length], "<u4")
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        seen[p.doc_id] += p.length
    assert {i: len(x) for i, x in whole.items()} == dict(seen)
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values())
    assert padding < 0.02 * sum(sizes.values())
