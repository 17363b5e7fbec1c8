import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from faremill.llm import language_model as lm
from faremill.llm import queries, storage
from tests.llm.conftest import frame, messy_rows, prose, words


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base_scores(rows):
    tokens = [words(low(t)) + [None] for _, t, *_ in rows]
    counts = Counter(w for (i, *_), x in zip(rows, tokens) if not held(i) for w in x)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, *_), x in zip(rows, tokens):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        out.append((i, held(i), len(x), sum(counts[w] > 0 for w in x), n, round(base, 6)))
    return sorted(out, key=str)


def check_base(found, rows):
    mine = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    ]
    assert sorted(mine, key=str) == base_scores(rows)


def test_messy_rows(messy):
    found = lm.score(messy).collect()
    check_base(found, messy_rows())
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    # few words are common enough to be broadcast, the rest are joined
    check_base(lm.score(messy, lm.Model(head=4)).collect(), messy_rows())


def kt(counts):
    """Krichevsky-Trofimov block probability, one symbol after the other."""
    p, seen = 1.0, [0, 0]
    for bit in (0, 1):
        for _ in range(counts[bit]):
            p *= (seen[bit] + 0.5) / (sum(seen) + 1)
            seen[bit] += 1
    return p


def test_tree_against_plain_context_tree_weighting(spark):
    """Every context kept: chances equal those of a recursive textbook tree."""
    texts = [(0, "abab", "en"), (2, "aab", "en")]  # folds that are learned from
    assert not any(held(i) for i, *_ in texts)
    depth = 2
    model = lm.Model(depth=depth, share=1 << 30)
    found = {r.doc_id: r.score for r in lm.score(frame(spark, texts), model).collect()}
    counts = defaultdict(lambda: [0, 0])
    coded = []
    for i, t, _ in texts:
        data = bytes([lm.END] * depth) + t.encode() + bytes([lm.END])
        for k in range(depth, len(data)):
            past = data[k - depth : k][::-1]
            coded.append((i, past, data[k]))
            for b in range(8):
                prefix, bit = (1 << b) | (data[k] >> (8 - b)), data[k] >> (7 - b) & 1
                for d in range(depth + 1):
                    counts[past[:d], prefix][bit] += 1
    contexts = {c for c, _ in counts}

    def weighted(c, prefix):
        own = kt(counts[c, prefix])
        longer = [x for x in contexts if len(x) == len(c) + 1 and x[: len(c)] == c]
        if len(c) == depth or not longer:
            return own
        return 0.5 * own + 0.5 * math.prod(weighted(x, prefix) for x in longer)

    def chance(past, prefix, bit, d=0):
        c = past[:d]
        a = counts[c, prefix]
        own = (a[bit] + 0.5) / (sum(a) + 1)
        if d == depth:
            return own
        stop = 0.5 * kt(a) / weighted(c, prefix)
        return stop * own + (1 - stop) * chance(past, prefix, bit, d + 1)

    expected = defaultdict(float)
    for i, past, byte in coded:
        for b in range(8):
            prefix, bit = (1 << b) | (byte >> (8 - b)), byte >> (7 - b) & 1
            expected[i] += math.log10(chance(past, prefix, bit))
    for i in expected:
        assert found[i] == pytest.approx(expected[i], rel=1e-5)


def test_bytes_after_a_context_sum_to_one():
    rng = np.random.default_rng(1)
    root = rng.integers(0, 9, (1, 256)).astype(float)
    child = np.floor(root * 0.6)
    tree = lm.weigh([(np.zeros(1, int), np.zeros(1, int), root), (np.array([97]), np.zeros(1, int), child)])
    assert np.allclose((10.0 ** tree.cost.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert tree.child[0, 97] == 1 and (tree.child[0] >= 0).sum() == 1


def test_empty_table_and_nothing_to_learn(spark, nothing):
    assert lm.score(nothing).count() == 0
    only_held = next(i for i in range(100) if held(i))
    row = lm.score(frame(spark, [(only_held, "abc", "en")])).first()
    assert row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(4 * math.log10(1 / 256), rel=1e-6)


def test_query_beats_even_chances(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op2_context_tree"](spark, small).collect()
    check_base(found, rows)
    out = [r.bits_per_byte for r in found if r.held_out]
    assert sum(out) / len(out) < 3.2


def test_rare_contexts_of_many_bytes_count(spark):
    """A context met once in a large text still decides, whatever the size of the corpus."""
    assert not held(0) and not held(2)
    rare = "qj0xw7zk"
    common = [(0, prose(s, 400), "en") for s in range(40)]
    rows = [*common, (2, " ".join([rare] * 3), "en")]
    found = {r.doc_id: r.score for r in lm.score(frame(spark, rows)).collect() if r.doc_id == 2}
    wide = {r.doc_id: r.score for r in lm.score(frame(spark, rows), lm.Model(share=1 << 10)).collect() if r.doc_id == 2}
    assert found[2] > wide[2] + 5
    # chunks and tasks of any size give the same scores
    cut = lm.score(frame(spark, rows).repartition(3), lm.Model(chunk=1 << 12, part=1 << 10)).collect()
    assert next(r.score for r in cut if r.doc_id == 2) == pytest.approx(found[2], rel=1e-9)


@pytest.mark.parametrize("share", [0, 60])
def test_sharded_tree_equals_the_dense_one(spark, share):
    plan = lm.Model(depth=3, share=share)
    texts = [prose(s, 12) for s in range(4)]
    counts = [Counter() for _ in range(plan.depth + 1)]
    for t in texts:
        data = bytes([lm.END] * plan.depth) + t.encode() + bytes([lm.END])
        for k in range(plan.depth, len(data)):
            for d in range(plan.depth + 1):
                counts[d][sum(data[k - i] << 8 * (i - 1) for i in range(1, d + 1)), data[k]] += 1
    total = sum(counts[0].values())
    least = max(1, total / share) if share else 1
    levels, above = [], None
    for d, own in enumerate(counts):
        size = Counter()
        for (c, _), n in own.items():
            size[c] += n
        keys = np.array(sorted(c for c, n in size.items() if n >= least or d == 0), dtype=np.int64)
        table = np.zeros((len(keys), 256))
        for (c, byte), n in own.items():
            if c in set(keys.tolist()):
                table[np.searchsorted(keys, c), byte] += n
        parent = np.searchsorted(above, keys & ((1 << 8 * (d - 1)) - 1)) if d else np.zeros(1, int)
        levels.append((keys, parent, table))
        above = keys
    tree = lm.weigh(levels)
    rows = [(i, t, "en") for i, t in zip([0, 2, 4, 6], texts)]
    assert not any(held(i) for i, *_ in rows)
    for r in lm.score(frame(spark, rows), plan).collect():
        data = bytes([lm.END] * plan.depth) + dict((i, t) for i, t, _ in rows)[r.doc_id].encode() + bytes([lm.END])
        expected = 0.0
        for k in range(plan.depth, len(data)):
            at = 0
            for d in range(1, plan.depth + 1):
                if tree.child[at, data[k - d]] < 0:
                    break
                at = tree.child[at, data[k - d]]
            expected += float(tree.cost[at, data[k]])
        assert r.score == pytest.approx(expected, rel=1e-4)


def test_tables_of_strings_go_after_their_last_reader(spark, messy):
    def there():
        folder = Path(storage.shared_folder(spark).removeprefix("file:"))
        return {f for f in folder.glob("*-*") if f.name.partition("-")[0] in ("counts", "grams", "costs", "scores")}

    before = there()
    found = lm.score(messy)
    assert {f.name.partition("-")[0] for f in there() - before} == {"scores"}
    assert found.count() == messy.count()


def test_lists_of_strings_are_packed_and_come_back_whole():
    import pyarrow as pa

    texts = pa.array([" ".join(prose(s, 300) for s in range(40)), prose(1, 50)], pa.large_string())
    key, _ = lm.strings(texts, 6)
    counter = lm.Counter()
    counter.add(key, np.zeros(len(key), np.int32))
    batches = [pa.RecordBatch.from_arrays(b.columns[2:3] + b.columns[1:2] + b.columns[4:], ["place", "chunk", "n", "strings", "times"]) for b in lm.string_rows(counter, 5)]
    places = [p for b in batches for p in b.column(0).to_pylist()]
    assert len(places) == len(set(places)) > 10  # a row for each place, not for each string
    lists = lm.read_lists(batches)
    found, n = lm.merged(lists + lists)
    distinct, times = np.unique(key, return_counts=True)
    assert (found == distinct).all() and (n == 2 * times).all()
    assert {x[0] for x in lists} == {5}
    assert sum(b.nbytes for b in batches) < 10 * len(distinct)  # 24 bytes a row before, without the kind
    many = np.array([0, 1, 4095, 4096, 123456])
    assert np.allclose(lm.log_gamma_of(many, 0.5, lm._FEW_HALF), [math.lgamma(x + 0.5) for x in many], rtol=1e-10)
