import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faremill.llm import neighbours, queries
from faremill.llm.neighbours import Probing

SCHEMA = "vec_id long, embedding array<float>, item int, score int, digest string, rank int"
ALL = Probing(recall=1.0, trial=10_000)  # every true neighbour of every query is met


def brute(rows, nearest=20, every=20):
    """(query_id, rank, vec_id, score) by comparing everything."""
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    scores = {}
    for q, a in good:
        if q % every == 0:
            for i, b in good:
                if i != q and len(a) == len(b):
                    score = float((a * b).sum())
                    scores.setdefault(q, {})
                    scores[q][i] = max(scores[q].get(i, -math.inf), score)
    out = []
    for q, found in scores.items():
        best = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:nearest]
        out += [(q, k, i, score) for k, (i, score) in enumerate(best, 1)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], SCHEMA).repartition(3)


def found(spark, rows, plan=ALL):
    frame = neighbours.nearest(made(spark, rows), F.expr("vec_id % 20 = 0"), plan)
    return sorted(map(tuple, frame.collect()))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (20, [2.0, 1.0, 0.0]), (20, [2.0, 1.0, 0.0]),
        (40, [0.0, 0.0, 0.0]), (60, None), (80, []), (100, [1.0, None, 0.0]), (120, [nan, 1.0, 0.0]),
        (140, [inf, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (-20, [-1.0, -0.0, 0.5]), (160, [1.0, 0.5]),
        (3, [0.5, 1.0]), (180, [7.0]), (5, [-1.0, 0.0, 0.5]), (6, [3.0, -4.0, 1.0]),
        (200, [1.0, 2.0, 3.0]), (200, [-3.0, 2.0, 1.0]), (7, [0.1, 0.1, 0.1]), (7, [-5.0, 5.0, 5.0]),
    ]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("block", "visits"), [(7, 5), (64, 16), (8192, 65536)])
def test_clusters_in_any_groups(spark, block, visits):
    """Lengths differ, clusters differ in spread; groups are split by vectors and queries."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 8)) * rng.uniform(0.3, 3, (10, 1))
    points = np.concatenate([c + rng.normal(size=(60, 8)) * s for c, s in zip(centres, np.linspace(0.02, 0.6, 10))])
    rows = [(int(i), p.tolist()) for i, p in enumerate(points)]
    rows += [(5000 + i, points[7].tolist()) for i in range(90)]  # a hot vector
    rows += [(7000 + i, (points[7] + 1e-4 * i).tolist()) for i in range(90)]  # a hot bucket
    plan = Probing(recall=1.0, trial=10_000, rows=10, block=block, visits=visits)
    assert found(spark, rows, plan) == brute(rows)


def test_few_candidates(spark):
    rows = [(i, [1.0, float(i)]) for i in range(0, 60, 10)]
    assert found(spark, rows) == brute(rows)
    assert len(found(spark, rows)) == 15
    assert found(spark, [(20, [1.0, 2.0])]) == []
    assert found(spark, [(21, [1.0, 2.0]), (22, [1.0, 2.0])]) == []


def test_no_rows(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.expr("vec_id % 20 = 0")).count() == 0


def test_probes_come_by_their_chance():
    """Chances of all buckets add up to 1 and are those of a simulated neighbour."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(400, 6))
    plan = Probing()
    for table in neighbours.tables_of(points, 2, 1.5, 0.8, plan):
        query = points[:3]
        chance = table.chances(query)
        assert np.allclose(chance.sum(axis=1), 1)
        for i in range(3):
            # a step whose projection has the table's deviation along every direction
            cell = table.along(query[i : i + 1]) + rng.normal(size=(200_000, 2)) * 0.8 / 1.5
            cell = np.clip(np.floor(cell).astype(int) - table.low, 0, table.size - 1)
            seen = np.bincount(cell[:, 0] * table.size[1] + cell[:, 1], minlength=table.buckets) / 200_000
            assert np.abs(seen - chance[i]).max() < 0.01
        number = 4
        got = [set() for _ in query]
        for owner, code in table.probes(query, number):
            for o, c in zip(owner.tolist(), code.tolist(), strict=True):
                got[o].add(c)
        for i in range(3):
            assert got[i] == set(np.argsort(-chance[i])[:number].tolist())


def test_sphere_keeps_the_order_of_products():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5)) * rng.uniform(0.1, 4, (200, 1))
    q = rng.normal(size=(4, 5))
    points, asked = neighbours.on_sphere(x, np.linalg.norm(x, axis=1).max()), neighbours.as_query(q)
    assert np.allclose(np.linalg.norm(points, axis=1), 1)
    for i in range(4):
        distance = np.linalg.norm(points - asked[i], axis=1)
        assert (np.argsort(distance) == np.argsort(-(x @ q[i]))).all()


def test_best_ids_doubles_for_shared_ids():
    vectors = np.arange(40, 0, -1.0)[:, None]
    ids = [[7]] * 30 + [[100 + i] for i in range(10)]
    best = neighbours.best_ids(vectors[:, 0].copy(), 0.0, np.array([1.0]), vectors, ids, 3)
    assert best == [(-40.0, 7), (-10.0, 100), (-9.0, 101)]


def test_scan_keeps_the_best():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(9000, 4)), rng.normal(size=(5, 4))
    batches = [pa.record_batch([pa.array([v.tobytes() for v in part], pa.binary())], names=["vector"]) for part in np.split(x, 3)]
    rows = [r for b in neighbours.scan(batches, q, 21) for r in b.to_pylist()]
    for i in range(5):
        best = sorted((r["score"] for r in rows if r["trial"] == i), reverse=True)[:21]
        assert np.allclose(best, np.sort(x @ q[i])[::-1][:21])


def test_query_scores_and_recall(spark, small):
    """Ranks, exact scores and recall of the registered query against all pairs."""
    for folder in (small, "/root/testdata/sf0.1"):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
        ids = np.array([r.vec_id for r in rows])
        x = np.array([r.embedding for r in rows], dtype=float)
        out = queries.QUERIES["op13_stable_probes"](spark, folder).collect()
        got = {}
        for r in out:
            got.setdefault(r.query_id, []).append(r)
        asked = np.flatnonzero(ids % 20 == 0)
        assert set(got) == set(ids[asked].tolist())
        met = total = 0
        where = {int(v): k for k, v in enumerate(ids)}
        for k in asked:
            score = (x * x[k]).sum(axis=1)
            score[k] = -np.inf
            true = set(ids[np.argsort(-score)[:20]].tolist())
            mine = sorted(got[int(ids[k])], key=lambda r: r["rank"])
            assert [r["rank"] for r in mine] == list(range(1, 21))
            assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
            assert all(r.score == score[where[r.vec_id]] for r in mine)
            met, total = met + len(true & {r.vec_id for r in mine}), total + 20
        assert met >= 0.9 * total
