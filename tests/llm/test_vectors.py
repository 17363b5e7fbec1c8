import math
import os

import numpy as np
import pytest

from faremill.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n int, cell int"


def brute(rows, least=0.95):
    units = {}
    for i, v in rows:
        good = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if good:
            v = np.array(v, np.float32).astype(float)
            units.setdefault(i, v / np.linalg.norm(v))
    ids = sorted({i for i, _ in rows if i is not None})
    near = {
        i: {
            j
            for j in ids
            if j != i and i in units and j in units and len(units[i]) == len(units[j])
            and units[i] @ units[j] >= least - 1e-12
        }
        for i in ids
    }
    component = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        component[i] = min(seen)
    return {i: (len(near[i]), component[i], component[i] == i) for i in ids}


def check(found, rows):
    expected = brute(rows)
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id) == (0, None)
        else:
            assert (r.n_links, r.component_id, r.kept) == expected[r.vec_id]


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (3, [1.0, 0.1, 0.0]),
        (4, [0.0, 0.0, 0.0]), (5, None), (6, []), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]),
        (9, [inf, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0, 0.0]), (11, [1.0, 0.0]),
        (12, [3e38, 3e38, 0.0]), (13, [1e-38, 1e-38, 0.0]), (14, [1.0, 0.1, 0.0]), (-7, [0.0, 0.0, 5.0]),
    ]
    check(vectors.join(made(spark, rows)).collect(), rows)


@pytest.mark.parametrize(("cell", "block", "step"), [(5, 2, 3), (40, 10, 7), (4096, 2048, 1024)])
def test_clusters_in_any_cells(spark, cell, block, step):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    points = np.concatenate([c + rng.normal(size=(15, 8)) * s for c, s in zip(centres, np.linspace(0.02, 0.5, 12))])
    rows = [(i * 3 - 50, p.tolist()) for i, p in enumerate(points)]
    rows += [(1000 + i, points[7].tolist()) for i in range(9)]
    plan = vectors.Range(cell=cell, block=block, step=step)
    check(vectors.join(made(spark, rows), plan).collect(), rows)


def test_empty_table(spark):
    assert vectors.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, small):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(queries.QUERIES["op5_pivot_cells"](spark, small).collect(), rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_each_two_blocks_meet_once(spark, kind):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 6))
    points = np.concatenate([c + rng.normal(size=(20, 6)) * 0.13 for c in centres] + [rng.normal(size=(60, 6))])
    rows = [(i * 7 - 99, p.astype(np.float32).astype(float).tolist()) for i, p in enumerate(points)]
    rows += [(5000 + i, rows[3][1]) for i in range(5)] + rows[10:15]
    rows += [(6000 + i, p.tolist()) for i, p in enumerate(rng.normal(size=(30, 4)).round(1))]  # another space
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    plan = vectors.Range(cell=9, block=4, step=3, side=5000)
    check(vectors.join(frame, plan).collect(), rows)


@pytest.fixture
def steps(monkeypatch):
    """Plans of the tables that the operator writes on the way, and the tables still there."""
    plans, tables = {}, {}
    write, remove = vectors.written, getattr(vectors, "discard", None)

    def written(frame, name):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        out = write(frame, name)
        tables[name] = out
        return out

    monkeypatch.setattr(vectors, "written", written)
    if remove:
        def discard(*frames):
            remove(*frames)
            for name in [n for n, t in tables.items() if any(t is x for x in frames)]:
                del tables[name]

        monkeypatch.setattr(vectors, "discard", discard)
    return plans, tables


def test_no_vector_is_shuffled_to_be_compared(spark, steps):
    plans, _ = steps
    points = np.random.default_rng(3).normal(size=(400, 64))  # all cells meet
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    check(vectors.join(made(spark, rows), vectors.Range(cell=40, block=10)).collect(), rows)
    assert "MapInArrow" in plans["cells"]
    assert "Exchange" not in plans["cells"]


def test_tables_of_vectors_do_not_pile_up(spark, steps):
    _, tables = steps
    points = np.random.default_rng(4).normal(size=(2000, 64)).astype(np.float32)
    frame = made(spark, [(i, p.tolist()) for i, p in enumerate(points)])
    vectors.join(frame, vectors.Range(cell=500, block=100)).collect()
    left = [f.removeprefix("file:") for t in tables.values() for f in t.inputFiles()]
    assert sum(map(os.path.getsize, left)) < points.nbytes


def test_pivots_that_are_almost_equal_leave_no_link_out():
    rng = np.random.default_rng(6)
    for k in range(300):
        p = vectors.units(rng.normal(size=(1, 64)))
        step = rng.normal(size=(1, 64))
        step -= (step @ p.T) * p
        step /= np.linalg.norm(step)
        pivots = vectors.units(np.concatenate([p, p + step * 10.0 ** rng.uniform(-8, -3)])).astype(np.float32)
        x, y = vectors.units(np.concatenate([p - 0.157 * step, p + 0.157 * step]))
        for a, b in ((x, y), (y, x)):
            rows = [[(i * 2, i, np.int64(i + 7).tobytes(), np.int64(1).tobytes(), v.tobytes())] for i, v in enumerate((a, b))]
            meeting = vectors.Meeting(*(vectors.Side(r, pivots, "<f8") for r in rows), vectors.Range())
            meeting.run()
            assert x @ y >= 0.95
            assert meeting.left.links.tolist() == [1], k
