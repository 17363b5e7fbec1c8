import numpy as np
import pytest

from faremill.llm import mixing, queries
from tests.llm.conftest import frame, messy_rows, prose

LABELS = "doc_id long, quality int, toxic int, domain int"


def labelled(spark):
    docs, labels = [], []
    for i in range(240):
        kind = i % 3
        extra = {0: "", 1: " ### $$$ %%% ***", 2: " vile foul nasty"}[kind]
        docs.append((i, prose(i, 30) + extra * 3, "en"))
        labels.append((i, int(kind != 1), int(kind == 2), 5))
    return frame(spark, docs), spark.createDataFrame(labels, LABELS)


def test_rates_bring_totals_to_targets(spark):
    docs, labels = labelled(spark)
    plan = mixing.Mixture(weights=(0.7, 0.2, 0.1))
    rows = mixing.rates(docs, labels, plan).toPandas()
    assert (rows.rate >= 0).all()
    p = rows[["p_good", "p_low", "p_toxic"]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    assert (p.argmax(axis=1) == rows.doc_id.to_numpy() % 3).mean() > 0.95
    totals = (rows.n_tokens * rows.rate).to_numpy() @ p
    assert np.allclose(totals / totals.sum(), plan.weights, atol=2e-3)


def test_replay_is_projected_gradient():
    rng = np.random.default_rng(0)
    p = rng.dirichlet((1, 1, 1), 50)
    residuals = rng.normal(size=(6, 3)).tolist()
    rate = ahead = np.ones(50)
    for t, g in enumerate(residuals):
        fresh = np.clip(ahead - 0.7 * (p @ np.array(g)), 0, None)
        ahead, rate = fresh + t / (t + 3) * (fresh - rate), fresh
    assert np.allclose(mixing.replay(p, residuals, 0.7)[0], rate)
    assert np.allclose(mixing.replay(p, residuals, 0.7)[1], ahead)


def test_mixture_leaves_toxic_out_and_keeps_good(spark):
    docs, labels = labelled(spark)
    taken = mixing.mix_sources(docs, labels)
    assert taken.columns == docs.columns
    ids = [r.doc_id for r in taken.collect()]
    assert not [i for i in ids if i % 3 == 2]
    assert len([i for i in ids if i % 3 == 0]) >= 0.95 * 80


def test_messy_rows_and_empty_tables(spark, messy, nothing):
    no_labels = spark.createDataFrame([], LABELS)
    rows = mixing.rates(messy, no_labels).collect()
    assert len(rows) == len(messy_rows()) and {r.rate for r in rows} == {1.0}
    odd = spark.createDataFrame([(1, 1, 0, 1), (1, 1, 0, 1), (3, 0, 0, 1), (8, None, 1, 1), (None, 1, 1, 1), (99, 1, 1, 1)], LABELS)
    rows = mixing.rates(messy, odd).collect()
    assert len(rows) == len(messy_rows())
    assert all(r.rate >= 0 and r.copies >= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {0}
    assert mixing.rates(nothing, odd).count() == 0
    assert mixing.mix_sources(nothing, no_labels).count() == 0


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.QUERIES["op7_soft_mixing"](spark, small).collect()
    assert len(rows) == docs.count()
    toxic = [r for r in rows if r.doc_id in labels and labels[r.doc_id].toxic == 1 and r.n_tokens > 20]
    assert sum(r.p_toxic > 0.5 for r in toxic) >= 0.9 * len(toxic)
    total = sum(r.n_tokens * r.rate for r in rows)
    assert sum(r.n_tokens * r.rate * r.p_toxic for r in rows) < 0.02 * total
    assert sum(r.n_tokens * r.rate * r.p_good for r in rows) == pytest.approx(0.99 * total, rel=0.02)


def test_production_parameters_meet_the_targets_in_copies(spark):
    docs, labels = [], []
    for i in range(3000):
        low = i % 5 == 0
        docs.append((i, prose(i % 400, 30) + " ### $$$ %%% ***" * 3 * low, "en"))
        labels.append((i, int(not low), 0, 5))
    plan = mixing.Mixture()
    rows = mixing.rates(frame(spark, docs), spark.createDataFrame(labels, LABELS), plan).toPandas()
    p = rows[["p_good", "p_low", "p_toxic"]].to_numpy()
    for times, near in ((rows.rate, 1e-3), (rows.copies, 6e-3)):
        totals = (rows.n_tokens * times).to_numpy() @ p
        assert np.allclose(totals / totals.sum(), plan.weights, atol=near)
    low = rows[rows.doc_id % 5 == 0]
    assert 0 < low.rate.mean() < 0.15 and low.copies.sum() > 0


def test_columns_of_any_name_come_back(spark):
    """Columns named like those that the operator adds are left alone."""
    docs, labels = labelled(spark)
    docs = docs.selectExpr(
        "*", "doc_id AS _rate", "doc_id * 2 AS mixed_rate", "'x' AS MIXED_P0", "doc_id AS mixed_copies",
        "doc_id AS mixed_tokens", "doc_id AS mixed_draw", "doc_id AS _copy",
    )
    rows = mixing.mix_sources(docs, labels).collect()
    assert rows and all(r.mixed_rate == 2 * r.doc_id and r.mixed_draw == r._copy == r.doc_id for r in rows)


def test_null_ids_draw_by_their_text(spark):
    docs, labels = labelled(spark)
    more = frame(spark, [(None, prose(k, 30) + " ### $$$ %%% ***" * 3, "en") for k in range(1000, 1400)])
    plan = mixing.Mixture(weights=(0.4, 0.6, 0.0))
    rows = [r for r in mixing.rates(docs.unionByName(more), labels, plan).collect() if r.doc_id is None]
    assert 0.05 < np.mean([r.rate for r in rows]) < 0.95
    assert abs(np.mean([r.copies for r in rows]) - np.mean([r.rate for r in rows])) < 0.1


@pytest.mark.parametrize(("weights", "met"), [((0.8, 0.15, 0.05), True), ((0.7, 0.3, 0.0), False)])
def test_totals_are_those_of_plain_nonnegative_least_squares(spark, weights, met):
    """Against projected gradient by the textbook, in one array, until nothing moves. Rates
    that reach the totals are not unique, the totals are, also where targets are out of reach."""
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet((2, 1, 0.5), 300), rng.integers(1, 200, 300)
    names = mixing.Names.beside([])
    known = spark.createDataFrame([(int(k), *map(float, x)) for k, x in zip(n, p)], [names.tokens, *names.p])
    plan = mixing.Mixture(weights=weights, tolerance=1e-7, rounds=150)
    found = mixing.fit(known.repartition(3), names.tokens, names.p, plan)
    rate, _ = mixing.replay(p, found.residuals, found.step)
    share = n / n.sum()
    target = np.array(weights) * (share @ p)[0] / weights[0]
    plain = np.ones(300)
    for _ in range(20_000):
        plain = np.maximum(0, plain - found.step * (p @ ((share * plain) @ p - target)))
    assert found.converged == met and np.allclose(found.target, target)
    assert np.allclose((share * rate) @ p, (share * plain) @ p, atol=1e-4 if met else 5e-3)
    assert (np.abs((share * plain) @ p - target).max() < 1e-5) == met


def test_unmet_targets_are_reported(spark):
    names = mixing.Names.beside([])
    known = spark.createDataFrame([(10, 0.9, 0.1, 0.0)], [names.tokens, *names.p])
    with pytest.warns(UserWarning, match="targets"):
        found = mixing.fit(known, names.tokens, names.p, mixing.Mixture(rounds=3))
    assert not found.converged and len(found.residuals) == 3
