"""Half-sweeps against dense linear algebra, and warm starts against cold ones."""

import numpy as np
import pytest

from rillmark.operators import models as ml
from rillmark.operators import warm

K = 4


def dense_solve(weights, other, reg, alpha):
    g = other.T @ other
    out = []
    for w in weights:
        on = w > 0
        y, c = other[on], alpha * w[on]
        out.append(np.linalg.solve(g + (y.T * c) @ y + reg * np.eye(K), y.T @ (1 + c)))
    return np.array(out)


def dense_loss(weights, x, y, reg, alpha):
    s = x @ y.T
    return (((1 + alpha * weights) * ((weights > 0) - s) ** 2).sum() + reg * ((x ** 2).sum() + (y ** 2).sum()))


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(1)
    weights = (r.random((30, 20)) < 0.3) * r.integers(1, 5, (30, 20))
    weights[0] = r.integers(1, 5, 20)  # a user with every item
    weights[np.arange(30), np.arange(30) % 20] += 1
    rows = [(f"u{u:02d}", f"i{i:02d}", int(w)) for (u, i), w in np.ndenumerate(weights) if w]
    return weights.astype(float), spark.createDataFrame(rows, "user_id string, item_id string, interaction_count int")


def frame(spark, key, m):
    return spark.createDataFrame([(f"{key}{k:02d}", v.tolist()) for k, v in enumerate(m)],
                                 f"{'user' if key == 'u' else 'item'}_id string, features array<double>")


def matrix(df, key):
    return np.array([r.features for r in df.orderBy(key).collect()])


@pytest.mark.parametrize("rows", [1 << 14, 3])  # with 3 rows to a block nearly every id is summed in parts
def test_half_sweep_equals_dense(spark, data, monkeypatch, rows):
    monkeypatch.setattr(warm, "ROWS", rows)
    weights, pairs = data
    y = np.random.default_rng(2).standard_normal((20, K))
    got = warm.half_sweep(pairs, "user_id", "item_id", frame(spark, "i", y), y.T @ y, 0.3, 2.0)
    assert np.allclose(matrix(got, "user_id"), dense_solve(weights, y, 0.3, 2.0))
    x = matrix(got, "user_id")
    assert warm.loss(pairs, got, frame(spark, "i", y), K, 0.3, 2.0) == pytest.approx(dense_loss(weights, x, y, 0.3, 2.0))
    other = warm.half_sweep(pairs, "item_id", "user_id", got, x.T @ x, 0.3, 2.0)
    assert np.allclose(matrix(other, "item_id"), dense_solve(weights.T, x, 0.3, 2.0))


def test_warm_start_beats_cold_and_solves_only_the_changed(spark, data):
    weights, pairs = data
    old = pairs.where("NOT (user_id < 'u05' AND item_id < 'i10') AND item_id <> 'i19'")
    before = warm.cold_fit(old, K, sweeps=8, bound=0.0)
    assert all(b <= a + 1e-9 for a, b in zip(before.losses, before.losses[1:], strict=False))
    changed = warm.changed_users(pairs, old)
    want = {u for u in range(30) if (u < 5 and weights[u, :10].any()) or weights[u, 19]}
    assert {r.user_id for r in changed.collect()} == {f"u{u:02d}" for u in want}
    warmed = warm.warm_fit(pairs, before.users, before.items, changed, rank=K, sweeps=3, bound=0.0)
    cold = warm.cold_fit(pairs, K, sweeps=3, bound=0.0)
    assert warmed.solved_first == len(want) < 30 and cold.solved_first == 30
    assert len(warmed.losses) == 4 and warmed.losses[-1] < cold.losses[-1]
    assert {r.item_id for r in warmed.items.collect()} == {f"i{i:02d}" for i in range(20)}  # the new item has factors
    current = spark.createDataFrame([("als", "negative_loss", -cold.losses[-1])], "model string, metric_name string, value double")
    assert ml.promotion_decision(current, warm.fit_metrics("als", warmed), "negative_loss").first().decision == "promote"


def test_it_ends_when_a_sweep_gains_little(data):
    _, pairs = data
    fit = warm.cold_fit(pairs, K, sweeps=30, bound=0.05)
    gains = [(a - b) / a for a, b in zip(fit.losses, fit.losses[1:], strict=False)]
    assert len(fit.losses) < 31 and gains[-1] < 0.05 and all(g >= 0.05 for g in gains[:-1])


def test_no_pairs(spark, data):
    _, pairs = data
    fit = warm.cold_fit(pairs.where("false"), K)
    assert fit.users.count() == 0 and fit.losses[-1] == 0.0
