"""Best items by inner product against a product of all pairs."""

import numpy as np
import pytest

from rillmark.operators import models as ml
from rillmark.operators.topn import norm_blocks, top_items


def frame(spark, key, vectors, start=0):
    return spark.createDataFrame([(f"{key}{k + start:04d}", [float(x) for x in v]) for k, v in enumerate(vectors)],
                                 f"{key}_id string, features array<double>")


def brute(x, y, n, u="user", i="item"):
    out = {}
    for a, v in enumerate(x):
        rated = sorted(((-float(np.dot(v, w)), b) for b, w in enumerate(y)))[:n]
        out[f"{u}{a:04d}"] = [(f"{i}{b:04d}", -s) for s, b in rated]
    return out


def lists(top):
    got = {}
    for r in top.rows.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
        assert r.rank == len(got[r.user_id])
    return got


def test_equals_all_pairs_and_compares_far_fewer(spark):
    r = np.random.default_rng(1)
    x, y = r.standard_normal((60, 8)), r.standard_normal((1500, 8)) * np.exp(r.standard_normal(1500))[:, None]
    top = top_items(frame(spark, "user", x), frame(spark, "item", y), 5, size=32)
    want, got = brute(x, y, 5), lists(top)
    assert {u: [i for i, _ in v] for u, v in got.items()} == {u: [i for i, _ in v] for u, v in want.items()}
    assert all(a[1] == pytest.approx(b[1]) for u in want for a, b in zip(got[u], want[u], strict=True))
    assert top.compared < 0.2 * 60 * 1500
    assert [q["blocks"] for q in top.rounds][:3] == [1, 2, 4]
    users = [q["users"] for q in top.rounds]
    assert users[0] >= 55 and users[-1] < users[0]


def test_equal_norms_ties_and_copies(spark):
    r = np.random.default_rng(2)
    y = r.integers(-1, 2, (300, 4)).astype(float)  # many equal vectors: ties go to the smaller id
    x = r.integers(-1, 2, (20, 4)).astype(float)  # with users of norm zero, whose items all score alike
    x[0] = 0
    top = top_items(frame(spark, "user", x), frame(spark, "item", y), 7, size=16)
    want = brute(x, y, 7)
    assert {u: [i for i, _ in v] for u, v in lists(top).items()} == {u: [i for i, _ in v] for u, v in want.items()}


def test_small_blocks_send_no_more_vectors(spark):
    r = np.random.default_rng(4)
    x, y = r.standard_normal((900, 4)), r.standard_normal((1200, 4))
    y /= np.linalg.norm(y, axis=1)[:, None]  # no block can be left out
    top = top_items(frame(spark, "user", x), frame(spark, "item", y), 5, size=16)
    got = {u: [i for i, _ in v] for u, v in lists(top).items()}
    assert got == {u: [i for i, _ in v] for u, v in brute(x, y, 5).items()}
    assert sum(q["sent"] for q in top.rounds) < 0.3 * 2 * top.compared / 16  # a user or an item for each 16 pairs, as by teams of 16


def test_few_items_none_and_nulls(spark):
    x, y = np.eye(3), np.ones((2, 3))
    assert {u: len(v) for u, v in lists(top_items(frame(spark, "user", x), frame(spark, "item", y), 100)).items()} == {
        f"user{k:04d}": 2 for k in range(3)}
    none = spark.createDataFrame([("x", None), (None, [1.0, 0.0, 0.0])], "item_id string, features array<double>")
    for items in (frame(spark, "item", y).where("false"), none):
        top = top_items(frame(spark, "user", x), items, 3)
        assert top.rows.collect() == [] and top.rows.columns == ["user_id", "item_id", "rank", "score"]
    assert top_items(frame(spark, "user", x).where("false"), frame(spark, "item", y), 3).rows.count() == 0


def test_no_block_holds_more_than_its_share(spark):
    r = np.random.default_rng(3)
    same = r.standard_normal((4000, 4))
    same /= np.linalg.norm(same, axis=1)[:, None]  # all of one norm class
    from rillmark.operators.topn import _vectors
    _, blocks = norm_blocks(_vectors(frame(spark, "item", same), "item_id"), 100)
    counts = [b["items"] for b in blocks.collect()]
    assert sum(counts) == 4000 and max(counts) < 200


def test_fold_in_without_factors(spark):
    events = spark.createDataFrame([("u", "i", 1.0, 0)], "user_id string, item_id string, rating double, timestamp int")
    none = spark.createDataFrame([], "item_id string, features array<double>")
    assert [(r.user_id, r.features) for r in ml.fold_in(events, none, rank=3).collect()] == [("u", [0.0] * 3)]
    assert ml.fold_in(events, none).first().features == []
