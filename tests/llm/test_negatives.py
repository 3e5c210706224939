"""Hard negatives against a plain search over all rows, and the integer product against numpy's."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillmark.llm import negatives
from rillmark.llm.negatives import Heaps, mine, strassen

SCHEMA = "vec_id bigint, embedding array<float>, label int, p int, id string, s double"


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(1, 40), st.integers(0, 40), st.integers(1, 9), st.integers(0, 1 << 30))
def test_product_of_any_shape(m, k, n, leaf, seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(-1 << 62, 1 << 62, (m, k)), r.integers(-1 << 62, 1 << 62, (k, n))
    assert (strassen(a, b, leaf) == a @ b).all()  # both modulo 2^64


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.integers(0, 50)), max_size=20), max_size=5))
def test_heaps_merge_in_any_parts(parts):
    heaps = Heaps(3)
    for part in parts:
        heaps.push(*(np.array([x[i] for x in part], np.int64) for i in range(3)))
    every = [x for part in parts for x in part]
    want = [x for g in range(4) for x in sorted((y for y in every if y[0] == g), key=lambda y: (-y[1], y[2]))[:3]]
    assert list(zip(heaps.slot.tolist(), heaps.score.tolist(), heaps.id.tolist(), strict=True)) == want


def plain(rows, every, positives=5, negatives=10):
    own = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        it = (str(label), [math.floor(256 * float(np.float32(x))) for x in v])
        own[i] = min(own.get(i, it), it)
    score = {(a, b): sum(x * y for x, y in zip(own[a][1], own[b][1], strict=False))
             for a in own if a % every == 0 for b in own if a != b}
    out = []
    for a in (a for a in own if a % every == 0):
        order = sorted((b for b in own if b != a), key=lambda b: (-score[a, b], b))
        for p in [b for b in order if own[b][0] == own[a][0]][:positives]:
            ps = score[a, p]
            near = [b for b in order if own[b][0] != own[a][0] and 30 * ps <= 100 * score[a, b] <= 90 * ps][:negatives]
            out += [(a, p, k + 1, b, ps, score[a, b]) for k, b in enumerate(near)]
    return sorted(out)


def got(spark, rows, every):
    return sorted(tuple(r) for r in mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0).collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(negatives, "TILE", (3, 7))
    monkeypatch.setattr(negatives, "BLOCK", (5, 40))


def test_equals_a_plain_search_over_blocks_and_tiles(spark, small):
    r = random.Random(5)
    # few distinct components, so scores tie often; one label holds a third of the rows
    rows = [(i, [r.choice((-0.5, 0.0, 0.25, 1.0)) for _ in range(6)], r.choice((1, 1, 2, 3)), 1, "x", 0.5) for i in range(150)]
    rows += [(i + 500, rows[3][1], 2, 1, "x", 0.5) for i in range(60)]  # one very common vector
    want = plain(rows, 10)
    assert len(want) > 100 and got(spark, rows, 10) == want


def test_rows_that_take_no_part_and_odd_vectors(spark):
    one = [0.5, 0.25, -0.1]
    rows = [(0, one, 1), (1, one, 1), (2, [0.3, 0.2, 0.0], 2), (3, [0.3], 2), (4, [], 2), (5, None, 2), (6, one, None),
            (None, one, 2), (7, [0.3, None, 0.1], 2), (8, [0.3, float("nan"), 0.1], 2), (9, [float("inf"), 0.0, 0.1], 2),
            (10, one, 1), (10, one, 1), (10, [0.1, 0.1, 0.1], 3), (11, [0.2, 0.1, 0.0, 9.0], 3), (12, [-0.9, 0.0, 0.0], 1)]
    rows = [(*x, 1, "x", 0.5) for x in rows]
    want = plain(rows, 5)
    assert want and got(spark, rows, 5) == want
    assert got(spark, [], 5) == [] and got(spark, rows[1:3], 5) == []


def test_products_beyond_64_bits_are_an_error(spark):
    rows = [(i, [1e9, 1e9], 1, 1, "x", 0.5) for i in range(3)]
    with pytest.raises(Exception, match="leave 64 bits"):
        got(spark, rows, 1)
