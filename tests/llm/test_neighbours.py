import math

import numpy as np
import pytest
from pyspark.sql import types as T

from rillmark.llm.neighbours import build, search

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("code", T.StringType())])


@pytest.fixture(scope="module")
def table_of(spark):
    return lambda rows: spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, w in ok:
        if q in queries:
            near = sorted(((float(np.dot(w, v)), i) for i, v in ok if i != q and len(v) == len(w)), key=lambda x: (-x[0], x[1]))
            out[q] = near[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_of_the_smallest_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    queries = {i for i, _ in rows if i % 20 == 0}
    got, want = found(search(build(vectors), vectors.where("vec_id % 20 = 0"))), brute(rows, queries, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = {(q, i): s for q in want for s, i in brute(rows, {q}, len(rows))[q]}
    assert all(s == pytest.approx(exact[q, i], abs=1e-12) for q in got for s, i in got[q])


def test_small_tables_are_searched_whole_and_odd_rows_take_no_part(table_of):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(1, 15)]
    rows += [(20, None), (21, []), (22, [0.0] * 4), (23, [1.0, None, 0.0, 0.0]), (24, [float("nan"), 0.0, 0.0, 1.0]), (25, [float("inf"), 0.0, 0.0, 1.0]),
             (26, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0]), (27, rows[0][1]), (28, rows[0][1])]
    table = table_of(rows)
    got = found(search(build(table), table, k=20))
    want = {q: v for q, v in brute(rows, {i for i, _ in rows}, 20).items() if q != 26}
    assert got == {q: [(s, i) for s, i in v if i != 26] for q, v in want.items()}


def test_one_very_common_vector(table_of):
    rng = np.random.default_rng(3)
    common = [1.0, 0.5, 0.25, 0.0]
    rows = [(i, common if i % 3 else [float(x) for x in rng.standard_normal(4)]) for i in range(900)]
    table = table_of(rows)
    got = found(search(build(table), table.where("vec_id in (1, 3, 500)"), k=10))
    want = brute(rows, {1, 3, 500}, 10)
    for q in (1, 500):
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
    assert len({i for _, i in got[3]} & {i for _, i in want[3]}) >= 9


def test_empty_table_and_strange_queries(table_of):
    none = table_of([])
    assert search(build(none), none).collect() == []
    table = table_of([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])])
    other = table_of([(100, [2.0, 1.0]), (101, [1.0]), (102, None)])
    assert found(search(build(table), other, k=2)) == {100: [(3.0, 3), (2.0, 1)]}


def test_one_very_long_vector_among_ordinary_ones(table_of):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    rows = [(i, [float(np.float32(x)) for x in (centres[i % 20] + 0.4 * rng.standard_normal(16)) * (1e4 if i == 777 else 1)]) for i in range(1500)]
    table = table_of(rows)
    got, want = found(search(build(table), table.where("vec_id % 20 = 0"))), brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_lengths_of_very_different_order(table_of):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8) * 10.0 ** (i % 60 - 25)]) for i in range(600)]
    table = table_of(rows)
    got, want = found(search(build(table), table.where("vec_id % 30 = 7"))), brute(rows, {i for i, _ in rows if i % 30 == 7}, 20)
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.95 * 20 * len(want)
