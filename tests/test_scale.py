"""The bucketed building blocks against plain Python, with one key that holds a third of the rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillmark.operators import scale as sc
from rillmark.operators import windows as wn
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"
        data.append((i, key, rnd.randrange(5000), rnd.randrange(1, 9)))
    return data, spark.createDataFrame(data, "id int, key string, t int, v int").cache()


def test_running_total(skewed):
    data, df = skewed
    got = {r.id: r.s for r in sc.running_total(
        df.withColumn("b", F.floor(F.col("t") / 100)), ["key"], "b", ["t", "id"], F.col("v"), "s").collect()}
    groups = defaultdict(list)
    for i, key, t, v in data:
        groups[key].append((t, i, v))
    want = {}
    for g in groups.values():
        total = 0
        for t, i, v in sorted(g):
            total += v
            want[i] = total
    assert got == want


def test_running_total_with_peers(skewed):
    data, df = skewed
    got = {r.id: r.s for r in sc.running_total(
        df.withColumn("b", F.floor(F.col("t") / 100)), ["key"], "b", ["t"], F.col("v"), "s", peers=True).collect()}
    for i, key, t, _ in random.Random(1).sample(data, 200):
        assert got[i] == sum(v for _, k, u, v in data if k == key and u <= t)


def test_previous_value(skewed):
    data, df = skewed
    got = {r.id: r.p for r in sc.previous_value(
        df.withColumn("b", F.floor(F.col("t") / 50)), ["key"], "b", ["t", "id"], F.col("v"), "p").collect()}
    groups = defaultdict(list)
    for i, key, t, v in data:
        groups[key].append((t, i, v))
    for g in groups.values():
        last = None
        for t, i, v in sorted(g):
            assert got[i] == last
            last = v


def test_dense_index_numbers_every_value_once(skewed):
    data, df = skewed
    got = rows(sc.dense_index(df, "key", "n"))
    assert sorted(n for _, n in got) == list(range(41))
    assert {k for k, _ in got} == {d[1] for d in data}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=60), q=st.sampled_from([0.0, 0.1, 0.5, 0.95, 1.0]))
def test_exact_percentile(spark, values, q):
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    want = float(np.percentile(values, q * 100))
    assert sc.exact_percentiles(df, ["k"], "v", {"p": q}, 8).first().p == pytest.approx(want)
    assert sc.exact_percentiles(df, [], "v", {"p": q}, 8).first().p == pytest.approx(want)


def test_percentiles_of_crowded_and_extreme_values(spark):
    rnd = random.Random(5)
    # a third of all values in a millionth of the range, some far out, and groups with null keys
    values = [1.0 + rnd.random() * 1e-6 for _ in range(700)] + [rnd.uniform(-1e6, 1e6) for _ in range(1300)] + [
        1e308, -1e308, float("inf"), float("-inf"), 5e-324, 0.0, -0.0] + [7.0] * 500
    df = spark.createDataFrame([(None if k % 2 else "a", v) for k, v in enumerate(values)], "k string, v double")
    probs = {f"p{int(q * 1000)}": q for q in (0.0, 0.001, 0.3, 0.5, 0.55, 0.9, 0.999, 1.0)}
    got = {r.k: r for r in sc.exact_percentiles(df, ["k"], "v", probs, 10).collect()}
    assert set(got) == {"a", None}
    for key, parity in (("a", 0), (None, 1)):
        own = sorted(v for k, v in enumerate(values) if k % 2 == parity)
        assert got[key].n == len(own)
        for name, q in probs.items():
            at = q * (len(own) - 1)
            lo, hi = own[int(np.floor(at))], own[int(np.ceil(at))]
            assert got[key][name] == (lo if lo == hi else pytest.approx(lo + (hi - lo) * (at - np.floor(at))))


def test_narrowing_leaves_no_large_slice(spark):
    crowded = spark.range(30_000).select(F.struct(F.lit(0)).alias("_k"), F.lit(1).cast("bigint").alias("_c"), (
        F.when(F.col("id") % 3 == 0, F.lit(5.0) + F.col("id") * 1e-12).otherwise(F.col("id") * 1e3)).alias("_v"))
    n = 30_000
    places = crowded.groupBy("_k").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("d")).select(
        "_k", F.lit(n).cast("bigint").alias("n"), "lo", "hi", "d", F.lit(0).cast("bigint").alias("base"),
        F.explode(F.array(*[F.lit(x).cast("bigint") for x in (0, 100, 5000, 9999, 10_000, 20_000, n - 1)])).alias("pos"))
    got = sc.narrowed(crowded, places, 50).collect()
    assert len(got) == 7 and max(r.d for r in got) <= 50
    assert all(r.base <= r.pos < r.base + r.d for r in got)


def test_pieces_follow_the_number_of_rows(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    sizes = [r["count"] for r in sc.value_pieces(df, "v", "b", 200).groupBy("b").count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 500
    assert sc.value_pieces(df, "v", "b").agg(F.max("b")).first()[0] == 0  # few rows are one piece


def test_hot_keys_are_salted_by_their_rows(spark, skewed):
    _, df = skewed
    small = spark.createDataFrame([("hot", 1), ("k1", 3)], "key string, w int")
    for n in (1, 7, 1000):
        assert rows(sc.salted_join(df, small, "key", "inner", n), "id", "w") == rows(df.join(small, "key"), "id", "w")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    _, df = skewed
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "key string, w int")
    assert rows(sc.salted_join(df, small, "key", how), "id", "w") == rows(df.join(small, "key", how), "id", "w")


def test_hot_keys_are_few(skewed):
    _, df = skewed
    assert rows(sc.hot_keys(df, "key", 0.2)) == [("hot",)]


@pytest.mark.parametrize("n", [1, 777, 2999, 3000, 9999])
def test_smallest_by_hash_is_exact(spark, n):
    df = spark.range(3000).select("id", (F.crc32(F.col("id").cast("string").cast("binary")) % 500 * 8_000_000).alias("h"))
    got = [r.id for r in sc.smallest_by_hash(df, "h", F.lit(n), ["id"]).collect()]
    want = sorted(((r.h, r.id) for r in df.collect()))[:n]
    assert sorted(got) == sorted(i for _, i in want)


def test_rolling_counts_of_a_hot_user(spark):
    rnd = random.Random(3)
    data = [(str(i), "hot" if i % 3 == 0 else f"u{rnd.randrange(5)}", f"i{rnd.randrange(4)}", rnd.randrange(0, 20_000))
            for i in range(900)]
    df = spark.createDataFrame(data, "event_id string, user_id string, item_id string, s long").withColumn(
        "timestamp", F.timestamp_seconds("s"))
    out = wn.rolling_counts(df, {"user_id": {"u1h": 3600, "u2h": 7200}, "item_id": {"i1h": 3600}}, bucket_seconds=60)
    got = {r.event_id: r for r in out.collect()}
    assert len(got) == 900
    for e, u, i, s in data:
        assert got[e].user_id == u and got[e].item_id == i
        assert got[e].u1h == sum(1 for d in data if d[1] == u and s - 3600 <= d[3] <= s)
        assert got[e].u2h == sum(1 for d in data if d[1] == u and s - 7200 <= d[3] <= s)
        assert got[e].i1h == sum(1 for d in data if d[2] == i and s - 3600 <= d[3] <= s)


def test_rate_limit_of_a_flood(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("event_id"), F.lit("c").alias("client"),
        F.timestamp_micros(F.lit(60_000_000) + F.col("id") * 100_000).alias("timestamp"))
    out = wn.rate_limited(df, "client", 100, 60)
    assert out.where("rejected").count() == 400
    assert out.agg(F.max("request_no")).first()[0] == 500


def test_latest_row_survives_ties(spark):
    df = spark.createDataFrame([("u", "i", "a", 5), ("u", "i", "b", 5), ("u", "i", "c", 4)],
                               "user_id string, item_id string, event_id string, timestamp int")
    assert rows(wn.latest_per_key(df, ["user_id", "item_id"]), "event_id") == [("b",)]
