"""Ranking operators against small hand-made lists."""

import itertools
import math
import random

import pytest

from rillmark.operators import evaluate as el
from rillmark.operators import experiments as ex
from rillmark.operators import rerank as rr
from tests.conftest import rows

ITEM = "user_id string, item_id string, score double, categories array<string>"


def overlap(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a and b else 0.0


@pytest.fixture(scope="module")
def lists(spark):
    rnd = random.Random(11)
    data = []
    for u in range(6):
        for i in range(30 if u else 400):  # one user has a very long list
            cats = rnd.sample("abcdefg", rnd.randrange(0, 4))
            data.append((f"u{u}", f"i{i:03d}", float(rnd.randrange(1, 1000)) / 8, cats))
    return data, spark.createDataFrame(data, ITEM)


@pytest.mark.parametrize("k,lam", [(10, 0.7), (3, 0.0), (500, 1.0)])
def test_mmr_picks_greedily(lists, k, lam):
    data, df = lists
    if k == 500:
        df, data = df.where("user_id <> 'u0'"), [d for d in data if d[0] != "u0"]
    got = {}
    for u, i, s, r in sorted((tuple(x) for x in rr.mmr(df, k, lam).collect()), key=lambda x: (x[0], x[3])):
        got.setdefault(u, []).append((i, s))
    for u in {d[0] for d in data}:
        pool = sorted([d for d in data if d[0] == u], key=lambda d: (-d[2], d[1]))
        top, chosen = pool[0][2], []
        while pool and len(chosen) < k:
            gains = [lam * (d[2] / top) - (1.0 - lam) * max([overlap(d[3], c[3]) for c in chosen], default=0.0) for d in pool]
            chosen.append(pool.pop(gains.index(max(gains))))
        assert got[u] == [(d[1], d[2]) for d in chosen]


def test_diversity_without_pairs_equals_all_pairs(lists):
    data, df = lists
    got = {r.user_id: r.diversity for r in el.list_diversity(df).collect()}
    for u in {d[0] for d in data}:
        mine = [d[3] for d in data if d[0] == u]
        pairs = [1 - overlap(a, b) for a, b in itertools.combinations(mine, 2)]
        assert got[u] == pytest.approx(sum(pairs) / len(pairs))


def test_diversity_of_short_lists(spark):
    df = spark.createDataFrame([("a", "x", 1.0, ["p"]), ("b", "x", 1.0, []), ("b", "y", 1.0, None)], ITEM)
    assert {r.user_id: r.diversity for r in el.list_diversity(df).collect()} == {"a": 1.0, "b": 1.0}


def test_diversity_of_items_with_many_categories(spark):
    rnd = random.Random(2)
    data = [("wide" if i < 20 else "narrow", f"i{i}", 1.0, rnd.sample("abcdefghijklmnopqrst", rnd.randrange(0, 15 if i < 20 else 5)))
            for i in range(40)]
    got = {r.user_id: r.diversity for r in el.list_diversity(spark.createDataFrame(data, ITEM)).collect()}
    for u in ("wide", "narrow"):
        pairs = [1 - overlap(a[3], b[3]) for a, b in itertools.combinations([d for d in data if d[0] == u], 2)]
        assert got[u] == pytest.approx(sum(pairs) / len(pairs))


def test_dampening_bounds_are_exclusive(spark):
    df = spark.createDataFrame(
        [("u", "a", 1.0, 0.90), ("u", "b", 1.0, 0.91), ("u", "c", 1.0, 0.30), ("u", "d", 1.0, 0.29), ("u", "e", 1.0, None)],
        "user_id string, item_id string, score double, popularity_percentile double")
    assert rows(rr.dampen(df), "item_id", "score") == [("a", 1.0), ("b", 0.8), ("c", 1.0), ("d", 1.2), ("e", 1.0)]


def test_prefix_rule(spark):
    df = spark.createDataFrame(
        [("u", "x_1", 1.0), ("u", "x_2", 0.9), ("u", "y_1", 0.8), ("u", "z_9", 0.1)], "user_id string, item_id string, score double")
    got = [(r.item_id, r.score) for r in rr.prefix_rerank(df, 3).orderBy("rank").collect()]
    assert got == [("x_1", 1.0), ("y_1", 0.8), ("x_2", 0.72)]


def test_metrics_of_one_list(spark):
    preds = spark.createDataFrame([("u", x, i + 1) for i, x in enumerate("abcd")] + [("v", "a", 1)],
                                  "user_id string, item_id string, rank int")
    acts = spark.createDataFrame([("u", "a"), ("u", "c"), ("u", "q"), ("w", "a")], "user_id string, item_id string")
    got = {r.user_id: r for r in el.evaluate(preds, acts, 3).collect()}
    ideal = sum(1 / math.log2(r + 1) for r in (1, 2, 3))
    assert got["u"].ndcg == pytest.approx((1 + 1 / math.log2(4)) / ideal)
    assert got["u"].precision == pytest.approx(2 / 3) and got["u"].recall == pytest.approx(2 / 3)
    assert (got["v"].ndcg, got["v"].precision, got["v"].recall) == (0, 0, 0)
    assert (got["w"].ndcg, got["w"].precision, got["w"].recall) == (0, 0, 0)
    ap = {r.user_id: r.average_precision for r in el.average_precision(preds, acts, 2).collect()}
    assert ap == {"u": pytest.approx((1 + 2 / 3) / 3), "w": 0.0}
    assert el.mean_ap(preds, acts).first().map_score == pytest.approx((1 + 2 / 3) / 6)
    assert el.coverage(preds, acts).first().coverage == pytest.approx(2 / 3)


def test_auc_with_ties(spark):
    data = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)]
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 6
    assert el.auc(spark.createDataFrame(data, "score double, label int")).first().auc == pytest.approx(want)


def test_cold_start_scores(spark):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    recs = spark.createDataFrame([("a", "x")], "user_id string, item_id string")
    pop = spark.createDataFrame([("x", 5), ("y", 9), ("z", 5)], "item_id string, popularity long")
    assert rows(rr.cold_start(users, recs, pop, 2), "user_id", "item_id", "score") == [("b", "x", 0.99), ("b", "y", 1.0)]


def test_odd_traffic_is_halved_as_a_real_number(spark):
    from pyspark.sql import functions as F
    df = spark.range(6).select(F.col("id"), ex.group_of(F.col("id"), F.lit(5)).alias("g"))
    assert [r.g for r in df.orderBy("id").collect()] == ["control"] * 3 + ["treatment"] * 2 + ["excluded"]


def test_no_active_experiment_gives_the_default(spark):
    exps = spark.createDataFrame([("e", "paused", 50, "c", "t", 1)], "experiment_id string, status string, traffic_percentage int, control_version string, treatment_version string, created_at int")
    req = spark.createDataFrame([("u", None), ("u", "e"), ("u", "gone")], "user_id string, experiment_id string")
    out = ex.route_versions(ex.assign(req, exps))
    assert rows(out, "experiment_id", "served_group", "model_version", "recorded") == [
        ("e", "control", "c", False), ("gone", None, None, False), (None, "control", "production", False)]
    assert {r.experiment_id: r.reason for r in out.collect()}["gone"] == "experiment not found"


def test_sticky_keeps_the_existing_group(spark):
    cols = "user_id string, experiment_id string, group string, assigned_at int"
    new = spark.createDataFrame([("u", "e", "treatment", 1), ("v", "e", "control", 9), ("v", "e", "treatment", 8)], cols)
    old = spark.createDataFrame([("u", "e", "control", 5)], cols)
    assert rows(ex.sticky(new, old)) == [("u", "e", "control", 5), ("v", "e", "treatment", 8)]


def test_served_clicks_at_the_window_edges(spark):
    from pyspark.sql import functions as F
    def at(df):
        return df.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    served = at(spark.createDataFrame([("s1", "u", "i", 0), ("s2", "u", "i", 3599), ("s3", "u", "i", 7300)],
                                      "event_id string, user_id string, item_id string, timestamp long"))
    clicks = at(spark.createDataFrame([("u", "i", 3600), ("u", "i", 7200)], "user_id string, item_id string, timestamp long"))
    got = {r.event_id: r.clicked_at for r in ex.served_clicks(served, clicks, 1).collect()}
    assert got["s1"].timestamp() == 3600 and got["s2"].timestamp() == 3600 and got["s3"] is None


@pytest.mark.parametrize("batch", [10_000, 3])
def test_mmr_runs_over_batches_of_whole_users(spark, batch):
    df = spark.createDataFrame([
        ("a", "x", 2.0, ["p"]), ("a", "x", 2.0, ["q"]), ("a", "y", 2.0, ["p"]), ("a", "z", None, ["r"]), ("a", "w", 1.0, None),
        ("b", "x", None, ["p"]), ("b", "y", None, ["q"]),
        (None, "x", 3.0, ["p", None]), (None, "y", 2.0, [None, "p", "p"]), (None, None, 1.0, []), (None, "z", 0.5, ["q"]),
        ("c", "x", float("nan"), ["p"]), ("c", "y", 5.0, ["q"]), ("d", "x", -1.0, ["p"]), ("d", "y", -2.0, []),
        ("e", None, 9.0, ["p"]), ("e", "x", 8.0, ["q"])], ITEM)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        chosen = rr.mmr(df, 10)
        got = [(r.user_id, r["rank"], r.item_id, str(r.score)) for r in chosen.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # an item leaves with its id, scores that are missing end the list with an empty pick, a null id counts only as the first
    assert sorted(got, key=repr) == sorted([
        ("a", 1, "x", "2.0"), ("a", 2, "y", "2.0"), ("a", 3, "w", "1.0"), ("a", 4, None, "None"), ("b", 1, None, "None"),
        (None, 1, "x", "3.0"), (None, 2, "y", "2.0"), (None, 3, "z", "0.5"), ("e", 1, None, "9.0"),
        ("c", 1, "y", "5.0"), ("c", 2, "x", "nan"), ("d", 1, "x", "-1.0"), ("d", 2, "y", "-2.0")], key=repr)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "aggregate(" not in plan  # no list per user, no row-by-row choice
