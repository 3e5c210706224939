import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.operators import monitor as mo
from rillmark.operators import profiles as pr
from rillmark.operators import quality as dq
from rillmark.operators import windows as wn
from rillmark.schemas import EVENT
from tests.conftest import rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 1.0), (1, None, 2.0), (2, "b", None)], "k int, s string, v double")


def test_report_names_the_first_failure(df):
    got = {r.check_name: (r.failures, r.passed, r.first_failure) for r in dq.dq_report(df, ["k", "s"], 5, ["k"]).collect()}
    assert got == {"nulls:k": (0, True, False), "nulls:s": (1, False, True), "row_count": (2, False, False),
                   "duplicates": (1, False, False)}


def test_report_of_clean_data(df):
    out = dq.dq_report(df, ["k"], 3)
    assert out.where("NOT passed OR first_failure").count() == 0


def test_profile(df):
    got = {r.column_name: (r.missing, r.distinct_values, r.constant) for r in dq.column_profile(df).collect()}
    assert got == {"k": (0, 2, False), "s": (1, 2, False), "v": (1, 2, False)}


def test_schema_differences(df):
    assert "missing event_id" in dq.schema_differences(df, EVENT)


def test_no_drift_against_itself(spark):
    x = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("c"))
    got = {r.column_name: r for r in dq.drift(x, x, ["x", "c"]).collect()}
    assert got["x"].psi == pytest.approx(0) and got["x"].ks == pytest.approx(0) and got["c"].psi == pytest.approx(0)
    shifted = x.withColumn("x", F.col("x") + 500)
    moved = {r.column_name: r for r in dq.drift(x, shifted, ["x"]).collect()}["x"]
    assert moved.drifted and moved.ks == pytest.approx(0.5, abs=0.01)
    assert dq.dataset_drift(dq.drift(x, shifted, ["x", "c"])).first().drift_share == 0.5


def test_drift_reports_every_column(spark):
    rows_ = [(None, float(i), 1.0 if i % 2 else None) for i in range(100)]
    ref = spark.createDataFrame(rows_, "a double, b double, n double")
    cur = spark.createDataFrame([(float(i), None, 1.0) for i in range(50)], "a double, b double, n double")
    got = {r.column_name: r for r in dq.drift(ref, cur, ["a", "b", "n"]).collect()}
    assert all(got[c].drifted for c in "abn") and got["a"].ks is None and got["b"].ks is None and got["n"].ks == 0
    assert [(got[c].ref_null_share, got[c].cur_null_share) for c in "abn"] == [(1, 0), (0, 1), (0.5, 0)]
    assert dq.dataset_drift(dq.drift(ref, cur, ["a", "b", "n"])).first().columns == 3


def test_drift_against_an_empty_side(spark):
    x, none = spark.range(9).select(F.col("id").cast("double").alias("x")), spark.range(0).select(F.col("id").cast("double").alias("x"))
    for a, b in ((x, none), (none, x)):
        r = dq.drift(a, b, ["x"]).first()
        assert (r.psi, r.ks, r.drifted) == (None, None, True)
        t = dq.target_drift(a, b, "x").first()
        assert (t.psi, t.drifted) == (None, True)
    assert [tuple(r) for r in dq.drift(none, none, ["x"]).collect()] == [("x", None, None, None, None, False)]
    assert not dq.target_drift(none, none, "x").first().drifted


def test_ks_is_exact_between_the_edges(spark):
    """All movement happens inside one decile of the reference."""
    ref = [float(i) for i in range(1000)]
    cur = [x if not 500 < x < 599 else 501.0 for x in ref]
    a, b = (spark.createDataFrame([(v,) for v in x], "x double") for x in (ref, cur))
    want = max(abs(sum(r <= v for r in ref) - sum(c <= v for c in cur)) / 1000 for v in ref)
    assert want > 0.09 and dq.drift(a, b, ["x"]).first().ks == pytest.approx(want)


def test_target_drift_without_label(spark):
    x = spark.range(3).toDF("x")
    assert dq.target_drift(x, x).first().drifted is False


def test_counter_reset(spark):
    s = spark.createDataFrame([("c", 0, 5), ("c", 60, 9), ("c", 120, 2), ("c", 400, 8)], "series string, s long, value long")
    out = mo.counter_rate(s.withColumn("timestamp", F.timestamp_seconds("s")), 300)
    assert [r.rate for r in out.orderBy("window_start").collect()] == [pytest.approx(6 / 300), pytest.approx(6 / 300)]


def test_histogram_quantile(spark):
    v = spark.createDataFrame([("a", float(x)) for x in range(1, 11)], "k string, v double")
    hist = mo.histogram(v, "k", "v", [5.0, 20.0])
    assert mo.histogram_quantile(hist, 0.5, "k").first().quantile == pytest.approx(5.0)
    assert mo.histogram_quantile(hist, 0.75, "k").first().quantile == pytest.approx(5 + 15 * 2.5 / 5)
    open_end = mo.histogram(v, "k", "v", [5.0, 7.0])
    assert mo.histogram_quantile(open_end, 0.95, "k").first().quantile == 7.0
    assert rows(hist, "le", "cumulative") == [(20.0, 10), (5.0, 5), (math.inf, 10)]


def test_alert_needs_adjacent_windows(spark):
    r = spark.createDataFrame([("s", h * 3600, x) for h, x in enumerate([1, 1, 0, 1, 1, 1])], "svc string, s long, bad int")
    out = wn.alert_runs(r.withColumn("at", F.timestamp_seconds("s")), "svc", "at", F.col("bad") == 1, 3600, 3)
    assert [(x.windows, x.started.timestamp()) for x in out.collect()] == [(3, 3 * 3600)]


@pytest.mark.parametrize("stats,reason", [
    ((10_000, 0.9, 99.0), "events"), ((9_999, 0.3, 99.0), "drift"), ((0, 0.29, 48.0), "hours"),
    ((0, 0.0, 47.9), "Conditions not met")])
def test_retrain_reasons(spark, stats, reason):
    got = mo.retrain_decision(spark.createDataFrame([stats], "new_events long, drift_score double, hours_since double")).first()
    assert got.reason == reason and got.retrain == (reason != "Conditions not met")


def test_partial_updates_and_preferences(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, n string, m string")
    upd = spark.createDataFrame([(1, None, "z", 2), (1, "q", None, 1), (1, "r", None, 3), (3, "new", None, 1)],
                                "id int, n string, m string, v int")
    assert rows(pr.upsert(base, upd, "id", ["v"])) == [(1, "r", "z"), (2, "b", "y"), (3, "new", None)]
    prefs = spark.createDataFrame([("u", {"a": "1", "b": "2"}, 1), ("u", {"a": "3"}, 2)],
                                  "user_id string, preferences map<string,string>, timestamp int")
    assert pr.preference_maps(pr.merge_preferences(prefs)).first().preferences == {"a": "3", "b": "2"}


def test_drift_places_values_by_range_partitions(spark, monkeypatch):
    r = np.random.default_rng(5)
    x, y = np.round(r.standard_normal(900), 2), np.round(r.standard_normal(700) + 0.3, 2)
    a, b = (spark.createDataFrame([(float(v),) for v in w], "x double") for w in (x, y))
    whole = dq.drift(a, b, ["x"]).first()
    monkeypatch.setattr(dq.scale, "ROWS", 40)
    # no list of cuts that grows with the table and is met by every value
    monkeypatch.setattr(dq.F, "percentile_approx", None)
    got = dq.drift(a, b, ["x"]).first()
    want = max(abs((x <= v).mean() - (y <= v).mean()) for v in [*x, *y])
    assert got.ks == pytest.approx(want) and got.psi == pytest.approx(whole.psi) and got.drifted == whole.drifted
