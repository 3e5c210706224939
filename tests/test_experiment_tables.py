"""Experiment tables: schemas, checks and readers."""

from datetime import datetime

from rillmark.schemas import ASSIGNMENT, EXPERIMENT
from rillmark.session import scratch_dir
from rillmark.sources import experiments as xt
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def test_rows_that_break_a_rule_stay_out_with_a_reason(spark):
    data = [("e1", "a", "active", 50, "v1", "v2", T0), ("e2", "a", "active", 50, "v1", "v2", datetime(2024, 1, 2)),
            ("e3", None, "active", 50, "v1", "v2", T0), ("e4", "d", "running", 50, "v1", "v2", T0),
            ("e5", "e", "paused", 101, "v1", "v2", T0), ("e6", "f", "completed", 0, None, "v2", T0), ("e7", "g", None, None, "v1", "v2", T0)]
    df = spark.createDataFrame(data, "experiment_id string, name string, status string, traffic_percentage long, control_version string, "
                                     "treatment_version string, created_at timestamp").withColumnRenamed("x", "y")
    got = {r.experiment_id: r.reasons for r in xt.checked(df, "experiments").collect()}
    assert got == {"e1": [], "e2": ["name_taken"], "e3": ["name_missing"], "e4": ["status_unknown"], "e5": ["traffic_out_of_range"],
                   "e6": ["control_version_missing"], "e7": ["status_unknown", "traffic_out_of_range"]}
    root = scratch_dir(spark, "experiments")
    xt.write_table(df, root, "experiments")
    table = xt.read_table(spark, root, "experiments")
    assert table.schema == EXPERIMENT and [r.experiment_id for r in table.collect()] == ["e1"]


def test_one_assignment_per_user_and_experiment(spark):
    root = scratch_dir(spark, "experiments")
    df = spark.createDataFrame([("u", "e", "control", datetime(2024, 1, 2)), ("u", "e", "treatment", T0), ("v", "e", "other", T0),
                                ("w", None, "control", T0)], ASSIGNMENT)
    xt.write_table(df, root, "assignments")
    assert rows(xt.read_table(spark, root, "assignments")) == [("u", "e", "treatment", T0)]


def test_metrics_by_day(spark):
    root = scratch_dir(spark, "experiments")

    def metric(day, value):
        return spark.createDataFrame([("e", "control", "ctr", value, datetime(2024, 1, day))],
                                     "experiment_id string, group string, metric_name string, metric_value double, timestamp timestamp")
    for day in (1, 2, 3):
        xt.write_table(metric(day, float(day)), root, "metrics")
    xt.write_table(metric(2, 20.0), root, "metrics")  # a day that comes again replaces itself
    assert sorted(r.metric_value for r in xt.read_table(spark, root, "metrics").collect()) == [1.0, 3.0, 20.0]
    late = xt.read_table(spark, root, "metrics", "2024-01-02")
    assert sorted(r.metric_value for r in late.collect()) == [3.0, 20.0]
    assert "PartitionFilters: [isnotnull(date" in late._jdf.queryExecution().toString()
    assert xt.read_table(spark, root, "metrics").columns == ["experiment_id", "group", "metric_name", "metric_value", "timestamp"]
