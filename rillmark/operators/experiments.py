"""Experiments: assignment, routing, attribution, group metrics and significance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import erfc, is_type, micros, safe_ratio, sha_int, time_bucket
from rillmark.operators.scale import salted_join

# Number of traffic buckets and the version served when no experiment applies.
BUCKETS = 100
DEFAULT_GROUP, DEFAULT_VERSION = "control", "production"
UNKNOWN_EXPERIMENT = "experiment not found"


def bucket(user_id="user_id", experiment_id="experiment_id") -> Column:
    """Traffic bucket 0..99 of a user in an experiment."""
    return sha_int(user_id, experiment_id) % BUCKETS


def group_of(bucket_col: Column, traffic: Column) -> Column:
    """excluded / control / treatment; half of the traffic, halved as a real number, is control."""
    return (
        F.when(bucket_col >= traffic, "excluded")
        .when(bucket_col < traffic / F.lit(2.0), "control").otherwise("treatment")
    )


def active_experiment(experiments: DataFrame) -> DataFrame:
    """The newest active experiment: one row, or none if nothing is active."""
    newest = F.max_by(F.struct(*experiments.columns), F.struct("created_at", "experiment_id"))
    return experiments.where(F.col("status") == "active").groupBy().agg(newest.alias("e")).where(
        F.col("e").isNotNull()).select("e.*")


def assign(requests: DataFrame, experiments: DataFrame) -> DataFrame:
    """Group of every request's user. A request without an experiment goes to the newest active one.

    ``requests``: user_id, experiment_id (may be null) and any other columns. A request that names an unknown experiment
    comes out with status "unknown", a reason and no group; without any active experiment the default group and version
    apply. How the experiments are joined is left to the optimiser, which knows their size.
    """
    newest = active_experiment(experiments).select("experiment_id").scalar()
    wanted = requests.withColumn("experiment_id", F.coalesce("experiment_id", newest))
    dim = experiments.select("experiment_id", "status", "traffic_percentage", "control_version", "treatment_version")
    placed = wanted.join(dim.withColumn("_known", F.lit(True)), "experiment_id", "left")
    known, unnamed = F.col("_known").isNotNull(), F.col("experiment_id").isNull()
    placed = placed.withColumn("bucket", F.when(known, bucket())).withColumns({
        "group": F.when(known, group_of(F.col("bucket"), F.col("traffic_percentage"))).when(unnamed, DEFAULT_GROUP),
        "status": F.when(unnamed, "none").when(known, F.col("status")).otherwise("unknown"),
        "reason": F.when(~known & ~unnamed, UNKNOWN_EXPERIMENT)})
    return placed.drop("_known")


def route_versions(assigned: DataFrame) -> DataFrame:
    """Served group and model version per request, and whether the assignment is recorded.

    Inactive experiments and excluded users are served the control version; only active, included ones are recorded.
    A request for an unknown experiment is an error: it is served nothing and keeps its reason.
    """
    active, unknown = F.col("status") == "active", F.col("status") == "unknown"
    treated = active & (F.col("group") == "treatment")
    return assigned.withColumn("served_group", F.when(treated, "treatment").when(~unknown, "control")).withColumn(
        "model_version",
        F.when(treated, F.col("treatment_version")).when(
            ~unknown, F.coalesce("control_version", F.lit(DEFAULT_VERSION))),
    ).withColumn("recorded", active & (F.col("group") != "excluded"))


def sticky(new: DataFrame, existing: DataFrame) -> DataFrame:
    """First assignment per user and experiment; an existing one always wins."""
    cols = ["user_id", "experiment_id", "group", "assigned_at"]
    both = existing.select(*cols, F.lit(0).alias("_new")).unionByName(new.select(*cols, F.lit(1).alias("_new")))
    first = F.min(F.struct("_new", "assigned_at", "group"))
    return both.groupBy("user_id", "experiment_id").agg(first.alias("f")).select(
        "user_id", "experiment_id", F.col("f.group").alias("group"), F.col("f.assigned_at").alias("assigned_at"))


def group_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("experiment_id", "group").agg(F.count("*").alias("sample_size"))


def metrics(assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Metric sum / recorded assignments per group, rounded to 4; groups of size 0 have no metric.

    ``events``: experiment_id, group, metric_name, metric_value.
    """
    sums = events.where(F.col("group").isin("control", "treatment")).groupBy(
        "experiment_id", "group", "metric_name").agg(F.sum("metric_value").alias("_sum"))
    joined = sums.join(group_sizes(assignments), ["experiment_id", "group"], "left")
    return joined.where(F.col("sample_size") > 0).select(
        "experiment_id", "group", "metric_name", "sample_size",
        F.round(F.col("_sum") / F.col("sample_size"), 4).alias("metric_mean"))


def attribute(events: DataFrame, assignments: DataFrame) -> DataFrame:
    """Events at or after their user's assignment, with experiment and group.

    The rows of very active users are spread by salt; a user's few assignments are repeated for those only.
    """
    a = assignments.select("user_id", "experiment_id", "group", "assigned_at")
    return salted_join(events, a, "user_id").where(F.col("timestamp") >= F.col("assigned_at"))


def group_ctr(attributed: DataFrame, *extra: Column | str) -> DataFrame:
    """Views, clicks and click-through rate per experiment and group (and per ``extra`` column)."""
    out = attributed.groupBy("experiment_id", "group", *extra).agg(
        F.count("*").alias("events"), F.count_if(is_type("view")).alias("views"),
        F.count_if(is_type("click")).alias("clicks"))
    return out.withColumn("ctr", safe_ratio("clicks", "views"))


def user_conversions(assignments: DataFrame, attributed: DataFrame) -> DataFrame:
    """Assigned users and users with at least one click, per experiment and group."""
    clicked = attributed.where(is_type("click")).select("user_id", "experiment_id").distinct().withColumn(
        "clicked", F.lit(1))
    joined = assignments.join(clicked, ["user_id", "experiment_id"], "left")
    return joined.groupBy("experiment_id", "group").agg(
        F.count("*").alias("n"), F.count("clicked").alias("success"))


def chi2(counts: DataFrame) -> DataFrame:
    """2x2 chi-squared test of control against treatment per experiment.

    ``counts``: experiment_id, group, n, success. A table without variation gives statistic 0 and p 1.
    """
    def of(group: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("group") == group, value)), F.lit(0)).cast("double")

    wide = counts.groupBy("experiment_id").agg(
        of("control", F.col("success")).alias("a"), of("control", F.col("n") - F.col("success")).alias("b"),
        of("treatment", F.col("success")).alias("c"), of("treatment", F.col("n") - F.col("success")).alias("d"))
    a, b, c, d = (F.col(x) for x in "abcd")
    below = (a + b) * (c + d) * (a + c) * (b + d)
    det = a * d - b * c
    stat = F.when(below > 0, (a + b + c + d) * det * det / below).otherwise(F.lit(0.0))
    p = F.when(F.col("chi2") > 0, erfc(F.sqrt(F.col("chi2") / 2))).otherwise(F.lit(1.0))
    return wide.withColumn("chi2", stat).withColumn("p_value", p).select(
        "experiment_id", "chi2", "p_value", (F.lit(1.0) - F.col("p_value")).alias("confidence"),
        (F.col("p_value") < 0.05).alias("significant"))


def served_clicks(served: DataFrame, clicks: DataFrame, hours: int = 24) -> DataFrame:
    """For every served item, the first click by that user on it within ``hours``, if any.

    An as-of join without pairing: in (user, item, time bucket) order each served row takes the next click in its bucket,
    else the first click of the following bucket. Buckets are as wide as the window, so no later one can hold a
    match, and a hot pair is split over its buckets.
    """
    seconds = hours * 3600
    keys = ["user_id", "item_id"]
    first = clicks.groupBy(*keys, time_bucket("timestamp", seconds).alias("_b")).agg(F.min("timestamp").alias("_next"))
    shown = served.withColumn("_c", F.lit(None).cast("timestamp")).withColumn("_served", F.lit(True))
    hit = clicks.select(*keys, "timestamp").distinct().withColumn("_c", F.col("timestamp")).withColumn(
        "_served", F.lit(False))
    rows = shown.unionByName(hit, allowMissingColumns=True).withColumn("_b", time_bucket("timestamp", seconds))
    ahead = Window.partitionBy(*keys, "_b").orderBy(F.desc("timestamp")).rangeBetween(Window.unboundedPreceding, 0)
    in_bucket = rows.withColumn("_same", F.min("_c").over(ahead)).where("_served")
    later = first.withColumn("_b", F.col("_b") - 1)
    found = in_bucket.join(later, [*keys, "_b"], "left").withColumn("_at", F.coalesce("_same", "_next"))
    within = micros("_at") - micros("timestamp") <= F.lit(seconds * 1_000_000)
    return found.withColumn("clicked_at", F.when(within, F.col("_at"))).withColumn(
        "clicked", F.col("clicked_at").isNotNull()).select(*served.columns, "clicked_at", "clicked")
