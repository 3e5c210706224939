"""Reports that merge: the same as one pass, within the sketch's error, and compacted on the stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import sketches as sk
from rillmark.schemas import EVENT
from rillmark.session import scratch_dir
from rillmark.sources import snapshots as sn
from rillmark.streaming import flows, sinks
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def events(spark, n=400, users=30, seed=1):
    r = random.Random(seed)
    data = [(str(k), f"u{r.randint(0, users)}", f"i{r.randint(0, 9)}", r.choice(["view", "click", "rating", "other"]), None,
             T0 + timedelta(hours=r.randint(0, 71)), None) for k in range(n)]
    data = [(a, b, c, d, 3.0 if d == "rating" else None, f, g) for a, b, c, d, e, f, g in data]
    return flows.checked_stream(spark.createDataFrame(data, EVENT))


def test_parts_merge_to_one_pass(spark):
    df = events(spark)
    whole = sk.report_of(sk.report_parts(df)).first()
    parts = sk.report_parts(df.withColumn("p", F.pmod(F.hash("event_id"), F.lit(7))), ["p"])
    again = sk.report_of(sk.merged_parts(parts.where("p < 3")).unionByName(sk.merged_parts(parts.where("p >= 3")))).first()
    assert again == whole
    exact = {r.metric: r.value for r in ft.event_report(df).collect()}
    assert (whole.received, whole.valid, whole.invalid) == (exact["received"], exact["valid"], exact["invalid"])
    assert whole.unique_users == exact["unique_user_id"] and whole.unique_items == exact["unique_item_id"]
    assert [whole[f"share_{k}"] for k in sk.KINDS] == pytest.approx([exact[f"share_{k}"] for k in sk.KINDS])


def test_estimate_is_within_its_error(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).cast("string").alias("user_id"), F.lit("i").alias("item_id"),
                                     F.lit("view").alias("event_type"), F.lit(True).alias("valid"), (F.col("id") % 5).alias("p"))
    got = sk.report_of(sk.report_parts(df, ["p"])).first()
    assert abs(got.unique_users - 60_000) < 5 * 0.0163 * 60_000 and got.unique_items == 1
    assert max(len(r.users) for r in sk.report_parts(df).collect()) < 5000


def test_empty_and_all_invalid(spark):
    got = sk.report_of(sk.report_parts(events(spark).where("false"))).first()
    assert (got.received or 0, got.unique_users, got.share_view) == (0, 0, 0.0)
    bad = sk.report_of(sk.report_parts(events(spark).where("event_type = 'other'"))).first()
    assert bad.valid == 0 and bad.unique_users == 0 and bad.invalid == bad.received > 0


def test_exact_report_reads_its_input_once(spark):
    df = events(spark)
    path = scratch_dir(spark, "checked")
    df.write.parquet(path)
    plan = ft.event_report(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_stream_report_compacts(spark):
    path, out, cp = (scratch_dir(spark, n) for n in ("drop", "out", "cp"))
    for seed in range(4):
        events(spark, 100, seed=seed).drop("reasons", "valid").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)
        sinks.start_report(flows.checked_stream(stream), out, cp, once=True).awaitTermination()
    want = rows(sk.report_of(sk.report_parts(flows.checked_stream(spark.read.schema(EVENT).parquet(path)).withColumn(
        "day", F.to_date("timestamp").cast("string")), ["day"]), ["day"]))
    assert rows(sk.report_of(sn.read_batches(spark, out, sinks.merged_report), ["day"])) == want
    sn.compact(spark, out, sinks.merged_report)
    sn.drop_unused(spark, out, kept=1)
    assert rows(sk.report_of(sn.read_batches(spark, out, sinks.merged_report), ["day"])) == want
