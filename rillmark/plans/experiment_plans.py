"""Queries over experiments, profiles and recommendation routing."""

from pyspark.sql import functions as F

from rillmark.operators import experiments as ex
from rillmark.operators import profiles as pr
from rillmark.operators.events import explode_served
from rillmark.plans.event_plans import served_records, valid_events
from rillmark.plans.registry import VIEWS, _NEEDS, query, with_views
from rillmark.session import checkpointed, scratch_dir
from rillmark.sources import experiments as xt
from rillmark.sources.adapters import raw_events, table

# Experiments stand on the nation table, requests on the event log: every event is a request of its user, and every
# tenth item asks without naming an experiment.
VIEWS["xp"] = """
    SELECT 'exp_' || n_nationkey AS experiment_id, n_name AS name,
           CASE WHEN n_regionkey = 1 THEN 'paused' ELSE 'active' END AS status,
           CASE n_regionkey WHEN 0 THEN 100 WHEN 1 THEN 50 WHEN 2 THEN 50 WHEN 3 THEN 20 ELSE 5 END AS traffic,
           'v1' AS control_version, 'v' || (2 + n_regionkey) AS treatment_version,
           TIMESTAMP '2023-12-01' + CAST(n_nationkey || ' hours' AS INTERVAL) AS created_at
    FROM nation"""
VIEWS["newest"] = """
    SELECT * FROM xp WHERE status = 'active' QUALIFY row_number() OVER (ORDER BY created_at DESC, experiment_id DESC) = 1"""
VIEWS["rq"] = """
    SELECT event_id AS request_id, user_id, ts,
           CASE WHEN event_id_n % 10 <> 0 THEN 'exp_' || (CAST(regexp_extract(item_id, '[0-9]+') AS BIGINT) % 30)
           ELSE (SELECT experiment_id FROM newest) END AS experiment_id
    FROM (SELECT *, CAST(regexp_extract(item_id, '[0-9]+') AS BIGINT) AS event_id_n FROM raw)"""
VIEWS["asg"] = """
    SELECT *, CASE WHEN traffic IS NULL THEN NULL WHEN b >= traffic THEN 'excluded' WHEN b < traffic / CAST(2.0 AS DOUBLE) THEN 'control'
              ELSE 'treatment' END AS grp
    FROM (SELECT request_id, user_id, ts, rq.experiment_id, status, traffic, control_version, treatment_version,
                 CASE WHEN xp.experiment_id IS NOT NULL
                      THEN CAST('0x' || substr(sha256(user_id || ':' || rq.experiment_id), 1, 8) AS BIGINT) % 100 END AS b
          FROM rq LEFT JOIN xp ON rq.experiment_id = xp.experiment_id)"""
VIEWS["rec"] = """
    SELECT user_id, experiment_id, grp, ts AS assigned_at FROM asg WHERE status = 'active' AND grp <> 'excluded'
    QUALIFY row_number() OVER (PARTITION BY user_id, experiment_id ORDER BY ts) = 1"""
VIEWS["att"] = """
    SELECT ev.*, experiment_id, grp, assigned_at FROM ev JOIN rec ON ev.user_id = rec.user_id AND ev.ts >= assigned_at"""
_base = ("raw", "xp", "newest", "rq", "asg")
_NEEDS.update({"rq": _base[:4], "newest": ("xp", "newest"), "asg": _base, "rec": (*_base, "rec"),
               "att": (*_base, "ev", "rec", "att")})


def experiments(spark, root):
    region = F.col("n_regionkey")
    traffic = F.when(region == 0, 100).when(region.isin(1, 2), 50).when(region == 3, 20).otherwise(5)
    return table(spark, root, "nation").select(
        F.concat(F.lit("exp_"), F.col("n_nationkey").cast("string")).alias("experiment_id"),
        F.col("n_name").alias("name"),
        F.when(region == 1, "paused").otherwise("active").alias("status"),
        traffic.alias("traffic_percentage"), F.lit("v1").alias("control_version"),
        F.concat(F.lit("v"), (region + 2).cast("string")).alias("treatment_version"),
        (F.lit("2023-12-01").cast("timestamp") + F.make_dt_interval(hours=F.col("n_nationkey"))).alias("created_at"),
    )


def requests(spark, root):
    k = F.regexp_extract("item_id", "[0-9]+", 0).cast("bigint")
    return raw_events(spark, root).select(
        F.col("event_id").alias("request_id"), "user_id", "timestamp",
        F.when(k % 10 != 0, F.concat(F.lit("exp_"), (k % 30).cast("string"))).alias("experiment_id"))


def assigned(spark, root):
    return ex.assign(requests(spark, root), experiments(spark, root))


def recorded(spark, root):
    """Recorded assignments; those before the middle of the month already exist when the later requests come in."""
    rows = ex.route_versions(assigned(spark, root)).where("recorded").select(
        "user_id", "experiment_id", "group", F.col("timestamp").alias("assigned_at"))
    split = F.lit("2024-01-15").cast("timestamp")
    none = rows.where(F.lit(False))
    existing = ex.sticky(rows.where(F.col("assigned_at") < split), none)
    # Assignments are a stored table: they are written once and read from there.
    return checkpointed(ex.sticky(rows.where(F.col("assigned_at") >= split), existing), "assignments")


def attributed(spark, root, assignments=None):
    ev = valid_events(spark, root).select("event_id", "user_id", "item_id", "event_type", "timestamp", "rating")
    return ex.attribute(ev, recorded(spark, root) if assignments is None else assignments)


@query("active_experiment", with_views("newest", """
    SELECT experiment_id, name, status, traffic AS traffic_percentage, created_at FROM newest"""))
def active_experiment(spark, root):
    return ex.active_experiment(experiments(spark, root)).select(
        "experiment_id", "name", "status", "traffic_percentage", "created_at")


@query("assign_groups", with_views("asg", """
    SELECT request_id, user_id, experiment_id, b AS bucket, grp AS "group",
           CASE WHEN traffic IS NULL THEN 'experiment not found' END AS reason FROM asg"""))
def assign_groups(spark, root):
    return assigned(spark, root).select("request_id", "user_id", "experiment_id", "bucket", "group", "reason")


@query("routed_versions", with_views("asg", """
    SELECT request_id, user_id, experiment_id,
           CASE WHEN status = 'active' AND grp = 'treatment' THEN 'treatment' WHEN status IS NOT NULL THEN 'control' END
             AS served_group,
           CASE WHEN status = 'active' AND grp = 'treatment' THEN treatment_version ELSE control_version END
             AS model_version,
           coalesce(status = 'active' AND grp <> 'excluded', false) AS recorded
    FROM asg"""))
def routed_versions(spark, root):
    return ex.route_versions(assigned(spark, root)).select(
        "request_id", "user_id", "experiment_id", "served_group", "model_version", "recorded")


@query("sticky_assignments", with_views("rec", """
    SELECT user_id, experiment_id, grp AS "group", assigned_at FROM rec"""))
def sticky_assignments(spark, root):
    return recorded(spark, root)


# The three tables written with their checks and read back: every experiment with its recorded assignments and metric values.
@query("experiment_tables", with_views("rec att", """
    SELECT xp.experiment_id, name, status, CAST(traffic AS INTEGER) AS traffic_percentage, created_at,
           (SELECT count(*) FROM rec r WHERE r.experiment_id = xp.experiment_id) AS assignments,
           (SELECT count(*) FROM att a WHERE a.experiment_id = xp.experiment_id AND a.ts >= TIMESTAMP '2024-01-20') AS metrics
    FROM xp"""))
def experiment_tables(spark, root):
    store = scratch_dir(spark, "experiments")
    given = recorded(spark, root)
    events = attributed(spark, root, given).select(
        "experiment_id", "group", "timestamp", F.col("event_type").alias("metric_name"), F.lit(1.0).alias("metric_value"))
    for kind, df in (("experiments", experiments(spark, root)), ("assignments", given), ("metrics", events)):
        xt.write_table(df, store, kind)
    known = xt.read_table(spark, store, "experiments")
    sizes = xt.read_table(spark, store, "assignments").groupBy("experiment_id").agg(F.count("*").alias("assignments"))
    values = xt.read_table(spark, store, "metrics", "2024-01-20").groupBy("experiment_id").agg(F.count("*").alias("metrics"))
    zero = F.lit(0).cast("bigint")
    return known.join(sizes, "experiment_id", "left").join(values, "experiment_id", "left").select(
        "experiment_id", "name", "status", "traffic_percentage", "created_at", F.coalesce("assignments", zero).alias("assignments"),
        F.coalesce("metrics", zero).alias("metrics"))


@query("experiment_sizes", with_views("rec", """
    SELECT experiment_id, grp AS "group", count(*) AS sample_size FROM rec GROUP BY 1, 2"""))
def experiment_sizes(spark, root):
    return ex.group_sizes(recorded(spark, root))


@query("attributed_events", with_views("att", """
    SELECT event_id, user_id, experiment_id, grp AS "group", event_type, ts AS "timestamp" FROM att"""))
def attributed_events(spark, root):
    return attributed(spark, root).select("event_id", "user_id", "experiment_id", "group", "event_type", "timestamp")


@query("experiment_metrics", with_views("att", """
    WITH s AS (SELECT experiment_id, grp, count(*) AS sample_size FROM rec GROUP BY 1, 2),
    m AS (SELECT experiment_id, grp, CASE event_type WHEN 'rating' THEN 'rating_sum' ELSE event_type END AS metric_name,
                 sum(coalesce(rating, 1.0)) AS v FROM att GROUP BY 1, 2, 3)
    SELECT m.experiment_id, m.grp AS "group", metric_name, sample_size, round(v / sample_size, 4) AS metric_mean
    FROM m JOIN s ON m.experiment_id = s.experiment_id AND m.grp = s.grp"""))
def experiment_metrics(spark, root):
    name = F.when(F.col("event_type") == "rating", "rating_sum").otherwise(F.col("event_type"))
    stored = recorded(spark, root)
    events = attributed(spark, root, stored).select(
        "experiment_id", "group", name.alias("metric_name"), F.coalesce("rating", F.lit(1.0)).alias("metric_value"))
    return ex.metrics(stored, events)


_CTR = """count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'click') AS clicks,
    round(CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN CAST(count(*) FILTER (event_type = 'click') AS DOUBLE)
          / count(*) FILTER (event_type = 'view') ELSE 0.0 END, 6) AS ctr"""


@query("group_ctr", with_views("att", f'SELECT experiment_id, grp AS "group", {_CTR} FROM att GROUP BY 1, 2'))
def group_ctr(spark, root):
    return ex.group_ctr(attributed(spark, root)).withColumn("ctr", F.round("ctr", 6))


@query("group_ctr_daily", with_views("att", f"""
    SELECT experiment_id, grp AS "group", CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_CTR} FROM att
    GROUP BY experiment_id, grp, CAST(ts AS DATE)"""))
def group_ctr_daily(spark, root):
    df = ex.group_ctr(attributed(spark, root), F.to_date("timestamp").cast("string").alias("day"))
    return df.withColumn("ctr", F.round("ctr", 6))


@query("ab_chi2", with_views("att", """
    WITH c AS (SELECT DISTINCT user_id, experiment_id FROM att WHERE event_type = 'click'),
    g AS (SELECT rec.experiment_id, grp, count(*) AS n, count(c.user_id) AS s FROM rec LEFT JOIN c
          ON rec.user_id = c.user_id AND rec.experiment_id = c.experiment_id GROUP BY 1, 2),
    w AS (SELECT experiment_id,
            CAST(coalesce(sum(s) FILTER (grp = 'control'), 0) AS DOUBLE) AS a,
            CAST(coalesce(sum(n - s) FILTER (grp = 'control'), 0) AS DOUBLE) AS b,
            CAST(coalesce(sum(s) FILTER (grp = 'treatment'), 0) AS DOUBLE) AS c,
            CAST(coalesce(sum(n - s) FILTER (grp = 'treatment'), 0) AS DOUBLE) AS d
          FROM g GROUP BY 1),
    x AS (SELECT experiment_id, CASE WHEN (a+b)*(c+d)*(a+c)*(b+d) > 0
            THEN (a+b+c+d)*(a*d-b*c)*(a*d-b*c)/((a+b)*(c+d)*(a+c)*(b+d)) ELSE 0.0 END AS chi2 FROM w),
    t AS (SELECT experiment_id, chi2, sqrt(chi2 / 2) AS z, 1.0 / (1.0 + 0.3275911 * sqrt(chi2 / 2)) AS t FROM x),
    p AS (SELECT experiment_id, chi2, CASE WHEN chi2 > 0 THEN t * (0.254829592 + t * (-0.284496736 + t * (1.421413741
            + t * (-1.453152027 + t * 1.061405429)))) * exp(-z * z) ELSE 1.0 END AS p FROM t)
    SELECT experiment_id, round(chi2, 6) AS chi2, round(p, 6) AS p_value, round(1.0 - p, 6) AS confidence,
           p < 0.05 AS significant FROM p"""))
def ab_chi2(spark, root):
    stored = recorded(spark, root)
    counts = ex.user_conversions(stored, attributed(spark, root, stored))
    return ex.chi2(counts).select("experiment_id", *[F.round(c, 6).alias(c) for c in ("chi2", "p_value", "confidence")],
                                  "significant")


@query("served_clicks", with_views("ev", """
    WITH s AS (SELECT CAST(event_id AS VARCHAR) AS event_id, 'user_' || user_id AS user_id,
                 'item_' || ((CAST(json_extract_string(props, '$.k') AS BIGINT) + j) % 100) AS item_id,
                 CAST(j + 1 AS BIGINT) AS rank, date_trunc('second', ts) AS ts
               FROM events, range(5) t(j) WHERE event_type IN ('view', 'signup'))
    SELECT s.event_id, s.user_id, s.item_id, s.rank, min(c.ts) AS clicked_at, min(c.ts) IS NOT NULL AS clicked
    FROM s LEFT JOIN ev c ON c.event_type = 'click' AND c.user_id = s.user_id AND c.item_id = s.item_id
         AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 24 HOURS
    GROUP BY 1, 2, 3, 4"""))
def served_clicks(spark, root):
    served = explode_served(served_records(spark, root)).select("event_id", "user_id", "item_id", "rank", "timestamp")
    clicks = valid_events(spark, root).where("event_type = 'click'").select("user_id", "item_id", "timestamp")
    return ex.served_clicks(served, clicks, 24).select(
        "event_id", "user_id", "item_id", F.col("rank").cast("bigint").alias("rank"), "clicked_at", "clicked")


@query("new_profiles", """
    WITH i AS (SELECT c_name AS username, 'mail_' || (c_custkey + 7) || '@example.com' AS email, c_custkey FROM customer),
    x AS (SELECT c_name AS username, 'mail_' || c_custkey || '@example.com' AS email FROM customer WHERE c_acctbal > 5000)
    SELECT * FROM i WHERE username NOT IN (SELECT username FROM x) AND email NOT IN (SELECT email FROM x)""")
def new_profiles(spark, root):
    def mail(shift):
        return F.concat(F.lit("mail_"), (F.col("c_custkey") + shift).cast("string"), F.lit("@example.com")).alias("email")
    c = table(spark, root, "customer")
    incoming = c.select(F.col("c_name").alias("username"), mail(7), "c_custkey")
    existing = c.where(F.col("c_acctbal") > 5000).select(F.col("c_name").alias("username"), mail(0))
    return pr.new_profiles(incoming, existing).select("username", "email", "c_custkey")


# Sign-ups that clash with each other: names repeat every 401 customers, addresses every 457, and suppliers hold some already. SQL
# takes the requests one by one in order of balance.
@query("first_come_profiles", """
    WITH RECURSIVE r AS (
      SELECT c_custkey AS id, 'name_' || (c_custkey % 401) AS username, 'mail_' || (c_custkey * 31 % 457) AS email,
             row_number() OVER (ORDER BY c_acctbal, c_custkey) AS n FROM customer),
    x AS (SELECT 'name_' || (s_suppkey * 3) AS username, 'mail_' || (s_suppkey * 5) AS email FROM supplier),
    fold AS (
      SELECT CAST(0 AS BIGINT) AS n, (SELECT list(username) FROM x) AS names, (SELECT list(email) FROM x) AS mails, false AS ok
      UNION ALL
      SELECT n, CASE WHEN ok THEN list_append(names, username) ELSE names END,
             CASE WHEN ok THEN list_append(mails, email) ELSE mails END, ok
      FROM (SELECT r.n, names, mails, username, email, NOT list_contains(names, username) AND NOT list_contains(mails, email) AS ok
            FROM fold JOIN r ON r.n = fold.n + 1))
    SELECT username, email, id FROM fold JOIN r USING (n) WHERE ok""")
def first_come_profiles(spark, root):
    k = F.col("c_custkey")
    incoming = table(spark, root, "customer").select(
        "c_acctbal", k.alias("id"), F.concat(F.lit("name_"), (k % 401).cast("string")).alias("username"),
        F.concat(F.lit("mail_"), (k * 31 % 457).cast("string")).alias("email"))
    s = F.col("s_suppkey")
    existing = table(spark, root, "supplier").select(
        F.concat(F.lit("name_"), (s * 3).cast("string")).alias("username"),
        F.concat(F.lit("mail_"), (s * 5).cast("string")).alias("email"))
    return pr.new_profiles(incoming, existing, ["c_acctbal", "id"]).select("username", "email", "id")


# Each order sets its customer's segment (finished orders) or balance (open orders).
@query("upsert_dimension", """
    WITH u AS (SELECT o_custkey AS k, o_orderdate AS d, o_orderkey AS o,
                 CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS seg,
                 CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS bal FROM orders),
    s AS (SELECT k, arg_max(seg, (d, o)) AS seg FROM u WHERE seg IS NOT NULL GROUP BY 1),
    b AS (SELECT k, arg_max(bal, (d, o)) AS bal FROM u WHERE bal IS NOT NULL GROUP BY 1)
    SELECT c_custkey, c_name, coalesce(s.seg, c_mktsegment) AS c_mktsegment, coalesce(b.bal, c_acctbal) AS c_acctbal
    FROM customer LEFT JOIN s ON s.k = c_custkey LEFT JOIN b ON b.k = c_custkey""")
def upsert_dimension(spark, root):
    base = table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    updates = table(spark, root, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("c_mktsegment"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("c_acctbal"), "o_orderdate", "o_orderkey")
    return pr.upsert(base, updates, "c_custkey", ["o_orderdate", "o_orderkey"])


@query("merge_preferences", """
    SELECT user_id, name, value FROM (
      SELECT 'user_' || user_id AS user_id, event_type AS name, json_extract_string(props, '$.k') AS value, ts, event_id
      FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id, name ORDER BY ts DESC, event_id DESC) = 1""")
def merge_preferences(spark, root):
    updates = table(spark, root, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"), "ts", "event_id",
        F.create_map(F.col("event_type"), F.get_json_object("props", "$.k")).alias("preferences"))
    return pr.merge_preferences(updates, ["ts", "event_id"])


@query("paged_listing", "SELECT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey LIMIT 20 OFFSET 40")
def paged_listing(spark, root):
    return pr.page(table(spark, root, "customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], 40, 20)
