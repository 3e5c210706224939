"""Queries over ranked lists: re-ranking, evaluation, fallbacks."""

from pyspark.sql import functions as F

from rillmark.operators import evaluate as el
from rillmark.operators import rerank as rr
from rillmark.operators import windows as wn
from rillmark.operators.features import item_popularity
from rillmark.plans.event_plans import order_interactions, valid_events
from rillmark.plans.experiment_plans import assigned
from rillmark.operators.experiments import route_versions
from rillmark.plans.registry import VIEWS, _NEEDS, query, with_views
from rillmark.sources.adapters import item_categories, item_factors, raw_events, table

SPLIT = "2024-01-20"
# Scored pairs: how often a user met an item in the order lines, plus a share of the part's price. Predictions: the
# items of the log's first part by frequency; actuals: what the user clicked or rated later.
VIEWS["scored"] = """
    SELECT user_id, item_id, CAST(count(*) AS DOUBLE) + any_value(p_retailprice) / CAST(7919 AS DOUBLE) AS score
    FROM li JOIN part ON item_id = 'item_' || p_partkey GROUP BY 1, 2"""
VIEWS["pred"] = f"""
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS rank FROM
      (SELECT user_id, item_id, count(*) AS n FROM ev WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY 1, 2)"""
VIEWS["act"] = f"""
    SELECT DISTINCT user_id, item_id FROM ev WHERE ts >= TIMESTAMP '{SPLIT}' AND event_type IN ('click', 'rating')"""
VIEWS["pop"] = """
    SELECT item_id, percent_rank() OVER (ORDER BY c) AS pp FROM (SELECT item_id, count(*) AS c FROM li GROUP BY 1)"""
VIEWS["damp"] = """
    SELECT user_id, item_id, CASE WHEN pp > 0.9 THEN score * CAST(0.8 AS DOUBLE)
                                  WHEN pp < 0.3 THEN score * CAST(1.2 AS DOUBLE) ELSE score END AS score
    FROM scored JOIN pop USING (item_id)"""
_NEEDS.update({"scored": ("li", "scored"), "pred": ("raw", "ev", "pred"), "act": ("raw", "ev", "act"),
               "pop": ("li", "pop"), "damp": ("li", "scored", "pop", "damp")})


def scored(spark, root):
    pairs = order_interactions(spark, root).groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    price = table(spark, root, "part").select(
        F.concat(F.lit("item_"), F.col("p_partkey").cast("string")).alias("item_id"), "p_retailprice")
    return pairs.join(price, "item_id").select(
        "user_id", "item_id", (F.col("n").cast("double") + F.col("p_retailprice") / F.lit(7919.0)).alias("score"))


def scored_with_popularity(spark, root):
    share = wn.popularity_percentile(order_interactions(spark, root)).select("item_id", "popularity_percentile")
    return scored(spark, root).join(share, "item_id", "left")


def seen_counts(spark, root):
    seen = valid_events(spark, root).where(F.col("timestamp") < F.lit(SPLIT).cast("timestamp"))
    return seen.groupBy("user_id", "item_id").agg(F.count("*").cast("double").alias("score"))


def predictions(spark, root):
    """Whole lists: the average precision is defined over all of a list."""
    return rr.ranked_lists(seen_counts(spark, root))


def first_ten(spark, root):
    """The first ten of each list, cut before the shuffle; enough for what looks at a list's head."""
    return rr.top_items(seen_counts(spark, root), 10)


def actuals(spark, root):
    late = F.col("timestamp") >= F.lit(SPLIT).cast("timestamp")
    return valid_events(spark, root).where(late & F.col("event_type").isin("click", "rating")).select(
        "user_id", "item_id").distinct()


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


_EVAL = """
    WITH na AS (SELECT user_id, count(*) AS n FROM act GROUP BY 1),
    h AS (SELECT p.user_id, rank, (a.item_id IS NOT NULL)::INT AS hit FROM pred p LEFT JOIN act a
          ON p.user_id = a.user_id AND p.item_id = a.item_id),
    t AS (SELECT user_id, sum(hit) AS hits, count(*) AS listed, sum(hit / log2(rank + 1)) AS dcg FROM h WHERE rank <= 10
          GROUP BY 1),
    i AS (SELECT user_id, sum(1.0 / log2(r + 1)) AS idcg FROM na, range(1, 11) x(r) WHERE r <= n GROUP BY 1),
    b AS (SELECT coalesce(t.user_id, na.user_id) AS user_id, hits, listed, dcg, n FROM t FULL JOIN na
          ON t.user_id = na.user_id)"""


@query("ndcg_at_k", with_views("pred act", _EVAL + """
    SELECT b.user_id, round(coalesce(dcg / idcg, 0), 6) AS ndcg FROM b LEFT JOIN i ON b.user_id = i.user_id"""))
def ndcg_at_k(spark, root):
    return _round(el.evaluate(first_ten(spark, root), actuals(spark, root), 10).select("user_id", "ndcg"), "ndcg")


@query("precision_recall_at_k", with_views("pred act", _EVAL + """
    SELECT user_id, round(coalesce(hits / CAST(listed AS DOUBLE), 0), 6) AS precision,
           round(coalesce(hits / CAST(n AS DOUBLE), 0), 6) AS recall FROM b"""))
def precision_recall_at_k(spark, root):
    df = el.evaluate(first_ten(spark, root), actuals(spark, root), 10).select("user_id", "precision", "recall")
    return _round(df, "precision", "recall")


_AP = """
    WITH na AS (SELECT user_id, count(*) AS n FROM act GROUP BY 1),
    h AS (SELECT p.user_id, rank, row_number() OVER (PARTITION BY p.user_id ORDER BY rank) AS c
          FROM pred p JOIN act a ON p.user_id = a.user_id AND p.item_id = a.item_id),
    g AS (SELECT user_id, sum(CAST(c AS DOUBLE) / rank) AS gain FROM h GROUP BY 1),
    ap AS (SELECT na.user_id, coalesce(gain, 0) / n AS average_precision FROM na LEFT JOIN g ON na.user_id = g.user_id)"""


@query("average_precision", with_views("pred act", _AP + """
    SELECT user_id, round(average_precision, 6) AS average_precision FROM ap"""))
def average_precision(spark, root):
    return _round(el.average_precision(predictions(spark, root), actuals(spark, root)), "average_precision")


@query("map_score", with_views("pred act", _AP + """
    SELECT round(avg(average_precision), 6) AS map_score, count(*) AS users FROM ap"""))
def map_score(spark, root):
    return _round(el.mean_ap(predictions(spark, root), actuals(spark, root)), "map_score")


@query("catalog_coverage", with_views("pred", """
    WITH r AS (SELECT DISTINCT item_id FROM pred WHERE rank <= 10),
    c AS (SELECT 'item_' || p_partkey AS item_id FROM part)
    SELECT (SELECT count(*) FROM c WHERE item_id IN (SELECT item_id FROM r)) AS recommended, count(*) AS catalogue,
           round(CAST((SELECT count(*) FROM c WHERE item_id IN (SELECT item_id FROM r)) AS DOUBLE) / count(*), 6)
             AS coverage FROM c"""))
def catalog_coverage(spark, root):
    return _round(el.coverage(first_ten(spark, root), item_categories(spark, root)), "coverage")


@query("list_diversity", with_views("scored", """
    WITH l AS (SELECT user_id, item_id, p_type, p_brand FROM scored JOIN part ON item_id = 'item_' || p_partkey),
    s AS (SELECT a.user_id, (a.p_type = b.p_type)::INT + (a.p_brand = b.p_brand)::INT AS c FROM l a JOIN l b
          ON a.user_id = b.user_id AND a.item_id < b.item_id),
    d AS (SELECT user_id, avg(1.0 - c / CAST(4 - c AS DOUBLE)) AS d FROM s GROUP BY 1),
    n AS (SELECT user_id, count(*) AS n FROM l GROUP BY 1)
    SELECT n.user_id, n, round(coalesce(d, 1.0), 6) AS diversity FROM n LEFT JOIN d ON n.user_id = d.user_id"""))
def list_diversity(spark, root):
    lists = scored(spark, root).join(item_categories(spark, root), "item_id")
    return _round(el.list_diversity(lists), "diversity")


@query("topk_per_user", with_views("scored", """
    SELECT user_id, item_id, round(score, 6) AS score,
           row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored QUALIFY rank <= 10"""))
def topk_per_user(spark, root):
    return _round(rr.top_items(scored(spark, root), 10), "score").withColumn("rank", F.col("rank").cast("bigint"))


@query("normalised_scores", with_views("scored", """
    SELECT user_id, item_id, round(score / max(score) OVER (PARTITION BY user_id), 6) AS relevance FROM scored"""))
def normalised_scores(spark, root):
    return _round(rr.normalised(scored(spark, root)).select("user_id", "item_id", "relevance"), "relevance")


@query("popularity_dampened", with_views("damp", """
    SELECT user_id, item_id, round(score, 6) AS score,
           row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM damp QUALIFY rank <= 10"""))
def popularity_dampened(spark, root):
    top = rr.top_items(rr.dampen(scored_with_popularity(spark, root)), 10)
    return _round(top.select("user_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank")), "score")


@query("prefix_rerank", with_views("scored", """
    WITH x AS (SELECT user_id, left(item_id, length(item_id) - 1) || '_' || right(item_id, 1) AS item_id, score
               FROM scored),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM x QUALIFY r <= 10),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, left(item_id, length(item_id) - 2) ORDER BY r) AS k FROM r),
    s AS (SELECT user_id, item_id, r, round(CASE WHEN k > 1 THEN score * CAST(0.8 AS DOUBLE) ELSE score END, 4) AS score FROM k)
    SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, r) AS rank FROM s"""))
def prefix_rerank(spark, root):
    # The last digit of the part number becomes the last section of the id, so prefixes repeat.
    df = scored(spark, root).withColumn("item_id", F.concat(
        F.expr("left(item_id, length(item_id) - 1)"), F.lit("_"), F.expr("right(item_id, 1)")))
    return rr.prefix_rerank(df, 10).withColumn("rank", F.col("rank").cast("bigint"))


@query("cold_start_recs", with_views("ev", f"""
    WITH p AS (SELECT item_id, row_number() OVER (ORDER BY c DESC, item_id) - 1 AS i FROM
                 (SELECT item_id, count(*) AS c FROM ev GROUP BY 1) QUALIFY i < 10),
    u AS (SELECT 'user_' || c_custkey AS user_id FROM customer
          EXCEPT SELECT user_id FROM ev)
    SELECT user_id, item_id, round(1.0 - CAST(0.01 AS DOUBLE) * i, 4) AS score, i + 1 AS rank FROM u, p"""))
def cold_start_recs(spark, root):
    users = table(spark, root, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user_id"))
    events = valid_events(spark, root)
    return rr.cold_start(users, events, item_popularity(events), 10).withColumn("rank", F.col("rank").cast("bigint"))


# Stored lists: every event of a user left a list of five items.
@query("fresh_recs", with_views("raw", """
    WITH s AS (SELECT user_id, CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 THEN 'control' ELSE 'treatment' END AS grp, ts,
                 event_id FROM raw WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 6 HOURS
                 AND ts <= TIMESTAMP '2024-01-15 12:00:00'),
    n AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id, grp ORDER BY ts DESC) = 1)
    SELECT user_id, grp AS "group", event_id || '_' || r AS item_id, r AS rank, ts AS created_at
    FROM n, range(1, 4) x(r)"""))
def fresh_recs(spark, root):
    stored = raw_events(spark, root).select(
        "user_id", F.when(F.col("event_id").cast("bigint") % 2 == 0, "control").otherwise("treatment").alias("group"),
        F.col("timestamp").alias("created_at"), "event_id",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(5).cast("bigint"))).alias("rank"),
    ).select("user_id", "group", F.concat_ws("_", "event_id", F.col("rank").cast("string")).alias("item_id"), "rank", "created_at")
    return rr.fresh_recs(stored, "2024-01-15 12:00:00", 6 * 3600, 3)


@query("routed_recs", with_views("asg damp", """
    WITH u AS (SELECT user_id, arg_max(CASE WHEN status = 'active' AND grp = 'treatment' THEN treatment_version
                 ELSE control_version END, (ts, request_id)) AS model_version,
               arg_max(CASE WHEN status = 'active' AND grp = 'treatment' THEN 'treatment' ELSE 'control' END,
                 (ts, request_id)) AS served_group FROM asg WHERE status IS NOT NULL GROUP BY 1),
    r AS (SELECT 'v1' AS model_version, * FROM scored UNION ALL SELECT 'v4', * FROM damp),
    t AS (SELECT *, row_number() OVER (PARTITION BY model_version, user_id ORDER BY score DESC, item_id) AS rank FROM r
          QUALIFY rank <= 5)
    SELECT t.user_id, t.model_version, served_group, item_id, round(score, 6) AS score, rank
    FROM t JOIN u ON t.user_id = u.user_id AND t.model_version = u.model_version"""))
def routed_recs(spark, root):
    # a request for an unknown experiment is served nothing: the user's last request that is served counts
    routed = route_versions(assigned(spark, root)).where("status <> 'unknown'").groupBy("user_id").agg(
        F.max(F.struct("timestamp", "request_id", "model_version", "served_group")).alias("l")
    ).select("user_id", "l.model_version", "l.served_group")
    pairs = scored_with_popularity(spark, root)
    plain = rr.top_items(pairs, 5).withColumn("model_version", F.lit("v1"))
    lowered = rr.top_items(rr.dampen(pairs), 5).withColumn("model_version", F.lit("v4"))
    recs = plain.unionByName(lowered).select("user_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank"), "model_version")
    return _round(rr.route_recs(routed, recs), "score")


# The greedy choice as a recursive query: each step adds, per user, the item with the largest marginal value.
@query("mmr_rerank", with_views("damp", """
    WITH c AS (SELECT user_id, item_id, score, p_type, p_brand, max(score) OVER (PARTITION BY user_id) AS m
               FROM damp JOIN part ON item_id = 'item_' || p_partkey),
    steps AS (
      SELECT user_id, 1 AS rank, [item_id] AS picked, [p_type] AS types, [p_brand] AS brands, item_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM c) WHERE r = 1
      UNION ALL
      SELECT user_id, rank, picked, types, brands, item_id, score FROM (
        SELECT s.user_id, s.rank + 1 AS rank, list_append(s.picked, c.item_id) AS picked,
               list_append(s.types, c.p_type) AS types, list_append(s.brands, c.p_brand) AS brands, c.item_id, c.score,
               row_number() OVER (PARTITION BY s.user_id ORDER BY
                 CAST(0.7 AS DOUBLE) * (c.score / (CASE WHEN c.m > 0 THEN c.m ELSE 1 END)) - (CAST(1 AS DOUBLE) - CAST(0.7 AS DOUBLE)) * (
                   CASE WHEN list_contains(list_transform(range(1, s.rank + 1), lambda i: s.types[i] = c.p_type AND s.brands[i] = c.p_brand), true) THEN CAST(1 AS DOUBLE)
                        WHEN list_contains(s.types, c.p_type) OR list_contains(s.brands, c.p_brand) THEN CAST(1 AS DOUBLE) / CAST(3 AS DOUBLE)
                        ELSE CAST(0 AS DOUBLE) END) DESC, c.score DESC, c.item_id) AS r
        FROM steps s JOIN c ON c.user_id = s.user_id WHERE s.rank < 10 AND NOT list_contains(s.picked, c.item_id)
      ) WHERE r = 1)
    SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM steps""", recursive=True))
def mmr_rerank(spark, root):
    pairs = scored_with_popularity(spark, root).join(item_categories(spark, root), "item_id")
    return _round(rr.rerank(pairs, 10), "score").withColumn("rank", F.col("rank").cast("bigint"))


_DOT = """
    WITH f AS (SELECT 'item_' || vec_id AS item_id, generate_subscripts(embedding, 1) AS i,
                      CAST(unnest(embedding) AS DOUBLE) AS y FROM embeddings)"""


@query("dot_scores", with_views("ev", _DOT + """
    , p AS (SELECT DISTINCT user_id, item_id FROM ev)
    SELECT p.user_id, p.item_id, round(sum(a.y * b.y), 6) AS score
    FROM p JOIN f a ON a.item_id = p.item_id
    JOIN f b ON b.item_id = 'item_' || regexp_extract(p.user_id, '[0-9]+') AND a.i = b.i GROUP BY 1, 2"""))
def dot_scores(spark, root):
    items = item_factors(spark, root)
    users = items.select(F.regexp_replace("item_id", "item_", "user_").alias("user_id"), "features")
    pairs = valid_events(spark, root).select("user_id", "item_id").distinct()
    return _round(rr.dot_scores(pairs, users, items), "score")


@query("auc_rank_sum", """
    WITH s AS (SELECT value AS score, (event_type = 'click')::INT AS label FROM events),
    r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s),
    n AS (SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
                 sum(r) FILTER (label = 1) AS rs FROM r)
    SELECT positives, negatives, round((rs - positives * (positives + 1) / 2.0) / (positives * CAST(negatives AS DOUBLE)), 6) AS auc
    FROM n""")
def auc_rank_sum(spark, root):
    df = table(spark, root, "events").select(
        F.col("value").alias("score"), (F.col("event_type") == "click").cast("int").alias("label"))
    return _round(el.auc(df), "auc")
