"""Queries over models and factors."""

from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import models as ml
from rillmark.operators import recommend as rc
from rillmark.operators import rerank as rr
from rillmark.operators import training as tr
from rillmark.operators import warm as wm
from rillmark.operators import windows as wn
from rillmark.operators.topn import top_items
from rillmark.plans.event_plans import valid_events
from rillmark.plans.registry import query, with_views
from rillmark.plans.training_plans import feature_tables
from rillmark.session import checkpointed
from rillmark.sources.adapters import item_categories, item_factors, table


def pair_counts(spark, root):
    return valid_events(spark, root).groupBy("user_id", "item_id").agg(F.count("*").alias("interaction_count"))


@query("indexed_pairs", with_views("ev", """
    WITH p AS (SELECT user_id, item_id, count(*) AS interaction_count FROM ev GROUP BY 1, 2),
    u AS (SELECT user_id, row_number() OVER (ORDER BY sha256(user_id)) - 1 AS user_index FROM (SELECT DISTINCT user_id FROM p)),
    i AS (SELECT item_id, row_number() OVER (ORDER BY sha256(item_id)) - 1 AS item_index FROM (SELECT DISTINCT item_id FROM p))
    SELECT user_id, item_id, interaction_count, CAST(user_index AS INTEGER) AS user_index,
           CAST(item_index AS INTEGER) AS item_index FROM p JOIN u USING (user_id) JOIN i USING (item_id)"""))
def indexed_pairs(spark, root):
    return ml.index_pairs(pair_counts(spark, root)).select(
        "user_id", "item_id", "interaction_count", "user_index", "item_index")


@query("als_candidates")
def als_candidates(spark, root):
    indexed = checkpointed(ml.index_pairs(pair_counts(spark, root)), "indexed")
    return ml.als_candidates(ml.train_als(indexed), indexed, 100).select(
        "user_id", "item_id", "rank", F.round("score", 4).alias("score"))


# Vectors of uneven length: items are the embeddings, stretched by up to a factor of seven, users every fifth embedding.
@query("top_products", """
    WITH f AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS y FROM embeddings),
    s AS (SELECT 'user_' || u.vec_id AS user_id, 'item_' || i.vec_id AS item_id, sum(u.y * (i.y * (1 + i.vec_id % 7))) AS score
          FROM f u JOIN f i ON u.i = i.i WHERE u.vec_id % 5 = 0 GROUP BY 1, 2)
    SELECT user_id, item_id, round(score, 6) AS score,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM s
    QUALIFY rank <= 20""")
def top_products(spark, root):
    base = table(spark, root, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    users = base.where("vec_id % 5 = 0").select(
        F.concat(F.lit("user_"), F.col("vec_id").cast("string")).alias("user_id"), F.col("v").alias("features"))
    items = base.select(F.concat(F.lit("item_"), F.col("vec_id").cast("string")).alias("item_id"),
                        F.transform("v", lambda x: x * (1 + F.col("vec_id") % 7)).alias("features"))
    return top_items(users, items, 20, size=64).rows.withColumn("score", F.round("score", 6))


# The factors differ from one library to another, so SQL states what must hold of any: every user has the 100 best of the
# catalogue with ranks 1..n, each score is the inner product of the two factors, and blocks of another size find the same lists.
@query("als_candidates_audit", with_views("ev", """
    SELECT DISTINCT user_id, least(100, (SELECT count(DISTINCT item_id) FROM ev)) AS candidates, true AS ranked, true AS exact,
           true AS best FROM ev"""))
def als_candidates_audit(spark, root):
    indexed = checkpointed(ml.index_pairs(pair_counts(spark, root)), "indexed")
    users, items = (checkpointed(f, "factors") for f in ml.named_factors(ml.train_als(indexed), indexed))
    top = top_items(users, items, 100).rows.withColumnRenamed("score", "given")
    per = rr.dot_scores(top, users, items).groupBy("user_id").agg(
        F.count_distinct("item_id").alias("candidates"),
        ((F.count_distinct("rank") == F.count("*")) & (F.max("rank") == F.count("*"))).alias("ranked"),
        (F.max(F.abs(F.col("given") - F.col("score"))) < 1e-6).alias("exact"))
    other = top_items(users, items, 100, size=16).rows.groupBy("user_id").agg(
        F.sum(F.xxhash64("item_id", "rank").cast("decimal(38,0)")).alias("sum"))
    own = top.groupBy("user_id").agg(F.sum(F.xxhash64("item_id", "rank").cast("decimal(38,0)")).alias("mine"))
    return per.join(own, "user_id").join(other, "user_id").select(
        "user_id", "candidates", "ranked", "exact", (F.col("mine") == F.col("sum")).alias("best"))


def kept_events(spark, root):
    """The valid events, stored: several tables are made of them, and each would parse the log again."""
    return checkpointed(valid_events(spark, root).drop("event_id"), "valid-events")


def trained_ranker(pairs, users, items):
    """The model alone: its cross-validation is part of ``ranker_scores``."""
    return ml.train_ranker(checkpointed(tr.build_training_set(pairs, users, items), "training"), folds=0)


# ``auc`` is the model's own, of the out-of-fold scores of its cross-validation.
@query("ranker_scores")
def ranker_scores(spark, root):
    pairs, users, items = feature_tables(kept_events(spark, root))
    rows = checkpointed(tr.split(tr.build_training_set(pairs, users, items)), "training")
    model = ml.train_ranker(rows.where("split = 'train'"))
    return ml.score(model, rows.where("split <> 'train'")).select(
        "user_id", "item_id", "split", "label", F.round("score", 6).alias("score"), F.round(F.lit(model.auc), 6).alias("auc"))


@query("recommend_all")
def recommend_all(spark, root):
    events = kept_events(spark, root)
    pairs, users, items = feature_tables(events)
    indexed = checkpointed(ml.index_pairs(pairs.select("user_id", "item_id", "interaction_count")), "indexed")
    candidates = checkpointed(ml.als_candidates(ml.train_als(indexed), indexed, 100), "candidates")
    return rc.recommend_all(
        candidates, trained_ranker(pairs, users, items), pairs, users, items, ft.item_popularity(events),
        wn.popularity_percentile(events), item_categories(spark, root), 10,
    ).withColumn("score", F.round("score", 6))


_F = """
    WITH f AS (SELECT 'item_' || vec_id AS item_id, generate_subscripts(embedding, 1) - 1 AS i,
                      CAST(unnest(embedding) AS DOUBLE) AS y FROM embeddings)"""


@query("gram_matrix", _F + """
    SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(a.y * b.y), 6) AS value
    FROM f a JOIN f b ON a.item_id = b.item_id GROUP BY 1, 2""")
def gram_matrix(spark, root):
    return ml.gram_matrix(item_factors(spark, root)).withColumn("value", F.round("value", 6))


def _weighted(spark, root):
    return valid_events(spark, root).select(
        "user_id", "item_id", F.coalesce("rating", F.lit(1.0)).alias("rating"), "timestamp")


@query("fold_in_rhs", with_views("ev", _F + """
    , l AS (SELECT user_id, item_id, coalesce(rating, 1.0) AS r FROM ev
            QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, coalesce(rating, 1.0) DESC) = 1)
    SELECT user_id, CAST(i AS INTEGER) AS i, round(sum(r * y), 6) AS rhs FROM l JOIN f USING (item_id) GROUP BY 1, 2"""))
def fold_in_rhs(spark, root):
    df = ml.fold_in_rhs(_weighted(spark, root), item_factors(spark, root))
    return df.select("user_id", F.posexplode("rhs").alias("i", "rhs")).withColumn("rhs", F.round("rhs", 6))


# The normal equations solved in SQL: Gauss-Jordan elimination of the matrix G + reg I with the unit matrix beside it. The matrix is
# positive definite, so no rows change places.
@query("fold_in", with_views("ev", _F + """
    , l AS (SELECT user_id, item_id, coalesce(rating, 1.0) AS r FROM ev
            QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, coalesce(rating, 1.0) DESC) = 1),
    b AS (SELECT user_id, i, sum(r * y) AS rhs FROM l JOIN f USING (item_id) GROUP BY 1, 2),
    g AS (SELECT a.i AS i, c.i AS j, sum(a.y * c.y) + CASE WHEN a.i = c.i THEN CAST(0.1 AS DOUBLE) ELSE 0 END AS v
          FROM f a JOIN f c ON a.item_id = c.item_id GROUP BY 1, 2),
    k AS (SELECT max(i) + 1 AS k FROM g),
    m0 AS (SELECT i, list_concat(list(v ORDER BY j), list_transform(range((SELECT k FROM k)), lambda j: CASE WHEN j = i THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)) AS row
           FROM g GROUP BY i),
    m AS (SELECT 0 AS step, list(row ORDER BY i) AS m FROM m0
          UNION ALL
          SELECT step + 1, list_transform(m, lambda r, p: CASE WHEN p - 1 = step
                   THEN list_transform(r, lambda x: x / r[step + 1])
                   ELSE list_transform(list_zip(r, m[step + 1]), lambda z: z[1] - z[2] * r[step + 1] / m[step + 1][step + 1]) END)
          FROM m WHERE step < (SELECT k FROM k)),
    last AS (SELECT m FROM m WHERE step = (SELECT k FROM k)),
    inv AS (SELECT i, j, m[i + 1][(SELECT k FROM k) + j + 1] AS v FROM last, range((SELECT k FROM k)) a(i), range((SELECT k FROM k)) c(j))
    SELECT user_id, CAST(inv.i AS INTEGER) AS i, round(sum(inv.v * rhs), 6) AS value FROM b JOIN inv ON inv.j = b.i GROUP BY 1, 2""",
                             recursive=True))
def fold_in(spark, root):
    df = ml.fold_in(_weighted(spark, root), item_factors(spark, root))
    return df.select("user_id", F.posexplode("features").alias("i", "value")).withColumn("value", F.round("value", 6))


# New factors: each item's vector moved towards the mean vector of its label.
@query("embedding_shift", """
    WITH f AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS y FROM embeddings),
    m AS (SELECT label, i, avg(y) AS my FROM f GROUP BY 1, 2),
    n AS (SELECT vec_id, y, CAST(0.5 AS DOUBLE) * y + CAST(0.5 AS DOUBLE) * my AS z FROM f JOIN m USING (label, i))
    SELECT 'item_' || vec_id AS item_id, round(sum(y * z) / (sqrt(sum(y * y)) * sqrt(sum(z * z))), 6) AS cosine
    FROM n GROUP BY vec_id""")
def embedding_shift(spark, root):
    base = table(spark, root, "embeddings").select(
        F.concat(F.lit("item_"), F.col("vec_id").cast("string")).alias("item_id"), "label",
        F.col("embedding").cast("array<double>").alias("features"))
    mean = base.select("label", F.posexplode("features").alias("i", "y")).groupBy("label", "i").agg(F.avg("y").alias("y"))
    # One entry per factor dimension.
    means = mean.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "y"))).alias("m"))
    half = F.zip_with("features", "m", lambda y, m: F.lit(0.5) * y + F.lit(0.5) * m["y"])
    moved = base.join(means, "label").select("item_id", half.alias("features"))
    return ml.embedding_shift(base, moved, "item_id").withColumn("cosine", F.round("cosine", 6))


# The night's retrain: a model fitted on the log up to the evening is carried on with the whole log. SQL knows which users have
# changed, and what must hold of any fit: sweeps lower the loss, and three warm ones end below three cold ones.
_EVENING = "2024-01-30 18:00:00"


@query("warm_retrain", with_views("ev", f"""
    SELECT 'als' AS model, 'promote' AS decision, true AS falling, true AS below_cold,
           (SELECT count(DISTINCT user_id) FROM ev WHERE ts >= TIMESTAMP '{_EVENING}') AS solved_first,
           (SELECT count(DISTINCT item_id) FROM ev) AS items"""))
def warm_retrain(spark, root):
    rank, options = 16, {"sweeps": 3, "bound": 0.0}
    events = valid_events(spark, root)
    pairs = checkpointed(pair_counts(spark, root), "pairs")
    before = checkpointed(events.where(F.col("timestamp") < F.lit(_EVENING).cast("timestamp")).groupBy("user_id", "item_id").agg(
        F.count("*").alias("interaction_count")), "pairs")
    old = wm.cold_fit(before, rank, **options)
    warmed = wm.warm_fit(pairs, old.users, old.items, wm.changed_users(pairs, before), rank=rank, **options)
    cold = wm.cold_fit(pairs, rank, **options)
    falling = all(b <= a + 1e-6 for a, b in zip(warmed.losses, warmed.losses[1:], strict=False))
    decided = ml.promotion_decision(wm.fit_metrics("als", cold), wm.fit_metrics("als", warmed), "negative_loss")
    return decided.select("model", "decision", F.lit(falling).alias("falling"), F.lit(warmed.losses[-1] < cold.losses[-1]).alias("below_cold"),
                          F.lit(warmed.solved_first).cast("bigint").alias("solved_first"),
                          F.lit(warmed.items.count()).cast("bigint").alias("items"))


# Metric tables of two versions per market segment: mean balance of all customers, and of those with open orders. Metrics
# are rounded when they are recorded, so equal ones compare as equal.
@query("promotion_decision", """
    WITH cur AS (SELECT c_mktsegment AS model, round(avg(c_acctbal), 6) AS v FROM customer GROUP BY 1),
    cand AS (SELECT c_mktsegment AS model, round(avg(c_acctbal), 6) AS v FROM customer WHERE c_custkey IN
             (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1)
    SELECT cand.model, cand.v AS candidate_value, cur.v AS current_value,
           CASE WHEN cur.v IS NULL OR cand.v > cur.v THEN 'promote' ELSE 'keep' END AS decision
    FROM cand LEFT JOIN cur USING (model)""")
def promotion_decision(spark, root):
    c = table(spark, root, "customer").select("c_custkey", F.col("c_mktsegment").alias("model"), "c_acctbal")
    busy = table(spark, root, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))

    def measured(df):
        return df.groupBy("model").agg(F.round(F.avg("c_acctbal"), 6).alias("value")).withColumn("metric_name", F.lit("ndcg"))

    out = ml.promotion_decision(measured(c), measured(c.join(busy, "c_custkey", "left_semi")), "ndcg")
    return out.select("model", "candidate_value", "current_value", "decision")
