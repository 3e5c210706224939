"""Queries over training sets."""

from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import training as tr
from rillmark.plans.event_plans import AS_OF, order_interactions, valid_events
from rillmark.plans.registry import query, with_views
from rillmark.schemas import ITEM_FEATURES, PAIR_FEATURES, USER_FEATURES
from rillmark.session import scratch_dir
from rillmark.sources.store import scan_features, write_features

SEED = 42


def feature_tables(df):
    """Pair, user and item features, written to a feature store and read from there in their schemas."""
    spark, root = df.sparkSession, scratch_dir(df.sparkSession, "feature-store")
    kinds = {"interaction_features": (ft.pair_features(df, AS_OF), PAIR_FEATURES),
             "user_features": (ft.user_features(df), USER_FEATURES), "item_features": (ft.item_features(df), ITEM_FEATURES)}
    for kind, (table, schema) in kinds.items():
        write_features(table.select(*schema.names), f"{root}/{kind}")
    return tuple(scan_features(spark, root, kind, schema) for kind, (_, schema) in kinds.items())


_H = "CAST(('0x' || substr({h}, {at}, 8)) AS BIGINT)"


def _negatives_ctes(view):
    """Pairs p and sampled negatives neg, from one view of events: all places of every user's permutation, in order."""
    key = f"sha256(concat_ws(':', user_id, '{SEED}'))"
    step = f"({list(tr.STEPS)})[1 + {_H.format(h=key, at=1)} % {len(tr.STEPS)}]::BIGINT"
    return f"""
    p AS (SELECT DISTINCT user_id, item_id FROM {view}),
    n AS (SELECT item_id, row_number() OVER (ORDER BY sha256(item_id)) - 1 AS idx
          FROM (SELECT DISTINCT item_id FROM p)),
    u AS (SELECT user_id, count(*) AS m, {step} AS step, {_H.format(h=key, at=9)} AS start FROM p GROUP BY user_id),
    pl AS (SELECT user_id, m, place, (place * step + start % (SELECT count(*) FROM n)) % (SELECT count(*) FROM n) AS idx
           FROM u, range((SELECT count(*) FROM n)) t(place)),
    c AS (SELECT pl.user_id, n.item_id, m, place FROM pl JOIN n ON pl.idx = n.idx ANTI JOIN p
          ON p.user_id = pl.user_id AND p.item_id = n.item_id),
    neg AS (SELECT user_id, item_id FROM c
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY place) <= 4 * m)"""


@query("negatives", with_views("ev", f"WITH {_negatives_ctes('ev')} SELECT user_id, item_id FROM neg"))
def negatives(spark, root):
    df = valid_events(spark, root)
    return tr.sample_negatives(df, None, 4, SEED)


@query("negatives_orders", with_views("li", f"WITH {_negatives_ctes('li')} SELECT user_id, item_id FROM neg"))
def negatives_orders(spark, root):
    df = order_interactions(spark, root)
    return tr.sample_negatives(df, None, 4, SEED)


_FEATURES = f"""
    uf AS (SELECT user_id, count(*) AS total_interactions, count(*) FILTER (event_type = 'view') AS total_views_user,
                  count(*) FILTER (event_type = 'click') AS total_clicks_user, avg(rating) AS avg_rating_given,
                  count(*) FILTER (event_type = 'rating') AS total_ratings, count(DISTINCT CAST(ts AS DATE)) AS interaction_days
           FROM ev GROUP BY 1),
    itf AS (SELECT item_id, count(*) FILTER (event_type = 'view') AS total_views_item,
                   count(*) FILTER (event_type = 'click') AS total_clicks_item, avg(rating) AS avg_rating_received,
                   count(rating) AS rating_count,
                   CASE WHEN count(*) FILTER (event_type = 'view') > 0
                        THEN count(*) FILTER (event_type = 'click') / CAST(count(*) FILTER (event_type = 'view') AS DOUBLE)
                        ELSE 0 END AS click_through_rate
            FROM ev GROUP BY 1),
    o AS (SELECT *, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS sig FROM ev),
    la AS (SELECT user_id, item_id, event_type, ts FROM o
           QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, sig DESC) = 1),
    pf AS (SELECT ev.user_id, ev.item_id, count(*) AS interaction_count, any_value(la.event_type) AS last_interaction_type,
                  any_value((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(la.ts)) / CAST(3600000000 AS DOUBLE))
                    AS time_since_last_interaction, avg(rating) AS user_item_rating
           FROM ev JOIN la ON ev.user_id = la.user_id AND ev.item_id = la.item_id GROUP BY 1, 2)"""

_OUT = ["user_id", "item_id", "interaction_count", "last_interaction_type", "time_since_last_interaction",
        "user_item_rating", "total_interactions", "total_views_user", "total_clicks_user", "avg_rating_given",
        "total_views_item", "total_clicks_item", "avg_rating_received", "rating_count", "total_ratings", "interaction_days",
        "click_through_rate", "label"]
_ROUND = {"time_since_last_interaction", "user_item_rating", "avg_rating_given", "avg_rating_received", "click_through_rate"}
_SQL_OUT = ", ".join(f"round({c}, 6) AS {c}" if c in _ROUND else c for c in _OUT)


def _out(df):
    return df.select(*[F.round(c, 6).alias(c) if c in _ROUND else F.col(c) for c in _OUT])


@query("positives", with_views("ev", f"""
    WITH {_FEATURES}, x AS (SELECT *, 1 AS label FROM pf LEFT JOIN uf USING (user_id) LEFT JOIN itf USING (item_id))
    SELECT {_SQL_OUT} FROM x"""))
def positives(spark, root):
    return _out(tr.positives(*feature_tables(valid_events(spark, root))))


_TRAINING = f"""
    WITH {_FEATURES}, {_negatives_ctes('ev')},
    x AS (SELECT pf.*, 1 AS label FROM pf
          UNION ALL
          SELECT user_id, item_id, 0, 'none', CAST(-1 AS DOUBLE), NULL, 0 FROM neg),
    y AS (SELECT * FROM x LEFT JOIN uf USING (user_id) LEFT JOIN itf USING (item_id))"""


@query("training_set", with_views("ev", f"{_TRAINING} SELECT {_SQL_OUT} FROM y"))
def training_set(spark, root):
    return _out(tr.build_training_set(*feature_tables(valid_events(spark, root)), seed=SEED))


_MATRIX = ["total_interactions", "total_clicks_user", "total_views_user", "avg_rating_given", "total_views_item",
           "total_clicks_item", "avg_rating_received", "rating_count", "interaction_count",
           "time_since_last_interaction", "user_item_rating", "total_ratings", "interaction_days", "click_through_rate"]
_MATRIX_SQL = ", ".join(
    f"round(coalesce({c}, 0), 6) AS {c}" if c in _ROUND else f"coalesce({c}, 0) AS {c}" for c in _MATRIX)


@query("ranking_matrix", with_views("ev", f"{_TRAINING} SELECT user_id, item_id, label, {_MATRIX_SQL} FROM y"))
def ranking_matrix(spark, root):
    df = tr.build_training_set(*feature_tables(valid_events(spark, root)), seed=SEED)
    df = ft.impute(df, _MATRIX, 0)
    return df.select("user_id", "item_id", "label", *[F.round(c, 6).alias(c) if c in _ROUND else c for c in _MATRIX])


def _h(*parts):
    return _H.format(h=f"sha256(concat_ws(':', {', '.join(parts)}))", at="1")


@query("split_sets", with_views("li", f"""
    WITH {_negatives_ctes('li')}, x AS (SELECT *, 1 AS label FROM p UNION ALL SELECT *, 0 FROM neg),
    s AS (SELECT *, {_h('user_id', 'item_id', "'42'")} % 100 AS b FROM x)
    SELECT CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'validation' ELSE 'test' END AS split, label,
           count(*) AS pairs FROM s GROUP BY 1, 2"""))
def split_sets(spark, root):
    df = order_interactions(spark, root)
    pos = df.select("user_id", "item_id").distinct().withColumn("label", F.lit(1))
    neg = tr.sample_negatives(df, None, 4, SEED).withColumn("label", F.lit(0))
    return tr.split(pos.unionByName(neg), seed=SEED).groupBy("split", "label").agg(F.count("*").alias("pairs"))


@query("fold_sizes", with_views("li", f"""
    WITH p AS (SELECT DISTINCT user_id, item_id FROM li)
    SELECT CAST({_h('user_id', 'item_id', "'fold'")} % 5 AS INTEGER) AS fold, count(*) AS pairs FROM p GROUP BY 1"""))
def fold_sizes(spark, root):
    pairs = order_interactions(spark, root).select("user_id", "item_id").distinct()
    return tr.hash_folds(pairs).groupBy("fold").agg(F.count("*").alias("pairs"))


@query("hash_sample", with_views("li", f"""
    SELECT DISTINCT user_id FROM li WHERE {_h('user_id', "'42'")} < CAST(floor(0.1 * 4294967296) AS BIGINT)"""))
def hash_sample(spark, root):
    return tr.hash_sample(order_interactions(spark, root).select("user_id").distinct(), ["user_id"], 0.1, SEED)
