"""Record layouts: topic events, served recommendations and feature tables."""

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# JSON body of the user-event topic. Both producers' shapes are accepted: the second one sends
# `received_at` and `context` in place of `timestamp` and `metadata`. Objects read as string keep their JSON text.
EVENT_JSON = _struct(
    event_id=_S, user_id=_S, item_id=_S, event_type=_S, rating=_D,
    timestamp=_S, metadata=_S, received_at=_S, context=_S,
)

# A user event after normalisation.
EVENT = _struct(
    event_id=_S, user_id=_S, item_id=_S, event_type=_S, rating=_D, timestamp=_TS, metadata=_S,
)

# JSON body of the served-recommendation topic.
SERVED_JSON = _struct(
    event_id=_S, user_id=_S, recommended_items=T.ArrayType(_S), model_version=_S, experiment_group=_S,
    experiment_id=_S, timestamp=_S, latency_ms=_D, metadata=_S,
)

USER_FEATURES = _struct(
    user_id=_S, total_interactions=_L, total_clicks=_L, total_views=_L, total_ratings=_L, avg_rating_given=_D,
    interaction_days=_L, favorite_categories=T.ArrayType(_S), last_active_timestamp=_TS,
)

ITEM_FEATURES = _struct(
    item_id=_S, total_views=_L, total_clicks=_L, click_through_rate=_D, avg_rating_received=_D, rating_count=_L,
    category=_S, created_timestamp=_TS,
)

PAIR_FEATURES = _struct(
    user_id=_S, item_id=_S, interaction_count=_L, last_interaction_type=_S, time_since_last_interaction=_D,
    user_item_rating=_D,
)

STREAM_FEATURES = _struct(
    user_id=_S, item_id=_S, user_event_count_1h=_L, user_event_count_24h=_L, item_popularity_1h=_L,
    user_last_event_time=_TS, user_avg_rating=_D, window_start=_TS, window_end=_TS,
)

# Tables of the experiment service. A name is given once; a user has one assignment per experiment.
EXPERIMENT = _struct(
    experiment_id=_S, name=_S, description=_S, status=_S, traffic_percentage=T.IntegerType(), control_version=_S,
    treatment_version=_S, created_at=_TS, updated_at=_TS,
)

ASSIGNMENT = _struct(user_id=_S, experiment_id=_S, group=_S, assigned_at=_TS)

METRIC = _struct(experiment_id=_S, group=_S, metric_name=_S, metric_value=_D, timestamp=_TS)
