"""Imports the plan modules, which register their queries."""

from rillmark.plans import (  # noqa: F401
    event_plans,
    experiment_plans,
    feature_plans,
    model_plans,
    quality_plans,
    ranking_plans,
    stream_plans,
    training_plans,
    window_plans,
)
