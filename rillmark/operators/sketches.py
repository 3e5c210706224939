"""Event reports that merge: counts add up, distinct users and items are HyperLogLog sketches kept as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import is_type

BITS = 12  # 2^12 registers a sketch: a standard error of some 1.6 %, 4 KB at most
KINDS = ("view", "click", "rating")  # Fixed value: the valid types of events
_SUMS = ("received", "valid", "invalid", *KINDS)
_SKETCHES = ("users", "items")


def report_parts(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per value of ``by`` (or one in all): events received, valid, invalid and of each type, and sketches of the users
    and items of valid events. ``checked`` has events with a column ``valid``; it is read once, and tasks combine before the shuffle.
    """
    ok = F.col("valid")
    aggs = [F.count("*").alias("received"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid")]
    aggs += [F.count_if(ok & is_type(k)).alias(k) for k in KINDS]
    aggs += [F.hll_sketch_agg(F.when(ok, F.col(c)), F.lit(BITS)).alias(name) for name, c in zip(_SKETCHES, ("user_id", "item_id"), strict=True)]
    return checked.groupBy(*by).agg(*aggs)


def merged_parts(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Parts of batches, windows or days put together: sums, and unions of the sketches."""
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _SUMS], *[F.hll_union_agg(c).alias(c) for c in _SKETCHES])


def report_of(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report of merged parts with estimated distinct counts: ``by``, counts, unique_users, unique_items, shares in per cent."""
    shares = [F.coalesce(F.col(k) * 100.0 / F.nullif(F.col("received"), F.lit(0)), F.lit(0.0)).alias(f"share_{k}") for k in KINDS]
    return merged_parts(parts, by).select(
        *by, *_SUMS, *[F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(f"unique_{c}") for c in _SKETCHES], *shares)
