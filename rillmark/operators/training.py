"""Training sets: positives, sampled negatives, splits and folds, all repeatable by hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import hex_int, sha_hex, sha_int
from rillmark.operators.scale import dense_index
from rillmark.session import checkpointed
from rillmark.sources.store import write_versioned

# Columns of the user and item tables that collide get these suffixes.
SHARED = ("total_views", "total_clicks")
# Values a sampled negative has in place of pair features.
NO_PAIR = {"interaction_count": 0, "last_interaction_type": "none", "time_since_last_interaction": -1.0,
           "user_item_rating": None}
# Primes just below 2^31, the steps of the users' permutations.
STEPS = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)
MOST_ITEMS = STEPS[-1] - 1
SLICE = 4096  # places of one user that are counted out at once
OFFERED = 4_000_000  # places that one task counts out
LISTED = 1 << 18  # items of an index that may be broadcast


def with_features(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Left-join user and item features to pairs; colliding names get ``_user`` / ``_item``.

    No broadcast hint: feature tables grow with the data, so the runtime sizes decide, and skewed users are split by
    adaptive execution.
    """
    u = users.select(*[F.col(c).alias(f"{c}_user") if c in SHARED else F.col(c) for c in users.columns])
    i = items.select(*[F.col(c).alias(f"{c}_item") if c in SHARED else F.col(c) for c in items.columns])
    return pairs.join(u, "user_id", "left").join(i, "item_id", "left")


def positives(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    return with_features(pairs, users, items).withColumn("label", F.lit(1))


def sample_negatives(pairs: DataFrame, items: DataFrame | None = None, ratio: int = 4, seed: int = 42) -> DataFrame:
    """Distinct unobserved (user, item) pairs: ``ratio`` for each pair of a user, or all that are left if there are fewer.

    Items are numbered 0..n-1. Every user has a permutation of the numbers, place * step + start modulo n, with step (a prime
    above n, so without a common factor) and start from a SHA-256 of user and seed. Of the first (ratio + 1) * m places of a
    user with m pairs at most m are observed items; these are dropped, and the first ratio * m of the rest are kept. The inverse of
    step gives the place of an observed pair, so only observed places are shuffled, by slices of SLICE places, and the kept ones are
    counted out from the number of observed places before their slice. ``items`` defaults to the items of the pairs.
    """
    spark = pairs.sparkSession
    pairs = checkpointed(pairs.select("user_id", "item_id").distinct(), "pairs")
    indexed = checkpointed(dense_index(pairs if items is None else items, "item_id", "idx"), "item-index")
    n = indexed.count()
    if n > MOST_ITEMS:
        raise ValueError(f"{n} items; the permutation is made for {MOST_ITEMS} at most")
    modulus = max(n, 1)
    key = sha_hex("user_id", F.lit(str(seed)))
    kind = (hex_int(key, 1) % len(STEPS) + 1).cast("int")
    users = pairs.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("m")).select(
        "user_id", "m", F.least(F.col("m") * (ratio + 1), F.lit(n)).alias("end"), kind.alias("kind"),
        (hex_int(key, 9) % modulus).alias("start"))
    users = checkpointed(users.where("end > 0"), "permutations")

    inverse = F.element_at(F.array(*[F.lit(pow(p, -1, modulus)) for p in STEPS]), F.col("kind"))
    place = F.pmod(F.col("idx") - F.col("start"), F.lit(modulus)) * inverse % modulus
    slice_of = F.expr(f"place div {SLICE}")
    observed = pairs.join(indexed, "item_id").join(users, "user_id").select("user_id", "end", place.alias("place")).where("place < end")
    observed = observed.groupBy("user_id", slice_of.alias("slice")).agg(F.sort_array(F.collect_list("place")).alias("seen"))
    observed = checkpointed(observed, "observed-places")

    step = F.element_at(F.array(*[F.lit(p) for p in STEPS]), F.col("kind"))
    slices = users.select("user_id", "m", "end", step.alias("step"), "start",
                          F.explode(F.expr(f"sequence(0L, (end - 1) div {SLICE})")).alias("slice"))
    earlier = Window.partitionBy("user_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("c").over(earlier), F.lit(0))
    slices = slices.join(observed.select("user_id", "slice", F.size("seen").alias("c")), ["user_id", "slice"], "left").withColumn(
        "left", F.col("m") * ratio - (F.col("slice") * SLICE - before)).where("left > 0")
    # an explicit number of tasks: what is small here becomes ratio rows for each pair
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() * (ratio + 1) // OFFERED))
    slices = slices.repartition(parts, "user_id", "slice").join(observed, ["user_id", "slice"], "left")
    places = F.expr(f"sequence(slice * {SLICE}, least(end, (slice + 1) * {SLICE}) - 1)")
    unseen = F.when(F.col("seen").isNull(), places).otherwise(F.array_except(places, "seen"))
    kept = slices.select("user_id", "step", "start", F.explode(F.slice(unseen, F.lit(1), F.least("left", F.lit(SLICE)).cast("int"))).alias("place"))
    kept = kept.select("user_id", ((F.col("place") * F.col("step") + F.col("start")) % modulus).alias("idx"))
    # a share of the index is far smaller than the same share of the rows, which then need no order
    return kept.join(indexed.hint("shuffle_hash") if n > LISTED else indexed, "idx").select("user_id", "item_id")


def negatives_with_features(negatives: DataFrame, users: DataFrame, items: DataFrame, like: DataFrame) -> DataFrame:
    """Negatives joined to features and aligned by name with the positives ``like``."""
    types = {f.name: f.dataType for f in like.schema.fields}
    fills = {c: F.lit(v).cast(types[c]) for c, v in NO_PAIR.items()}
    return with_features(negatives, users, items).withColumns(fills).withColumn("label", F.lit(0)).select(*like.columns)


def build_training_set(
    pairs: DataFrame, users: DataFrame, items: DataFrame, ratio: int = 4, seed: int = 42
) -> DataFrame:
    """Positives and sampled negatives with features and ``label``."""
    pos = positives(pairs, users, items)
    neg = negatives_with_features(sample_negatives(pairs, items, ratio, seed), users, items, pos)
    return pos.unionByName(neg)


def split_name(keys: Sequence[str], weights: Sequence[int] = (80, 10, 10), seed: int = 42) -> Column:
    """train / validation / test by hash of the keys: same row, same set, on every run and cluster."""
    h = sha_int(*keys, F.lit(str(seed))) % sum(weights)
    return F.when(h < weights[0], "train").when(h < weights[0] + weights[1], "validation").otherwise("test")


def split(df: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), weights=(80, 10, 10), seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_name(keys, weights, seed))


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Repeatable sample of keys: a row stays when its hash falls in the given fraction."""
    return df.where(sha_int(*keys, F.lit(str(seed))) < F.lit(int(fraction * 2**32)))


def hash_folds(df: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), k: int = 5) -> DataFrame:
    """Fold number 0..k-1 by hash. Folds are balanced per label in expectation."""
    return df.withColumn("fold", (sha_int(*keys, F.lit("fold")) % k).cast("int"))


def write_training_set(
    pairs: DataFrame, users: DataFrame, items: DataFrame, root: str, version: str, ratio: int = 4, seed: int = 42
) -> str:
    """Build, split and write one dataset version, with one folder per set.

    The set is computed once into the shared scratch folder; the three writes read it from there.
    """
    full = checkpointed(split(build_training_set(pairs, users, items, ratio, seed), seed=seed), "training-set")
    path = f"{root.rstrip('/')}/version={version}"
    full.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


__all__ = [
    "build_training_set", "hash_folds", "hash_sample", "negatives_with_features", "positives", "sample_negatives", "split",
    "split_name", "with_features", "write_training_set", "write_versioned",
]
