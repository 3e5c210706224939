"""Ranking metrics over all users at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import jaccard
from rillmark.operators.scale import running_total, value_pieces
from rillmark.session import checkpointed

# Up to this many categories per item, `list_diversity` counts category subsets; lists with a wider item compare their
# distinct category sets instead.
SUBSET_CATEGORIES = 8


def _marked_hits(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    truth = actuals.select("user_id", "item_id").distinct().withColumn("hit", F.lit(1))
    return preds.select("user_id", "item_id", "rank").join(truth, ["user_id", "item_id"], "left").withColumn(
        "hit", F.coalesce("hit", F.lit(0)))


def _actual_counts(actuals: DataFrame) -> DataFrame:
    return actuals.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count("*").alias("n_actual"))


def evaluate(preds: DataFrame, actuals: DataFrame, k: int = 10) -> DataFrame:
    """NDCG, precision and recall at ``k`` per user. ``preds``: user_id, item_id, 1-based rank."""
    top = _marked_hits(preds.where(F.col("rank") <= k), actuals)
    found = top.groupBy("user_id").agg(
        F.sum("hit").alias("hits"), F.count("*").alias("listed"),
        F.sum(F.col("hit") / F.log2(F.col("rank") + F.lit(1.0))).alias("dcg"))
    both = found.join(_actual_counts(actuals), "user_id", "full")
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_actual").cast("int"), F.lit(k))), F.lit(0.0),
                        lambda acc, r: acc + F.lit(1.0) / F.log2(r + F.lit(1.0)))

    def ratio(num: str, den: Column) -> Column:
        return F.coalesce(F.when(den > 0, F.col(num) / den), F.lit(0.0))

    return both.select(
        "user_id",
        F.coalesce(F.when(F.col("n_actual") > 0, F.col("dcg") / ideal), F.lit(0.0)).alias("ndcg"),
        ratio("hits", F.col("listed")).alias("precision"),
        ratio("hits", F.col("n_actual")).alias("recall"),
    )


def average_precision(preds: DataFrame, actuals: DataFrame, rank_step: int = 10_000) -> DataFrame:
    """Average precision over the whole list, for users with actuals.

    Only hits matter, so hits are kept and numbered; the numbering runs in rank ranges, not over a whole list.
    """
    truth = actuals.select("user_id", "item_id").distinct()
    hits = preds.select("user_id", "item_id", "rank").join(truth, ["user_id", "item_id"]).withColumn(
        "_b", F.floor(F.col("rank") / rank_step))
    numbered = running_total(hits, ["user_id"], "_b", ["rank"], F.lit(1), "cum_hits")
    gained = numbered.groupBy("user_id").agg(F.sum(F.col("cum_hits") / F.col("rank")).alias("gain"))
    return _actual_counts(actuals).join(gained, "user_id", "left").select(
        "user_id", (F.coalesce("gain", F.lit(0.0)) / F.col("n_actual")).alias("average_precision"))


def mean_ap(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    """Mean of the average precision over users with actuals; 0 without any."""
    ap = average_precision(preds, actuals)
    return ap.groupBy().agg(
        F.coalesce(F.avg("average_precision"), F.lit(0.0)).alias("map_score"), F.count("*").alias("users"))


def coverage(preds: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Share of the catalogue recommended at least once."""
    shown = preds.select("item_id").distinct().withColumn("_shown", F.lit(1))
    items = catalogue.select("item_id").distinct()
    return items.join(shown, "item_id", "left").groupBy().agg(
        F.count("_shown").alias("recommended"), F.count("*").alias("catalogue")
    ).withColumn("coverage", F.when(F.col("catalogue") > 0, F.col("recommended") / F.col("catalogue"))
                 .otherwise(F.lit(0.0)))


def list_diversity(preds: DataFrame) -> DataFrame:
    """Mean of (1 - category Jaccard) over all item pairs of each user's list; 1 for lists of fewer than two.

    ``preds``: user_id, item_id, categories. No pairs are formed. With n(S, a) the number of list items that have a
    categories and contain the category set S, the number of item pairs sharing at least S is n(S, a) * n(S, b);
    inclusion-exclusion turns these into the number sharing exactly c categories, and the Jaccard of such a pair is
    c / (a + b - c). Everything is therefore a weighted sum of products of counts, linear in the list length.

    Subsets grow with 2^categories, so lists that hold an item of many categories take another exact way: their
    distinct category sets, with counts, are compared with each other.
    """
    cats = F.array_sort(F.array_distinct(F.coalesce("categories", F.array().cast("array<string>"))))
    sized = preds.select("user_id", cats.alias("_cats")).withColumn("_a", F.size("_cats"))
    # Equal category sets are counted together first, and stored, as several branches read them.
    counted = checkpointed(sized.groupBy("user_id", "_cats", "_a").agg(F.count("*").alias("_n")), "category-sets")
    totals = counted.groupBy("user_id").agg(
        F.sum("_n").alias("n"), F.sum(F.when(F.col("_a") > 0, F.col("_n")).otherwise(0)).alias("_self"),
        F.max("_a").alias("_widest"))
    wide_users = totals.where(F.col("_widest") > SUBSET_CATEGORIES).select("user_id")
    narrow = counted.join(wide_users, "user_id", "left_anti")
    wide = counted.join(wide_users, "user_id", "left_semi")
    start = F.array(F.array().cast("array<string>"))
    subsets = F.aggregate("_cats", start, lambda acc, c: F.concat(
        acc, F.transform(acc, lambda s: F.concat(s, F.array(c)))))
    by_set = narrow.withColumn("_s", F.explode(subsets)).where(F.size("_s") > 0).groupBy("user_id", "_s", "_a").agg(
        F.sum("_n").cast("double").alias("_n"))
    # At most SUBSET_CATEGORIES sizes per set.
    sizes = by_set.groupBy("user_id", "_s").agg(F.collect_list(F.struct(F.col("_a").alias("a"), F.col("_n").alias("n"))).alias("_l"))
    j = F.size("_s")

    def weight(a: Column, b: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), j), F.lit(0.0), lambda acc, c: acc + F.when(
            (j - c) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
            * F.factorial(j) / (F.factorial(c) * F.factorial(j - c)) * c / (a + b - c))

    similarity = F.aggregate("_l", F.lit(0.0), lambda acc, x: acc + F.aggregate(
        "_l", F.lit(0.0), lambda inner, y: inner + x["n"] * y["n"] * weight(x["a"], y["a"])))
    distinct = wide.groupBy("user_id").agg(F.collect_list(F.struct("_cats", F.col("_n").cast("double").alias("n"))).alias("_l"))
    compared = F.aggregate("_l", F.lit(0.0), lambda acc, x: acc + F.aggregate(
        "_l", F.lit(0.0), lambda inner, y: inner + x["n"] * y["n"] * jaccard(x["_cats"], y["_cats"])))
    shared = sizes.groupBy("user_id").agg(F.sum(similarity).alias("_sim")).unionByName(
        distinct.select("user_id", compared.alias("_sim")))
    pairs = F.col("n") * (F.col("n") - 1) / F.lit(2.0)
    alike = (F.coalesce("_sim", F.lit(0.0)) - F.col("_self")) / 2
    return totals.join(shared, "user_id", "left").select(
        "user_id", "n", F.when(F.col("n") < 2, F.lit(1.0)).otherwise(F.lit(1.0) - alike / pairs).alias("diversity"))


def auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve by rank sums, ties counted half.

    Scores are counted first and cut into value ranges, so the ranks come from running counts inside ranges instead of
    one global sort.
    """
    hist = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    ranked = running_total(value_pieces(hist, score, "_b"), [], "_b", [score], F.col("_neg"), "_cum")
    wins = F.col("_pos") * (F.col("_cum") - F.col("_neg") / F.lit(2.0))
    return ranked.groupBy().agg(
        F.sum(wins).alias("_u"), F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives")
    ).select("positives", "negatives",
             (F.col("_u") / F.nullif(F.col("positives") * F.col("negatives").cast("double"), F.lit(0.0))).alias("auc"))
