"""Quality rules (operator 1): hashed n-gram log-likelihood ratio of trusted target against raw corpus, natively in Spark."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import words

BUCKETS = 10_000
UNIT = 1_000_000  # weights are whole millionths of a nat, so that sums do not depend on their order


def _covered(places: Column) -> Column:
    """Number of words in the three-word windows that begin at these (sorted) places."""
    steps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))),
                       lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, n: total + n)


def base_signals(docs: DataFrame) -> DataFrame:
    """Add w (words), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to (doc_id, text).

    Repeated windows are found by sorting 64-bit hashes of a text's own windows; only texts that have one are sorted.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("w", words(F.col("text")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({
        "n_words": F.size("w").cast("bigint"), "word_chars": F.length(F.array_join("w", "")).cast("bigint"),
        "n_symbols": F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("bigint"), "_lines": lines,
        "_grams": F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))), 1,
                          F.greatest(F.size("w") - 2, F.lit(0)))})
    again = F.size("_grams") > F.size(F.array_distinct("_grams"))
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")).drop("_lines")
    placed = F.sort_array(F.transform("_grams", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    none = F.array().cast("array<struct<v:bigint,i:int>>")
    rows = rows.withColumn("_sorted", F.when(again, placed).otherwise(none)).drop("_grams")
    same = F.zip_with("_sorted", F.slice("_sorted", 2, F.greatest(F.size("_sorted"), F.lit(1))),
                      lambda a, b: F.coalesce(a["v"] == b["v"], F.lit(False)))
    rows = rows.withColumn("_same", same)
    before = F.concat(F.array(F.lit(False)), F.col("_same"))
    either = F.zip_with(F.zip_with("_same", before, lambda a, b: F.coalesce(a, F.lit(False)) | b), "_sorted",
                        lambda hit, s: F.when(hit, s["i"]))
    rows = rows.withColumn("_at", F.sort_array(F.filter(either, lambda i: i.isNotNull()))).drop("_sorted", "_same")
    rows = rows.withColumn("n_repeat_words", _covered(F.col("_at")).cast("bigint")).drop("_at")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _buckets(w: str) -> Column:
    """Hash buckets of the words and word pairs of a text."""
    ones = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
    pairs = F.transform(w, lambda x, i: F.pmod(F.xxhash64(x, F.get(w, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(ones, F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(0))))


def ratio_weights(docs: DataFrame, trusted: DataFrame, most: int = 20_000) -> list[int]:
    """ln(target share / raw share) of every bucket in millionths, add-one smoothed.

    Raw counts are of all documents. The target model is fitted on at most ``most`` of the ids in ``trusted`` (doc_id), those
    with the least hash: so few ids can be broadcast at any size of the tables, and no text is shuffled to find them.
    Counting sums in each task first; BUCKETS pairs of numbers reach the driver.
    """
    marks = trusted.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(most).withColumn("_target", F.lit(1))
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select(words(F.col("text")).alias("w"), F.coalesce("_target", F.lit(0)).alias("t"))
    counts = rows.select("t", F.explode(_buckets("w")).alias("b")).groupBy("b").agg(
        F.count("*").alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for r in counts:
        raw[r.b] += r.raw
        target[r.b] += r.target
    if sum(target) == BUCKETS:
        return [0] * BUCKETS
    off = math.log(sum(raw) / sum(target))
    return [round(UNIT * (math.log(target[b] / raw[b]) + off)) for b in range(BUCKETS)]


def quality(docs: DataFrame, trusted: DataFrame, threshold: float = -0.035) -> DataFrame:
    """Base signals and verdict of every document; one row per row of ``docs`` with (doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, llr, kept).

    llr is the log-likelihood ratio of a text's words and word pairs between the trusted target and the raw corpus, divided by
    their number; kept is llr >= threshold for every document that passes the base rules. Null, empty and blank texts have
    no words, llr 0 and fail the base rules. If nothing is trusted every llr is 0. Repeated rows and ids are scored alike;
    a null doc_id is never trusted but is scored; other columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    weights = ratio_weights(docs, trusted)
    known = F.from_json(F.lit(json.dumps(weights)), "array<bigint>")
    rows = base_signals(docs).withColumn("_b", _buckets("w"))
    total = F.aggregate("_b", F.lit(0).cast("bigint"), lambda s, b: s + F.get(known, b))
    rows = rows.withColumn("llr", F.coalesce(F.try_divide(total, F.size("_b") * F.lit(float(UNIT))), F.lit(0.0)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr",
                       (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"))
