"""Mixing sources to target weights by weighted fair queueing (operator 9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import WORD, fresh_names, stored
from rillmark.operators.scale import running_total

STEPS = 1 << 15  # slices of virtual time up to the expected end of the mix


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _lot(seed: int) -> Column:
    """Place of a document in its source's shuffled order; the same in every run."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """(source, source_size, weight, target) for every source; one row per source is all the windows see. ``end`` is the virtual
    time at which the mix is expected to end.

    Sources by code point, null last, take the weights in turn. A target is weight * level, at most ``repeats`` times the
    source; the level is where the targets add up to ``share`` of all sizes (filled in order of cap / weight).
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(every) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    capped = sizes.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", (F.lit(repeats) * F.col("source_size")).cast("bigint"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    placed = capped.withColumn("level", level).withColumn("budget", budget)
    open_ = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), "level"))
    at = placed.withColumn("at", F.min(open_).over(Window.partitionBy())["level"])
    free = F.col("at").isNotNull() & (F.col("cap") / F.col("weight") > F.col("at"))
    end = F.coalesce("at", F.max(F.col("cap") / F.col("weight")).over(Window.partitionBy()))
    return at.select("source", "source_size", "weight", "budget", end.alias("end"),
                     F.when(free, F.col("weight") * F.col("at")).otherwise(F.col("cap").cast("double")).alias("target"))


def _place(seed: int) -> Column:
    """What decides a row's place in its source's order: lot and size, and where ids repeat the text and the place in the table.

    ``n`` only decides between rows that share doc_id, source and text, of which it does not matter which one is taken.
    """
    return F.struct(_lot(seed).alias("lot"), _size().alias("size"), F.xxhash64("text").alias("h"),
                    F.monotonically_increasing_id().alias("n"))


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    return stored(docs.select("doc_id", "source", _place(seed).alias("place")), "sizes")


def mix_plan(placed: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """One row per source: its size, weight, target, and for each pass the last place in its order that the mix takes.

    ``placed`` is a stored table of (source, place). Every source offers its shuffled documents ``repeats`` times over. A document's
    virtual finish time is the source's running total of words divided by its weight. All offers are sorted by finish
    time in range slices and cut where their running total would pass the budget. Running totals go by (source, slice of the hash)
    and by slice of virtual time, so a source with a third of all rows is spread; one partial sum per slice crosses them. Slices
    that begin beyond the budget, such as the one for all late offers, are dropped before they are sorted.
    """
    sized = placed.select("source", "place.*")
    total = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    targets = stored(source_targets(total, weights, share, repeats), "targets")
    ranked = sized.where("size > 0").withColumn("slice", F.substring("lot", 1, 3)).withColumn("_null", F.col("source").isNull())
    ranked = ranked.withColumn("source", F.coalesce("source", F.lit("")))
    ranked = running_total(ranked, ["source", "_null"], "slice", ["lot", "size", "h", "n"], F.col("size"), "done")
    ranked = ranked.withColumn("source", F.when(~F.col("_null"), F.col("source")))
    known = targets.withColumnRenamed("source", "_s")
    offers = ranked.join(known, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).select(
        "source", "lot", "size", "h", "n", "pass", "budget", "end",
        ((F.col("done") + F.col("pass") * F.col("source_size")) / F.col("weight")).alias("finish"))
    when = F.floor(F.least(F.try_divide("finish", "end"), F.lit(2.0)) * STEPS)
    offers = stored(offers.withColumn("when", F.coalesce(when, F.lit(2 * STEPS))).drop("end"), "offers")
    slices = offers.groupBy("when").agg(F.sum("size").alias("s"), F.max("budget").alias("budget"))
    base = F.coalesce(F.sum("s").over(Window.orderBy("when").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = slices.withColumn("base", base).where(F.col("base") <= F.col("budget")).groupBy().agg(F.max("when")).scalar()
    queue = running_total(offers.where(F.col("when") <= reached), [], "when",
                          ["finish", F.col("source").asc_nulls_last(), "pass", "lot", "size", "h", "n"], F.col("size"), "total")
    taken = queue.where(F.col("total") <= F.col("budget")).groupBy("source", "pass").agg(
        F.max(F.struct("lot", "size", "h", "n")).alias("last"))
    last = taken.groupBy("source").pivot("pass", list(range(repeats))).agg(F.first("last"))
    ends = F.array(*[F.col(str(k)) for k in range(repeats)])
    last = last.select(F.col("source").alias("_s"), ends.alias("ends"))
    return stored(targets.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "budget", "end"), "mix-plan")


def _times(place: Column, ends: Column) -> Column:
    """How often the mix takes a row."""
    times = F.size(F.filter(F.coalesce(ends, F.array()), lambda e: e.isNotNull() & (place <= e)))
    return F.when(place["size"] > 0, times).otherwise(0)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 9) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken (words, repeats counted).

    Rows that share a doc_id are rows of their own, in order of a hash of their texts; of rows that also share the text as many are
    taken as the mix has room for. Empty and null texts have size 0 and are never taken; a null source is a source; other
    columns are ignored. Empty input gives an empty table.
    """
    placed = _placed(docs, seed)
    plan = mix_plan(placed, weights, share, repeats).withColumnRenamed("source", "_s")
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    size = F.col("place.size")
    return joined.select("doc_id", size.alias("size"), "source_size", "target",
                         (size * _times(F.col("place"), F.col("ends"))).cast("bigint").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 9) -> DataFrame:
    """The documents of the mix with all their columns, whatever their names, a row once for every time it is taken (see :func:`mix`).

    The plan (one row per source) is joined to the documents, so their texts are not shuffled for it.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    place, name, ends, again = fresh_names(docs, "place", "named", "ends", "again")
    plan = mix_plan(_placed(docs, seed), weights, share, repeats).select(F.col("source").alias(name), F.col("ends").alias(ends))
    rows = docs.withColumn(place, _place(seed)).join(plan, F.col("source").eqNullSafe(F.col(name)))
    times = _times(F.col(place), F.col(ends))
    return rows.where(times > 0).withColumn(again, F.explode(F.sequence(F.lit(1), times))).select(*columns)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), '9')) AS lot
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT AS budget,
         (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
          - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source ASC NULLS LAST
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / sum(weight) OVER (ORDER BY 2 * source_size / weight, source ASC NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM src),
tgt AS (
  SELECT source, source_size, weight, budget, cap,
         (SELECT arg_min(level, cap / weight) FROM lev WHERE cap / weight >= level) AS at_level FROM lev),
tg AS (
  SELECT *, CASE WHEN at_level IS NOT NULL AND cap / weight > at_level THEN weight * at_level ELSE cap::DOUBLE END AS target
  FROM tgt),
run AS (
  SELECT s.*, t.source_size, t.weight, t.budget, t.target,
         (sum(size) OVER (PARTITION BY s.source ORDER BY lot, size))::BIGINT AS done
  FROM sized s JOIN tg t ON s.source IS NOT DISTINCT FROM t.source),
offers AS (
  SELECT source, lot, size, pass, budget, (done + pass * source_size) / weight AS finish
  FROM run, (VALUES (0), (1)) p(pass) WHERE size > 0),
queue AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source ASC NULLS LAST, pass, lot, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM offers),
cut AS (
  SELECT source, pass, max({'lot': lot, 'size': size}) AS e FROM queue WHERE total <= budget GROUP BY ALL)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (SELECT count(*) FROM cut c WHERE c.source IS NOT DISTINCT FROM r.source
                  AND {'lot': r.lot, 'size': r.size} <= c.e))::BIGINT AS taken
FROM run r"""
