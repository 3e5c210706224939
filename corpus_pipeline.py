"""A corpus pipeline of five of the training-data operators: STAGES, run() and its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import bytebpe, langid, linededup, mixing
from rillmark.llm.common import fold, fresh_names, stored, table
from rillmark.llm.jaccard import jaccard_components


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _once(docs: DataFrame) -> DataFrame:
    """One row of those that share doc_id and text. Only groups of several rows are looked at again, by their numbers in the table."""
    docs = stored(docs, "numbered")  # so that a row has the same number whenever it is read
    doc, text, number, first = fresh_names(docs, "doc", "hash", "number", "first")
    marked = docs.withColumns({text: F.xxhash64("text", F.col("text").isNull()), number: F.monotonically_increasing_id()})
    several = marked.groupBy(F.col("doc_id").alias(doc), F.col(text).alias("h")).agg(
        F.min(number).alias(first), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = marked.join(several, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(text) == F.col("h")), "left")
    return joined.where(F.col(first).isNull() | (F.col(first) == F.col(number))).select(*_columns(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model can tell; texts without a letter and ambiguous ones go.

    ``lang`` becomes the predicted language. The model learns from the labelled documents of the stage's own input.
    """
    model = langid.fit(docs.where(F.coalesce(fold("doc_id", 4) != 2, F.lit(True))))
    lang, score, vague = names = fresh_names(docs, "lang_pred", "score", "ambiguous")
    told = langid.identify(docs, model, names).where((F.col(lang) != langid.UNKNOWN) & ~F.col(vague))
    return told.withColumn("lang", F.col(lang)).select(*_columns(docs))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line of the corpus within two edits."""
    return linededup.without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group with a five-word shingle similarity of 0.8 or more.

    Rows that share doc_id and text are one document: one of them stays. Rows with a null doc_id belong to no group; they stay, but
    for repeats of one text.
    """
    found = jaccard_components(docs, n=5, percent=80)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return _once(docs.join(gone, "doc_id", "left_anti").select(*_columns(docs)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a mix of sources by weight, a document once for every time the mix takes it."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (null text: none), and whether they decode to its text: (doc_id, lang, source, ids, n_tokens, exact)."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bytebpe.decode(bytebpe.encode(docs.select("doc_id", "text", "lang", "source"), path, public_tokenizers.PATTERN), path)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), exact.alias("exact"))


STAGES = [("language", language), ("repeated_lines", repeated_lines), ("near_copies", near_copies), ("mixture", mixture),
          ("tokens", tokens)]

ORACLE_SQL = None  # hashed n-gram models, edit joins and token merges have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
