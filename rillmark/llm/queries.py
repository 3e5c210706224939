"""The queries opN_<name>, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.alignment import align, link_counts, rated
from rillmark.llm.bytebpe import decode, encode
from rillmark.llm.common import fold, table
from rillmark.llm.jaccard import jaccard_components
from rillmark.llm.langid import fit, identify
from rillmark.llm.linededup import line_classes
from rillmark.llm.mixing import MIX_SQL, mix
from rillmark.llm.negatives import MINE_SQL, mine
from rillmark.llm.neighbours import build, search
from rillmark.llm.quality import quality
from rillmark.llm.tokencount import count_tokens, unigram_vocabulary
from rillmark.llm.tokenfiles import document_digests, write_tokens
from rillmark.llm.toxicity import toxicity, train
from rillmark.llm.treebpe import encode as encode_words
from rillmark.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are at least 0.9 similar."""
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base signals of every document and the verdict of its log-likelihood ratio; trusted: documents labelled good."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality(table(spark, sf_dir, "documents"), trusted)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every line of every document: equal lines and lines within two edits."""
    return line_classes(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of rows with crc32(doc_id) mod 5 = 0 are held out of the learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_terms")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs, path, public_tokenizers.PATTERN).drop("text"), path)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows with crc32(doc_id) mod 4 = 2 are held out of the learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    model = fit(docs.where("NOT held_out"))
    return identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(build(vectors), vectors.where("vec_id % 20 = 0"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of words and unigram pieces of every text."""
    vocabulary = unigram_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary).drop("text")


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources with weights 5, 2, 1 in turn takes of every document."""
    return mix(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, read back from the files written."""
    path = scratch_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return document_digests(spark, path)


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenisations of every text, and how common its links are in the corpus."""
    aligned = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                    public_tokenizers.path("piece_bpe_32k.model"))
    return rated(aligned, link_counts(aligned)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100; labels of ids divisible by 7 are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op13_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids, long texts by halves, and of the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_words(docs, path, drop_text=True, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


ORACLES["op9_mix_sources"] = MIX_SQL
ORACLES["op12_hard_negatives"] = MINE_SQL
