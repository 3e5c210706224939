"""Token-id files (operator 10): Parquet list columns with dictionary or delta encoding, small row groups and page indexes."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.common import stored
from rillmark.llm.wordbpe import read_rules, word_encoder
from rillmark.operators.scale import running_total


def encode_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row's whole text, with the end id appended; null and empty texts hold only that.

    The order of the rows of a partition is kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_rules(tokenizer_path))  # as large as the vocabulary file

    def run(batches):
        encoder, end = word_encoder(shared.value), np.array([end_id], np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = encoder.batch(part.column("text").cast(pa.binary()).to_pylist())
                ends = np.cumsum([0] + [len(x) + 1 for x in ids]).astype(np.int32)
                flat = pa.array(np.concatenate([x for one in ids for x in (one, end)] or [end[:0]]).astype(np.int32))
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_tokens": pa.array(np.diff(ends), pa.int32()),
                                       "ids": pa.ListArray.from_arrays(pa.array(ends), flat)})

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens int, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, dictionary: bool = True,
                 group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000) -> None:
    """Write (doc_id, n_tokens, ids) in ascending doc_id order (null first, ties by text), file after file by name.

    ids are dictionary-encoded (a vocabulary of under 2^17 ids takes 17 bits or fewer each), or delta-bit-packed if
    ``dictionary`` is false; row groups and pages are kept small, and the writer adds column and offset indexes, so that a
    reader with a filter on doc_id fetches only the pages it needs. Texts are dealt by ranges of (doc_id, first characters)
    before they are encoded, so ids are never shuffled, no task holds more than its range, and the sample that finds the ranges
    holds no whole text.
    """
    ordered = docs.select("doc_id", "text", F.substring("text", 1, 16).alias("begin"))
    ordered = ordered.repartitionByRange("doc_id", "begin").sortWithinPartitions("doc_id", "text")
    options = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": str(dictionary).lower(),
               "parquet.block.size": group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows,
               "parquet.dictionary.page.size": 2 << 20}
    encode_ids(ordered, tokenizer_path, end_id).write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids"),
                where: Column | None = None) -> DataFrame:
    """Chosen columns of chosen rows; metadata alone is read without touching the ids."""
    rows = spark.read.schema("doc_id bigint, n_tokens int, ids array<int>").parquet(path)
    return (rows if where is None else rows.where(where)).select(*columns)


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all written documents, from the files.

    start counts the ids of all documents before: a running total inside each file plus one sum per file.
    """
    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4")
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "file": batch.column("file"), "row": batch.column("row"),
                                   "n_tokens": pa.array(np.diff(ends).astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})

    # by part number, then name: a writer that cuts long parts numbers the files of a part in their names
    name = F.col("_metadata.file_name")
    number = F.struct(F.regexp_extract(name, r"part-(\d+)", 1).cast("int").alias("part"), name.alias("name"))
    rows = read_tokens(spark, path, ("doc_id", "ids", number.alias("file"), F.col("_metadata.row_index").alias("row")))
    rows = rows.mapInArrow(digest, "doc_id bigint, file struct<part int, name string>, row bigint, n_tokens bigint, ids_crc32 bigint")
    rows = stored(rows, "token-digests")  # a few numbers per document; the running total reads them twice
    placed = running_total(rows, [], "file", ["row"], F.col("n_tokens"), "end")
    return placed.select("doc_id", (F.col("end") - F.col("n_tokens")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")
