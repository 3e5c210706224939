import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import queries, tokenfiles
from rillmark.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(rows, library):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_whole_table_as_the_library(spark, sf, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op10_token_files(spark, sf).collect()), key=repr) == expected(rows, library)


def test_odd_rows_and_files(spark, docs_of, library, sf):
    texts = ["", " ", "It's We'LL  é É İ ß ẞ", "a\x1cb\x85c d　e", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "K Å ﬁ",
             "Σας ΣΑΣ", "a ́b á", "99 bottles!!! ### 中文 \U0001f600", "\x00\x01", "ab" * 40000, "word " * 20000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, "again"), (3, "again"), (50, None), (None, "no id"), (None, None)]
    for dictionary in (True, False):
        path = scratch_dir(spark, "tokens")
        docs = docs_of(rows).withColumnRenamed("source", "ids").repartition(3)
        tokenfiles.write_tokens(docs, path, PATH, dictionary=dictionary, group_bytes=1 << 16)
        assert sorted(map(tuple, tokenfiles.document_digests(spark, path).collect()), key=repr) == expected(rows, library)
        kinds = set()
        for name in spark.read.parquet(path).inputFiles():
            meta = pq.read_metadata(name.removeprefix("file://"))
            for g in range(meta.num_row_groups):
                column = meta.row_group(g).column(2)
                assert column.path_in_schema.startswith("ids") and column.has_offset_index
                kinds |= set(column.encodings)
        assert ("RLE_DICTIONARY" if dictionary else "DELTA_BINARY_PACKED") in kinds
    some = tokenfiles.read_tokens(spark, path, where=F.col("doc_id") == 2)
    assert some.first().ids == library.encode(texts[2], add_special_tokens=False).ids + [1]
    plan = tokenfiles.read_tokens(spark, path, ("doc_id", "n_tokens"), F.col("doc_id") > 3)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,3)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:int>" in plan


def test_empty_table(spark, docs_of):
    path = scratch_dir(spark, "tokens")
    tokenfiles.write_tokens(docs_of([]), path, PATH)
    assert tokenfiles.document_digests(spark, path).collect() == []
