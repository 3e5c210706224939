import base64
import hashlib
import sys
import unicodedata

import public_tokenizers
import pytest
import tiktoken

from rillmark.llm import bytebpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_text_as_the_library(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op4_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_texts(docs_of, library):
    texts = ["", " ", "\n\n  \t", "it's we'll I'D", "a" * 5000, " " * 3000 + "x", "\x00\x01▁Ā", "é中\U0001f600é",
             "<|endoftext|>", "123456789 ١٢", " 　x​", "### === %%%%", "x" * 70000 + " " + "ß" * 20000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(99, None), (99, None), (None, "null id")]
    docs = docs_of(rows).withColumnRenamed("source", "decoded")
    out = bytebpe.decode(bytebpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "ids", "decoded"]
    for r in out.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_empty_table(docs_of):
    assert bytebpe.encode(docs_of([]), PATH, public_tokenizers.PATTERN).collect() == []


def test_every_character(library):
    """Splitting and merging agree with the library for each assigned code point."""
    encoder = bytebpe.Encoder(bytebpe.bpe_model(bytebpe.read_ranks(PATH)), bytebpe.read_ranks(PATH), public_tokenizers.PATTERN)
    texts = [f"a {chr(c)}1{chr(c)} b" for c in range(sys.maxunicode + 1) 
             if unicodedata.category(chr(c)) not in ("Cs", "Co", "Cn")]
    differ = []
    for at in range(0, len(texts), 1 << 16):
        part = texts[at:at + (1 << 16)]
        for t, ids, want in zip(part, encoder(part), library.encode_ordinary_batch(part, num_threads=4), strict=True):
            if list(memoryview(ids).cast("i")) != want:
                differ.append(t)
    assert not differ, (len(differ), differ[:20])
