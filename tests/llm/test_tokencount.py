import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from rillmark.llm import queries
from rillmark.llm.tokencount import SPACE, Counter, count_tokens, unigram_model, unigram_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def vocabulary():
    return unigram_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def library(vocabulary):
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(unigram_model(vocabulary))
    known = {p for p, _ in vocabulary}

    def count(word):
        """Pieces of the library; a run of unknown characters comes as one piece there, and counts as its bytes."""
        pieces = sp.encode(SPACE + word, out_type=str)
        assert "".join(pieces) == SPACE + word
        return sum(1 if p in known else len(p.encode()) for p in pieces)

    return count


def test_whole_table_as_the_library(spark, sf, vocabulary):
    count = library(vocabulary)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op8_token_counts(spark, sf).collect()
    assert len(got) == len(texts)
    seen = {w: count(w) for t in texts.values() for w in set(WORD.findall(t))}
    for r in got:
        words = WORD.findall(texts[r.doc_id])
        assert (r.n_words, r.n_tokens) == (len(words), sum(seen[w] for w in words))


def test_ties_and_rounding_as_the_library():
    """Few letters, many equal and nearly equal sums, characters without a piece."""
    rng = random.Random(8)
    for round_ in range(30):
        scores = [-1.0, -2.0, -3.0, -0.1, -0.2, -0.30000001] if round_ % 2 else [-rng.random() * 1e3 for _ in range(6)]
        pieces = {SPACE} | {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(14)}
        vocabulary = [(p, float(np.float32(rng.choice(scores)))) for p in sorted(pieces)]
        count, own = library(vocabulary), Counter(vocabulary)
        for _ in range(60):
            word = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 40)))
            assert own.word(SPACE + word)[0] == count(word), (vocabulary, word)


def test_odd_rows(docs_of, vocabulary):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "hello world"), (4, "hello world"), (None, "\U0001f600͸"), (5, "x" * 30000),
            (6, "a\x0bb c d")]
    docs = docs_of(rows).withColumnRenamed("source", "n_tokens")
    out = count_tokens(docs, vocabulary)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "n_words", "n_tokens", "n_unknown_bytes"]
    count = library(vocabulary)
    for r in out.collect():
        words = WORD.findall(r.text or "")
        assert (r.n_words, r.n_tokens) == (len(words), sum(map(count, words)))
    assert {r.n_tokens for r in count_tokens(docs, []).where("doc_id = 4").collect()} == {16}
    assert count_tokens(docs_of([]), vocabulary).collect() == []
