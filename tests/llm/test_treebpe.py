"""Tree concatenation against the library on whole texts."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import treebpe
from rillmark.llm.treebpe import decode, encode, halves, leaf_node, tree
from rillmark.llm.wordbpe import read_rules, word_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RULES = read_rules(PATH)
LIBRARY = Tokenizer.from_file(PATH)

PARTS = ["a", "aaa", "the", "'s", "'", "''", "'re", "don't", "'ll", " ", "  ", "\n", "\t", "\x0b", "\x1c", " ", " ", "!", "!!", "_", "-", "7", "42",
         "é", "é", "́", "̣́", "İ", "Σ", "漢字", "一", "각", "가", "\U0001f600", "\U0001f468‍\U0001f469",
         "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endof", "text", "ſ", "ﬁ", "Straße", "ing", "tion", "x" * 30, "qzj" * 9]
texts = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def by_tree(text, leaf, edge, window):
    encoder = word_encoder(RULES)
    return tree(encoder, [leaf_node(encoder, t, edge) for t in halves(text, leaf)], window).ids.tolist()


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(1, 40), st.integers(1, 30), st.integers(1, 40))
def test_any_text_cut_anywhere(text, leaf, edge, window):
    assert "".join(halves(text, leaf)) == text
    assert by_tree(text, leaf, edge, window) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(1, 20))
def test_any_characters(text, leaf):
    assert by_tree(text, leaf, 5, 3) == library(text)


def test_texts_without_white_space():
    r = random.Random(3)
    syllables = ["ba", "ne", "ti", "str", "ing", "ou", "q", "ch", "ment"]
    for letters in ("a", "ab", "abc"):
        text = "".join(r.choice(letters) for _ in range(3000))
        assert by_tree(text, 100, 20, 8) == library(text)
    word = "".join(r.choice(syllables) for _ in range(20000))
    assert by_tree(word, 512, 64, 16) == library(word)


def test_windows_stay_small_in_ordinary_text(monkeypatch):
    r = random.Random(4)
    text = " ".join("".join(r.choice(["ba", "ne", "ti", "str", "ing", "ou"]) for _ in range(r.randint(1, 5))) for _ in range(9000))
    encoder = word_encoder(RULES)
    nodes = [leaf_node(encoder, t) for t in halves(text)]
    seen = []
    plain = treebpe._edge
    monkeypatch.setattr(treebpe, "_edge", lambda e, t: seen.append(len(t)) or plain(e, t))
    assert len(nodes) > 4 and tree(encoder, nodes).ids.tolist() == library(text)
    assert len(seen) < 3 * len(nodes) and max(seen) <= 16 * treebpe.WINDOW


def test_leaves_go_to_the_encoder_together_and_most_seams_need_one_window(monkeypatch):
    r = random.Random(5)
    text = " ".join("".join(r.choice(["ba", "ne", "ti", "str", "ing", "ou"]) for _ in range(r.randint(1, 5))) for _ in range(6000))
    parts = [*halves(text, 1024), "short one", "x" * 300]
    encoder = word_encoder(RULES)
    alone = [leaf_node(encoder, t) for t in parts]
    calls, plain = [], encoder.batch
    monkeypatch.setattr(encoder, "batch", lambda texts: calls.append(len(texts)) or plain(texts))
    nodes = treebpe.leaf_nodes(encoder, parts)
    assert calls == [len(parts) - 2]
    assert [(n.ids.tolist(), n.head.text, n.tail.text, n.whole) for n in nodes] == [
        (n.ids.tolist(), n.head.text, n.tail.text, n.whole) for n in alone]
    seen, edge = [], treebpe._edge
    monkeypatch.setattr(treebpe, "_edge", lambda e, t: seen.append(len(t)) or edge(e, t))
    assert tree(encoder, nodes[:-2]).ids.tolist() == library(text)
    assert len(seen) < 1.5 * (len(nodes) - 3)


def test_halves_are_even_and_never_cut_a_composition():
    assert halves("", 5) == [""] and halves("abc", 5) == ["abc"]
    assert halves("é" * 4, 2) == ["é"] * 4
    assert halves("e" + "́" * 50, 4) == ["e" + "́" * 50]
    assert all(4 <= len(x) <= 8 for x in halves("x" * 1000, 8))


def rows_of(spark, rows, path=PATH, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, H1 int, found int, no int, decoded int")
    df = df.withColumnRenamed("ids", "part")
    both = encode(df, path, decoded="decoded", **options)
    again = decode(both.drop("decoded"), path)
    assert again.columns == both.columns and sorted(map(str, again.collect())) == sorted(map(str, both.collect()))
    return both


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_whole_tables(spark, path):
    r = random.Random(6)
    long = " ".join(r.choice(PARTS) for _ in range(400)) + "z" * 300
    texts = [None, "", "  \n", "one", "it's <|endoftext|> here", long, long, long + " end", "x" * 700, "漢" * 300, "7" * 500]
    rows = [(k if k != 3 else None, t, "p", 1, 2, 3, 4) for k, t in enumerate(texts)] * 2
    rows += [(5, long, "other", 1, 2, 3, 4), (5, "short", "other", 1, 2, 3, 4)]
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    out = rows_of(spark, rows, path, leaf=64, window=8)
    assert out.columns == ["doc_id", "text", "part", "H1", "found", "no", "ids", "decoded"]
    got = [tuple(x) for x in out.collect()]
    want = []
    for doc_id, text, part, *rest in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, text, part, *rest[:3], ids, lib.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table_and_bare_columns(spark):
    out = rows_of(spark, [])
    assert out.count() == 0
    bare = spark.createDataFrame([("a b", [9]), (None, None)], "text string, ids array<int>")
    got = encode(bare, PATH, drop_text=True)
    assert got.columns == ["ids"] and sorted(map(str, got.collect())) == sorted(
        [f"Row(ids={library('a b')})", "Row(ids=[])"])


def test_query_equals_library_on_whole_documents(spark, sf):
    import hashlib

    from rillmark.llm.queries import QUERIES
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert any(len(t or "") > treebpe.LEAF for t in docs.values())
    got = QUERIES["op13_tree_bpe"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library(docs[r.doc_id] or "")
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_no_id_in_the_vocabulary_is_skipped(spark):
    df = spark.createDataFrame([([0, 1 << 20, 1],)], "ids array<int>")
    assert decode(df, PATH).select(F.col("decoded")).first()[0] == LIBRARY.decode([0, 1], skip_special_tokens=False)
