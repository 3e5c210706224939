"""The quick encoder against the library on whole texts."""

import numpy as np
import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillmark.llm import wordbpe
from rillmark.llm.wordbpe import PieceTable, WordEncoder, cut_pieces, read_rules, word_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
RULES = read_rules(PATH)

plain = st.text(st.sampled_from("abcdrelstvm'\"!_-. \n\t\x0b07éßñŉž"), max_size=60)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(plain)
def test_pieces_are_those_of_the_pattern(text):
    data = text.encode()
    begins, ends = cut_pieces(np.frombuffer(data, np.uint8))
    assert [data[a:b].decode() for a, b in zip(begins, ends, strict=True)] == regex.findall(wordbpe._PATTERN, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(plain, st.text(max_size=30), st.none(), st.sampled_from(
    ["It's WE'LL", "İstanbul Σας", "<|endoftext|> x", "a<|ENDOFTEXT|>b", "ab" * 400, "é é", ""])), max_size=6))
def test_a_batch_is_encoded_as_the_library_does(texts):
    got = word_encoder(RULES).batch(texts)
    assert [x.tolist() for x in got] == [ids(t or "") for t in texts]


def test_small_runs_and_a_full_table(monkeypatch):
    monkeypatch.setattr(wordbpe, "RUN", 50)
    encoder = WordEncoder(RULES)
    encoder.pieces.most = 7
    texts = [f"word{k} other{k % 3}, it's the {k}th! " * (1 + k % 3) for k in range(40)]
    assert [x.tolist() for x in encoder.batch(texts)] == [ids(t) for t in texts]
    assert len(encoder.pieces.keys) < 20


def test_table_asks_once():
    asked = []
    table = PieceTable(lambda p: asked.append(p) or np.array([len(p)] * len(p), "<i4").tobytes(), 10)
    for _ in range(2):
        row = table.places(np.array([5, 3, 5], np.uint64), ["aa", "b", "aa"].__getitem__)
        assert [table.ids[table.at[r]:table.at[r] + table.size[r]].tolist() for r in row] == [[2, 2], [1], [2, 2]]
    assert sorted(asked) == ["aa", "b"]


def test_other_files_go_through_the_library_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    rules = read_rules(path)
    assert not rules.by_words and RULES.by_words
    assert WordEncoder(rules).batch(["two  words"])[0].tolist() == Tokenizer.from_file(path).encode("two  words").ids
