"""Alignments against a plain walk over both tokenisations."""

import bisect
import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillmark.llm import alignment
from rillmark.llm.alignment import Aligner, align, csr, groups_of, link_counts, overlaps, product, rated, shared_groups
from rillmark.llm.wordbpe import BYTE_CHARS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(A)
LIBRARY.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B)
BYTE = {chr(c): b for b, c in BYTE_CHARS.items()}


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return Aligner(f.read(), g.read())


def plain(text):
    """(groups of A and B ids) of a text, or none."""
    if not text:
        return []
    a = [(i, len(bytes(BYTE[c] for c in t))) for i, t in ((i, LIBRARY.id_to_token(i)) for i in LIBRARY.encode(
        " " + text, add_special_tokens=False).ids)]
    b, joined = [], b""
    for i in SP.encode(text):
        p = SP.id_to_piece(i)
        data = bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode()
        b.append((i, len(data)))
        joined += data
    if joined != (" " + text).encode():
        return []
    ends = [set(np.cumsum([n for _, n in x]).tolist()) for x in (a, b)]
    common = sorted(ends[0] & ends[1])
    out = [([], []) for _ in common]
    for side, tokens in enumerate((a, b)):
        at = 0
        for i, n in tokens:
            at += n
            out[bisect.bisect_left(common, at)][side].append(i)
    return out


def plain_table(texts):
    groups = [plain(t) for t in texts]
    links = [collections.Counter((a, b) for ga, gb in g for a in ga for b in gb) for g in groups]
    docs = collections.Counter(p for x in links for p in x)
    most = collections.Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for g, x in zip(groups, links, strict=True):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()),
                    sum(n for p, n in x.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in x.items()),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return out


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 9), st.integers(1, 9), st.integers(0, 9), st.integers(0, 1 << 30))
def test_product_equals_dense(m, k, n, seed):
    r = np.random.default_rng(seed)
    dense = [r.integers(0, 3, s) * r.integers(0, 2, s) for s in ((m, k), (k, n))]
    x, y = (csr(*d.nonzero(), d[d.nonzero()], *d.shape) for d in dense)
    z = product(x, y)
    got = np.zeros((m, n), np.int64)
    got[z.rows, z.indices] = z.data
    assert (got == dense[0] @ dense[1]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.integers(0, 1 << 30))
def test_overlaps_and_groups(sizes, seed):
    n = sum(sizes)
    r = random.Random(seed)
    cuts = sorted(r.sample(range(1, n), r.randint(0, n - 1))) + [n] if n > 1 else [n]
    other = np.diff([0, *cuts])
    a_end, b_end = np.cumsum(sizes), np.cumsum(other)
    z = overlaps(np.array(sizes), other)
    want = {(i, j): min(a_end[i], b_end[j]) - max(a_end[i] - sizes[i], b_end[j] - other[j])
            for i in range(len(sizes)) for j in range(len(other))}
    assert dict(zip(zip(z.rows.tolist(), z.indices.tolist(), strict=True), z.data.tolist(), strict=True)) == {
        k: v for k, v in want.items() if v > 0}
    common = sorted(set(a_end.tolist()) & set(b_end.tolist()))
    ga, gb, count = groups_of(np.array(sizes), other)
    assert count == len(common) and ga.tolist() == np.searchsorted(common, a_end).tolist()
    assert gb.tolist() == np.searchsorted(common, b_end).tolist()
    s = shared_groups(ga, gb, count)
    assert list(zip(s.rows.tolist(), s.indices.tolist(), strict=True)) == [
        (i, j) for i in range(len(sizes)) for j in range(len(other)) if ga[i] == gb[j]]


PARTS = ["a", "the", " ", "  ", "   ", "\n", "\t", "é", "é", "漢字", "\U0001f600", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "ing", "don't", "7", "2024", "!?",
         " ", " ", "Straße", "=" * 40, "ab" * 20]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PARTS, "▁"]), max_size=25).map("".join), max_size=6), st.sampled_from([1, 20, 1 << 18]))
def test_texts_by_chunks_of_any_size(aligner, texts, chunk):
    old, alignment.CHUNK = alignment.CHUNK, chunk
    try:
        got = aligner([*texts, None], detail=True)
    finally:
        alignment.CHUNK = old
    for x, t, w in zip(got, [*texts, None], plain_table([*texts, None]), strict=True):
        a, b, times = x.pairs()
        assert (x.n_a, x.n_b, x.n_groups, int(times.sum()), x.digest) == (*w[:4], w[6])
        want = collections.Counter((i, j) for ga, gb in plain(t) for i in ga for j in gb)
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), times.tolist(), strict=True)) == want
        assert [(list(g["a"]), list(g["b"])) for g in x.groups] == plain(t)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_characters_encode_as_the_library_does(aligner, text):
    assert aligner.a([text]) == [LIBRARY.encode(text, add_special_tokens=False).ids]
    assert aligner.a.quick is not None


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, pair int, docs int, _row int, row int")
    return align(df, A, B)


def test_whole_table_with_nulls_and_repeats(spark):
    r = random.Random(2)
    texts = [None, "", " ", "\n", "the end", "▁", *("".join(r.choice(PARTS) for _ in range(60)) for _ in range(20))]
    rows = [(k if k != 4 else None, t, 1, 2, 3, 4) for k, t in enumerate(texts)]
    rows += rows[:8] + [(7, "the other", 1, 2, 3, 4)]
    aligned = table_of(spark, rows)
    want = sorted(((row[0], *w) for row, w in zip(rows, plain_table([x[1] for x in rows]), strict=True)), key=repr)
    for hot in (0, 5, 1 << 16):  # any share of the links may be broadcast
        out = rated(aligned, link_counts(aligned), hot)
        got = out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
        assert sorted((tuple(x) for x in got), key=repr) == want


def test_empty_table_and_clash(spark):
    aligned = table_of(spark, [])
    assert rated(aligned, link_counts(aligned)).count() == 0
    with pytest.raises(ValueError, match="n_a"):
        align(spark.createDataFrame([("x", 1)], "text string, N_A int"), A, B, keep=("N_A",))


def test_query_equals_a_plain_walk(spark, sf):
    from rillmark.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_token_alignment"](spark, sf).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = [(d.doc_id, *w) for d, w in zip(docs, plain_table([d.text for d in docs]), strict=True)]
    assert sorted((tuple(x) for x in got), key=repr) == sorted(want, key=repr)
