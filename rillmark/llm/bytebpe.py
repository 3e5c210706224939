"""Byte-level BPE encoding and decoding (operator 4) on a sentencepiece model serialised from a vocabulary of ranks."""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE_BYTES = 1 << 24  # of pre-tokens remembered by a task

_NORMAL, _UNKNOWN, _BPE = 1, 2, 2  # values of the model format
_CHARS = {b: 0x100 + b for b in range(256)}  # one visible character per byte


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token, space, rank) in order of rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    tokens = [ranks[k] for k in range(len(ranks))]
    missing = {bytes([b]) for b in range(256)} - set(tokens)
    if missing:
        raise ValueError(f"{len(missing)} single bytes have no rank")
    return tokens


def as_pieces(data: bytes) -> str:
    return data.decode("latin-1").translate(_CHARS)


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, data: bytes) -> bytes:
    return _number(number << 3 | 2) + _number(len(data)) + data


def _value(number: int, n: int) -> bytes:
    return _number(number << 3) + _number(n)


def serialised_model(pieces: list[tuple[str, float]], model_type: int) -> bytes:
    """A sentencepiece model: the pieces with scores and ids in order, then the unknown piece; identity normalisation."""
    body = [_field(1, _field(1, p.encode()) + _number(2 << 3 | 5) + struct.pack("<f", s) + _value(3, _NORMAL)) for p, s in pieces]
    body.append(_field(1, _field(1, b"<unk>") + _number(2 << 3 | 5) + struct.pack("<f", 0) + _value(3, _UNKNOWN)))
    body.append(_field(2, _value(3, model_type) + _value(40, len(pieces))))
    body.append(_field(3, _field(1, b"identity") + _value(3, 0) + _value(4, 0) + _value(5, 0)))
    return b"".join(body)


def bpe_model(tokens: list[bytes]) -> bytes:
    """Ranks as a BPE model: byte-mapped pieces with id = rank and score = -rank."""
    return serialised_model([(as_pieces(t), -float(k)) for k, t in enumerate(tokens)], _BPE)


class Encoder:
    """Ids of texts; remembers the ids of recent pre-tokens within a bound."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor()
        self.sp.LoadFromSerializedProto(model)
        self.whole = {t: k for k, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, parts: set[str]) -> None:
        raw = {p: p.encode() for p in parts}
        longer = [p for p, b in raw.items() if b not in self.whole]
        ids = dict(zip(longer, self.sp.encode([as_pieces(raw[p]) for p in longer], num_threads=1), strict=True))
        for p, b in raw.items():
            self.known[p] = np.array(ids.get(p) or [self.whole[b]], np.int32).tobytes()
            self.held += 6 * len(b)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        self._learn({p for parts in split for p in parts if p not in self.known})
        return [b"".join([self.known[p] for p in parts]) for parts in split]


def _lists(parts: list[bytes], kind: np.dtype, to: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // kind.itemsize for p in parts])
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(parts), kind))).cast(
        pa.list_(to))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the token ids (array of int) of the whole text as the rank file at ``path`` merges them.

    Each match of ``pattern`` is encoded by itself. A match that is a token is that token; any other goes through the BPE
    of a sentencepiece model made from the ranks, which merges the pair of least rank, leftmost first. Null and empty texts
    give an empty list; every other column is passed on; an ``out`` that exists is replaced.
    """
    docs = docs.drop(out)
    sc = docs.sparkSession.sparkContext
    tokens = read_ranks(path)
    shared = sc.broadcast((bpe_model(tokens), tokens))  # as large as the vocabulary file

    def run(batches):
        encoder = Encoder(*shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = encoder([t or "" for t in part.column(text).to_pylist()])
                yield part.append_column(out, _lists(ids, np.dtype("<i4"), pa.int32()))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that the ids of each row stand for. Null and empty lists give no bytes; an id that is
    not in the vocabulary is an error. Bytes of an encoded text are its UTF-8 form."""
    encoded = encoded.drop(out)
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        tokens = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [b"".join([tokens[k] for k in v.values.to_numpy().tolist()]) if v.is_valid else b"" for v in part.column(ids)]
                yield part.append_column(out, pa.array(texts, pa.binary()))

    return encoded.mapInArrow(run, T.StructType(encoded.schema.fields + [T.StructField(out, T.BinaryType())]))
