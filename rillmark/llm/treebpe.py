"""BPE by tree concatenation (operator 13): halves of long texts in parallel, joined by growing windows around each seam."""

from __future__ import annotations

import dataclasses
import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rillmark.llm.common import fresh_names
from rillmark.llm.wordbpe import WordEncoder, read_rules, word_encoder

LEAF = 8192  # code points above which a text is halved
EDGE = 96  # code points at either end of a leaf whose tokens' places are kept (more, up to the next white space)
WINDOW = 32  # code points on either side of a seam that are encoded again at first
_SPACE = " \t\n\x0b\x0c\r"


@functools.cache
def _joining() -> frozenset[str]:
    """Characters that a canonical composition can add to the character before them."""
    out = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            out.add(chr(int(parts[1], 16)))
    return frozenset(out)


def _begins(char: str) -> bool:
    """Whether normalisation never joins this character to, or moves it before, the one in front of it."""
    if char.isascii():
        return True
    first = unicodedata.normalize("NFD", char)[0]
    return not unicodedata.combining(first) and first not in _joining() and unicodedata.category(char) != "Cn"


def _seam(text: str, at: int, step: int) -> int:
    """The nearest place from ``at`` on in the direction of ``step`` where a text may be cut."""
    while 0 < at < len(text) and not _begins(text[at]):
        at += step
    return at


def halves(text: str, leaf: int = LEAF) -> list[str]:
    """The text cut into halves, and these again, until none is longer than ``leaf`` (or has no place to cut)."""
    middle = _seam(text, len(text) // 2, 1) if len(text) > leaf else len(text)
    if middle >= len(text):
        return [text]
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


@dataclasses.dataclass
class Edge:
    """The text at one end of a node, and the ids and places (code points) of its tokens."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def alone(self) -> np.ndarray:
        """Tokens that share no character with their neighbours (a token may be a part of a character's bytes)."""
        before, after = np.append(0, self.ends[:-1]), np.append(self.starts[1:], len(self.text))
        return (self.starts >= before) & (self.ends <= after) & (self.ends > self.starts)


@dataclasses.dataclass
class Node:
    """Ids of a stretch of text. Its edges reach to white space; if there is none between them, both are the whole stretch."""

    ids: np.ndarray
    head: Edge
    tail: Edge
    whole: bool


def _edge(encoder: WordEncoder, text: str) -> Edge:
    coded = encoder.whole(text)
    places = np.array(coded.offsets, np.int32).reshape(-1, 2)
    return Edge(text, np.array(coded.ids, np.int32), places[:, 0], places[:, 1])


def leaf_nodes(encoder: WordEncoder, texts: list[str], edge: int = EDGE) -> list[Node]:
    """Leaves, each encoded on its own; their whole texts go to the encoder together, which looks up the pieces of a run at once."""
    spans = []
    for text in texts:
        end = min((k for k in (text.find(c, edge) for c in _SPACE) if k >= 0), default=len(text))
        spans.append((max(text.rfind(c, 0, max(0, len(text) - edge)) for c in _SPACE), end))
    found = iter(encoder.batch([t for t, (start, end) in zip(texts, spans, strict=True) if start >= end]))
    nodes = []
    for text, (start, end) in zip(texts, spans, strict=True):
        if start < end:
            one = _edge(encoder, text)
            nodes.append(Node(one.ids, one, one, True))
        else:
            nodes.append(Node(next(found), _edge(encoder, text[:end]), _edge(encoder, text[start:]), False))
    return nodes


def leaf_node(encoder: WordEncoder, text: str, edge: int = EDGE) -> Node:
    """A single leaf."""
    return leaf_nodes(encoder, [text], edge)[0]


def _common(edge: Edge, window: Edge, shift: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of an edge and of a window (which begins ``shift`` code points after the edge's begin) that are the same
    token at the same place, between ``low`` and ``high`` in the edge."""
    mine = np.flatnonzero(edge.alone() & (edge.starts >= low) & (edge.ends <= high))
    other = np.flatnonzero(window.alone())
    _, i, j = np.intersect1d(edge.starts[mine] - shift, window.starts[other], assume_unique=True, return_indices=True)
    i, j = mine[i], other[j]
    same = (edge.ids[i] == window.ids[j]) & (edge.ends[i] - shift == window.ends[j])
    return i[same], j[same]


def join(encoder: WordEncoder, left: Node, right: Node, window: int = WINDOW) -> Node:
    """The node of two neighbouring stretches.

    The text around the seam is encoded again. Where the window and the left side have the same token in the same place, the left
    side's tokens hold up to there and the window's from there on; likewise on the right. The window grows until both sides
    agree with it. Why that is exact: a run of tokens is what BPE gives if every two neighbours are what it gives for the two
    alone, and every two neighbours of the result stand in one of the three encodings. What cuts words into pieces looks less
    far than ``guard`` characters around, so tokens nearer than that to an end made by cutting count for nothing.
    A window that has reached the end of an edge (white space, or the end of the stretch) needs no agreement there.
    """
    a, b = left.tail, right.head
    guard = max([4, *(len(m) + 1 for m in encoder.marks)])
    size, n = window, len(a.text)
    while size <= 2 * guard:  # a smaller window has no token between its guards
        size *= 2
    while True:
        begin, end = _seam(a.text, max(0, n - size), -1), _seam(b.text, min(len(b.text), size), 1)
        w = _edge(encoder, a.text[begin:] + b.text[:end])
        i, k = (np.array([-1]), np.array([-1])) if begin == 0 else _common(a, w, begin, begin + guard, n - guard)
        j, m = ((np.array([len(b.ids)]), np.array([len(w.ids)])) if end == len(b.text)
                else _common(b, w, begin - n, guard, end - guard))
        if len(i) and len(j):
            break
        size *= 2
    i, k, j, m = int(i[-1]), int(k[-1]), int(j[0]), int(m[0])
    seam = Edge(a.text + b.text, np.concatenate([a.ids[:i + 1], w.ids[k + 1:m], b.ids[j:]]),
                np.concatenate([a.starts[:i + 1], w.starts[k + 1:m] + begin, b.starts[j:] + n]),
                np.concatenate([a.ends[:i + 1], w.ends[k + 1:m] + begin, b.ends[j:] + n]))
    ids = np.concatenate([left.ids[:len(left.ids) - len(a.ids)], seam.ids, right.ids[len(b.ids):]])
    return Node(ids, seam if left.whole else left.head, seam if right.whole else right.tail, left.whole and right.whole)


def tree(encoder: WordEncoder, nodes: list[Node], window: int = WINDOW) -> Node:
    """The node of a row of neighbours, joined two by two."""
    while len(nodes) > 1:
        pairs = [join(encoder, *nodes[k:k + 2], window) for k in range(0, len(nodes) - 1, 2)]
        nodes = pairs + nodes[2 * len(pairs):]
    return nodes[0]


_NODE = "h1 bigint, h2 bigint, no int, ids binary, head struct<text string, places array<int>>, " \
        "tail struct<text string, places array<int>>, whole boolean"


def _packed(edge: Edge) -> dict:
    return {"text": edge.text, "places": np.stack([edge.starts, edge.ends], 1).ravel()}


def _unpacked(packed: pa.StructScalar, ids: np.ndarray, last: bool) -> Edge:
    places = packed["places"].values.to_numpy().reshape(-1, 2)
    n = len(places)
    return Edge(packed["text"].as_py(), ids[len(ids) - n:] if last else ids[:n], places[:, 0], places[:, 1])


def _int_lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts])
    flat = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int32()))


class Decoder:
    """Texts of id lists. A file without a decoder has its tokens joined by one space; with one, the library decodes."""

    def __init__(self, tokens: list[str | None], spec: str | None):
        self.tokens, self.library = tokens, Tokenizer.from_str(spec) if spec else None

    @staticmethod
    def read(path: str) -> tuple[list[str | None], str | None]:
        library = Tokenizer.from_file(path)
        shown = {k: t for t, k in library.get_vocab(with_added_tokens=True).items()}
        return [shown.get(k) for k in range(max(shown, default=-1) + 1)], library.to_str() if library.decoder is not None else None

    def __call__(self, ids: np.ndarray) -> str:
        if self.library is not None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.tokens)):
            ids = ids[(ids >= 0) & (ids < len(self.tokens))]
        return " ".join(filter(None, map(self.tokens.__getitem__, ids.tolist())))


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", leaf: int = LEAF, window: int = WINDOW,
           drop_text: bool = False, decoded: str | None = None) -> DataFrame:
    """Add ``out``, the token ids (array of int) of the whole text as the tokenizer file at ``path`` gives them.

    Texts of up to ``leaf`` code points are encoded where they are read. Longer ones are halved until no part is longer, all parts
    go to tasks by (hash of the text, part), are encoded there on their own, and meet again by text to be joined two by two
    (see :func:`join`). What meets is the ids and the ends of the parts, not the texts; equal long texts are worked on once,
    however many rows share one. So neither a very long text nor a very common one is one task's work.

    Null and empty texts give an empty list. Rows may repeat, also with null ids; every other column is passed on, whatever its
    name; an ``out`` that exists is replaced. ``decoded`` names a column for the text that the ids decode to (see :func:`decode`), made
    in the same pass. A tokenizer file whose rules are not those that :func:`join` relies on (see
    :class:`WordEncoder`) has every text encoded whole. The text column itself is left out if ``drop_text``. Empty input gives an empty table.
    """
    docs = docs.drop(out, *([decoded] if decoded else []))
    rules = read_rules(path)
    shared = docs.sparkSession.sparkContext.broadcast(rules)  # as large as the tokenizer file
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(decoded, T.StringType())] if decoded else []))
    shown = docs.sparkSession.sparkContext.broadcast(Decoder.read(path) if decoded else None)

    def finished(columns: list, ids: list[np.ndarray], decoder: Decoder | None) -> pa.RecordBatch:
        columns = [*columns, _int_lists(ids)]
        if decoder:
            columns.append(pa.array([decoder(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def whole(batches):
        encoder, decoder = word_encoder(shared.value), Decoder(*shown.value) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = encoder.batch(part.column(text).cast(pa.binary()).to_pylist())
                yield finished([part.column(c) for c in names], ids, decoder)

    if not rules.by_words:
        return docs.mapInArrow(whole, schema)
    size = F.coalesce(F.length(F.col(f"`{text}`")), F.lit(0))
    short = docs.where(size <= leaf).mapInArrow(whole, schema)

    narrow = np.dtype("<u2" if rules.tokens <= 1 << 16 else "<i4")  # ids as they are shuffled
    h1, h2 = fresh_names(docs, "h1", "h2")
    long = docs.where(size > leaf).withColumns({h1: F.xxhash64(f"`{text}`"), h2: F.xxhash64(F.lit(1), f"`{text}`")})

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                parts = halves(batch.column(2)[row].as_py(), leaf)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array([row] * len(parts))) for c in (0, 1)]
                    + [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())], names=["h1", "h2", "no", "part"])

    parts = long.select(h1, h2, f"`{text}`").mapInArrow(cut, "h1 bigint, h2 bigint, no int, part string")
    parts = parts.groupBy("h1", "h2", "no").agg(F.first("part").alias("part"))

    def leaves(batches):
        encoder = word_encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                nodes = leaf_nodes(encoder, part.column("part").to_pylist())
                edge = pa.struct([("text", pa.string()), ("places", pa.list_(pa.int32()))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("h1"), part.column("h2"), part.column("no"),
                     pa.array([n.ids.astype(narrow).tobytes() for n in nodes], pa.binary()),
                     pa.array([_packed(n.head) for n in nodes], edge),
                     pa.array([None if n.whole else _packed(n.tail) for n in nodes], edge), pa.array([n.whole for n in nodes])],
                    names=["h1", "h2", "no", "ids", "head", "tail", "whole"])

    def joined(key: tuple, rows: pa.Table) -> pa.Table:
        encoder = word_encoder(shared.value)
        rows = rows.sort_by("no").combine_chunks()
        nodes = []
        for k in range(len(rows)):
            ids = np.frombuffer(rows.column("ids")[k].as_py(), narrow).astype(np.int32)
            head = _unpacked(rows.column("head")[k], ids, False)
            whole_ = rows.column("whole")[k].as_py()
            nodes.append(Node(ids, head, head if whole_ else _unpacked(rows.column("tail")[k], ids, True), whole_))
        ids = tree(encoder, nodes, window).ids.astype(narrow).tobytes()
        return pa.table({"h1": rows.column("h1")[:1], "h2": rows.column("h2")[:1], "ids": pa.array([ids], pa.binary())})

    def widened(batches):
        decoder = Decoder(*shown.value) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [np.frombuffer(x, narrow).astype(np.int32) for x in part.column(len(names)).to_pylist()]
                yield finished(part.columns[:-1], ids, decoder)

    nodes = parts.mapInArrow(leaves, _NODE).groupBy("h1", "h2").applyInArrow(joined, "h1 bigint, h2 bigint, ids binary")
    g1, g2, found = fresh_names(long, "h1", "h2", "found")
    nodes = nodes.select(F.col("h1").alias(g1), F.col("h2").alias(g2), F.col("ids").alias(found))
    # always a sort-merge join: which side is small depends on the copies, and the ids are the larger part of what is shuffled
    long = long.join(nodes.hint("merge"), (F.col(h1) == F.col(g1)) & (F.col(h2) == F.col(g2)))
    return short.unionAll(long.select(*[F.col(f"`{c}`") for c in names], found).mapInArrow(widened, schema))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the text that the tokenizer file's decoder makes of each row's ids, special tokens shown.

    A file without a decoder has its tokens joined by one space; with one, the library decodes. Ids that are not in the
    vocabulary are skipped, as the library does. Null and empty lists give an empty text.
    """
    encoded = encoded.drop(out)
    shown = encoded.sparkSession.sparkContext.broadcast(Decoder.read(path))  # as large as the tokenizer file

    def run(batches):
        decoder = Decoder(*shown.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [decoder(v.values.to_numpy()) if v.is_valid else "" for v in part.column(ids)]
                yield part.append_column(out, pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())]))
