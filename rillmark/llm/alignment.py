"""Cross-tokenizer alignment (operator 11): incidence matrices of tokens, bytes and groups in CSR, multiplied row by row."""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rillmark.llm.common import fresh_names, stored
from rillmark.llm.wordbpe import BYTE_CHARS

CHUNK = 1 << 18  # bytes of text whose matrices a task holds at once; more only where one group is longer
HOT = 1 << 16  # most frequent links, broadcast with their counts

# The pattern by which the library's byte-level splitting cuts a text, and characters on whose classes all
# versions of Unicode agree.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_AGREED = re.compile(r"[\n\t -~\xa1-ſ‐-‧€]*")
_LONG = 1 << 20  # longer texts go to the library, whose splitting needs no look back


@dataclasses.dataclass
class CSR:
    """A sparse matrix of counts by rows: entries of row r are at indptr[r]:indptr[r + 1]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def csr(rows: np.ndarray, cols: np.ndarray, data: np.ndarray, height: int, width: int) -> CSR:
    """A matrix from entries in order of their rows."""
    return CSR(np.searchsorted(rows, np.arange(height + 1)), cols, data, width)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each comes."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def product(x: CSR, y: CSR) -> CSR:
    """x · y by Gustavson: every entry (r, k) of x picks row k of y, scaled; what falls on one column of row r is added."""
    picked = np.diff(y.indptr)[x.indices]
    offset = np.cumsum(picked) - picked
    at = np.arange(int(picked.sum())) + np.repeat(y.indptr[x.indices] - offset, picked)
    key = np.repeat(x.rows * y.width, picked) + y.indices[at]
    value = np.repeat(x.data, picked) * y.data[at]
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    cells = key[first]
    return csr(cells // max(1, y.width), cells % max(1, y.width), np.add.reduceat(value, first) if len(key) else value,
               len(x.indptr) - 1, y.width)


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> CSR:
    """A·Bᵀ of the token-byte incidence matrices of two tokenisations of the same bytes: (a token, b token) → shared bytes."""
    n = int(a_sizes.sum())
    ones = np.ones(n, np.int64)
    a = CSR(np.append(0, np.cumsum(a_sizes)), np.arange(n), ones, n)
    b_t = CSR(np.arange(n + 1), np.repeat(np.arange(len(b_sizes)), b_sizes), ones, len(b_sizes))
    return product(a, b_t)


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every A token and of every B token, and the number of groups.

    A group ends where a token of A and one of B that overlap end at the same byte.
    """
    met = overlaps(a_sizes, b_sizes)
    rows, cols = met.rows, met.indices
    ends = np.cumsum(a_sizes)[rows] == np.cumsum(b_sizes)[cols]
    out = []
    for tokens, size in ((rows, len(a_sizes)), (cols, len(b_sizes))):
        last = np.zeros(size, np.int64)
        last[tokens[ends]] = 1
        out.append(np.cumsum(last) - last)
    return out[0], out[1], int(ends.sum())


def shared_groups(a_group: np.ndarray, b_group: np.ndarray, groups: int) -> CSR:
    """Links of tokens by the product of their group incidence matrices: (a token, b token) that share a group."""
    a = CSR(np.arange(len(a_group) + 1), a_group, np.ones(len(a_group), np.int64), groups)
    b_t = csr(b_group, np.arange(len(b_group)), np.ones(len(b_group), np.int64), groups, len(b_group))
    return product(a, b_t)


class ByteLevel:
    """Tokens of a byte-level BPE tokenizer file; strings of special tokens are plain text."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        parsed = json.loads(spec)
        byte = {chr(c): b for b, c in BYTE_CHARS.items()}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for t, k in vocab.items():
            self.bytes[k] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        self.quick = self._by_ranks(parsed, {bytes(byte[c] for c in t): k for t, k in parsed["model"]["vocab"].items()})

    def _by_ranks(self, spec: dict, ranks: dict[bytes, int]) -> tiktoken.Encoding | None:
        """A faster encoder of the same ids, if ids rise with the merges and nothing else shapes the text."""
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if (spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex")
                or model.get("ignore_merges") or model.get("dropout") or made != sorted(made) or min(made) < 256):
            return None
        return tiktoken.Encoding("ranks", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.quick.encode_ordinary(t) if self.quick and len(t) <= _LONG and _AGREED.fullmatch(t)
                else self.library.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """Tokens of a sentencepiece model."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(k) else p.replace("▁", " ").encode()
                      for k, p in ((k, self.library.id_to_piece(k)) for k in range(self.library.vocab_size()))]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@dataclasses.dataclass
class Aligned:
    """What is known of one text; ``a``, ``b``, ``times`` are its distinct linked id pairs and how many links each has."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    digest: str = ""
    links: list = dataclasses.field(default_factory=list)
    groups: list = dataclasses.field(default_factory=list)

    def pairs(self) -> np.ndarray:
        """(a, b, times) rows, in order of a and b."""
        if len(self.links) < 2:
            return self.links[0] if self.links else np.zeros((3, 0), np.int64)
        a, b, times = np.concatenate(self.links, axis=1)  # a long text came in parts
        key, place = np.unique(a << 32 | b, return_inverse=True)
        return np.stack([key >> 32, key & 0xFFFFFFFF, np.bincount(place, times).astype(np.int64)])


class Aligner:
    def __init__(self, a_spec: str, b_model: bytes):
        self.a, self.b = ByteLevel(a_spec), Pieces(b_model)
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        self.names = [b"%d%c" % (k, c) for t, last in ((self.a, 124), (self.b, 59)) for k in range(len(t.bytes)) for c in (44, last)]

    def __call__(self, texts: list[str | None], detail: bool = False) -> list[Aligned]:
        out = [Aligned() for _ in texts]
        digests = [hashlib.sha256() for _ in texts]
        own = [t or "" for t in texts]
        chunk, held = [], 0
        for d, (a, b) in enumerate(zip(self.a([" " + t for t in own]), self.b(own), strict=True)):
            data = b" " + own[d].encode()
            if not own[d] or any(b"".join(map(t.bytes.__getitem__, x)) != data for t, x in ((self.a, a), (self.b, b))):
                continue
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            out[d].n_a, out[d].n_b = len(a), len(b)
            for part in self._parts(a, b, len(data)):
                chunk.append((d, *part))
                held += part[2]
                if held >= CHUNK:
                    self._solve(chunk, out, digests, detail)
                    chunk, held = [], 0
        if chunk:
            self._solve(chunk, out, digests, detail)
        for x, h in zip(out, digests, strict=True):
            x.digest = h.hexdigest() if x.n_a else ""
        return out

    def _parts(self, a: np.ndarray, b: np.ndarray, n: int):
        """(a ids, b ids, bytes, last) of stretches of a text that end with a group, of about CHUNK bytes."""
        if n <= CHUNK:
            yield a, b, n, True
            return
        ends = [np.cumsum(s[x]) for s, x in zip(self.sizes, (a, b), strict=True)]
        common = np.intersect1d(*ends, assume_unique=True)
        cuts = common[np.unique(np.minimum(np.searchsorted(common, np.arange(CHUNK, n + CHUNK, CHUNK)), len(common) - 1))]
        at = (0, 0, 0)
        for c in cuts:
            end = (*(int(np.searchsorted(e, c, "right")) for e in ends), int(c))
            yield a[at[0]:end[0]], b[at[1]:end[1]], end[2] - at[2], end[2] == n
            at = end

    def _solve(self, chunk: list, out: list[Aligned], digests: list, detail: bool) -> None:
        """Groups and links of the stretches of a chunk, by products of block-diagonal matrices."""
        counts = [np.array([len(x[k]) for x in chunk]) for k in (1, 2)]
        ids = [np.concatenate([x[k] for x in chunk]) for k in (1, 2)]
        ga, gb, n = groups_of(*(s[x] for s, x in zip(self.sizes, ids, strict=True)))
        part = np.repeat(np.arange(len(chunk)), counts[0])
        # links of id pairs: rows (part, a id) by groups, times groups by b ids
        cells, times = counted((part * len(self.sizes[0]) + ids[0]) * n + ga)
        kinds, kind = np.unique(cells // n, return_inverse=True)
        x = csr(kind, cells % n, times, len(kinds), n)
        cells, times = counted(gb * len(self.sizes[1]) + ids[1])
        met = product(x, csr(cells // len(self.sizes[1]), cells % len(self.sizes[1]), times, n, len(self.sizes[1])))
        kind = kinds[met.rows]
        triples = np.stack([kind % len(self.sizes[0]), met.indices, met.data])
        bounds = np.searchsorted(kind // len(self.sizes[0]), np.arange(len(chunk) + 1))
        # `a1,a2|b1;` for every group: where each token stands, and whether it is the last of its kind in its group
        before = [np.append(0, np.cumsum(np.bincount(g, minlength=n))) for g in (ga, gb)]
        text = np.empty(len(ga) + len(gb), np.int64)
        text[np.arange(len(ga)) + before[1][ga]] = 2 * ids[0] + np.append(ga[1:] != ga[:-1], True)
        text[np.arange(len(gb)) + before[0][gb + 1]] = 2 * (len(self.sizes[0]) + ids[1]) + np.append(gb[1:] != gb[:-1], True)
        tokens = np.append(0, np.cumsum(counts[0] + counts[1]))
        starts = [np.append(0, np.cumsum(c)) for c in counts]
        for p, (d, _, _, _, last) in enumerate(chunk):
            said = b"".join(map(self.names.__getitem__, text[tokens[p]:tokens[p + 1]].tolist()))
            digests[d].update(said[:-1] if last else said)
            out[d].links.append(triples[:, bounds[p]:bounds[p + 1]])
            a_of, b_of = ga[starts[0][p]:starts[0][p + 1]], gb[starts[1][p]:starts[1][p + 1]]
            out[d].n_groups += int(a_of[-1] - a_of[0]) + 1
            if detail:
                for g in range(int(a_of[0]), int(a_of[-1]) + 1):
                    out[d].groups.append({"a": ids[0][before[0][g]:before[0][g + 1]], "b": ids[1][before[1][g]:before[1][g + 1]]})
            del a_of, b_of


@functools.lru_cache(maxsize=1)
def _aligner(a_spec: str, b_model: bytes) -> Aligner:
    """One pair of tokenizers for all tasks of a Python worker."""
    return Aligner(a_spec, b_model)


_OUT = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
        ("groups_sha256", T.StringType()), ("a", T.ArrayType(T.IntegerType())), ("b", T.ArrayType(T.IntegerType())),
        ("times", T.ArrayType(T.LongType()))]
_GROUPS = T.ArrayType(T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in "ab"]))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          detail: bool = False) -> DataFrame:
    """The alignment of two tokenisations of each row's whole text: the columns ``keep``, then n_a, n_b, n_groups, n_links,
    groups_sha256, a, b, times (and ``groups`` if ``detail``), as a table written once, with a column ``row`` that is unique.

    A (byte-level BPE file at ``a_path``) encodes a space and the text, B (sentencepiece model at ``b_path``) the text. Bytes at which
    tokens of both end cut them into groups, found from the overlap product of the token-byte incidence matrices; the product
    of the group incidence matrices, with one row per id, counts the links (pairs of an A and a B token of one group) of every id pair:
    links[k] = ``times[k]`` links of ids (a[k], b[k]). ``groups`` holds the ids of each group. groups_sha256 is the hash of
    ``a1,a2|b1;a3|b2,b3``. Matrices are built for CHUNK bytes at a time, cut where a group ends, and links are counted by distinct ids,
    so neither a long text nor a long group is squared.

    Texts that are null, empty, or whose tokens' bytes are not the space and the text (B may normalise) have no tokens: zeros, empty
    lists and an empty digest. Rows may repeat, also with null ids. Empty input gives an empty table. Columns not kept are ignored;
    kept ones must not be named like those added.
    """
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        shared = sc.broadcast((f.read(), g.read()))  # as large as the tokenizer files
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    added = [T.StructField(n, t) for n, t in _OUT] + ([T.StructField("groups", _GROUPS)] if detail else [])
    clash = {c.lower() for c in keep} & {f.name for f in added}
    if clash:
        raise ValueError(f"kept columns {sorted(clash)} are named like those added")
    source = fresh_names(kept, "text")[0]

    def run(batches):
        aligner = _aligner(*shared.value)
        for batch in batches:
            sizes = np.array([s or 0 for s in pa.compute.binary_length(batch.column(source)).to_pylist()], np.int64)
            at = 0
            while at < batch.num_rows:  # texts of about 1 MB, or one longer text
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 20, "right")))
                part = batch.slice(at, end - at)
                rows = aligner(part.column(source).to_pylist(), detail)
                pairs = [r.pairs() for r in rows]
                columns = [pa.array([r.n_a for r in rows], pa.int64()), pa.array([r.n_b for r in rows], pa.int64()),
                           pa.array([r.n_groups for r in rows], pa.int64()),
                           pa.array([int(p[2].sum()) for p in pairs], pa.int64()), pa.array([r.digest for r in rows], pa.string()),
                           _lists([p[0] for p in pairs], pa.int32()), _lists([p[1] for p in pairs], pa.int32()),
                           _lists([p[2] for p in pairs], pa.int64())]
                if detail:
                    columns.append(pa.array([r.groups for r in rows], pa.list_(pa.struct(
                        [("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *columns], names=[*keep, *(f.name for f in added)])
                at = end

    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(source)).mapInArrow(
        run, T.StructType([*kept.schema.fields, *added]))
    # written once, so the numbers stay what they are when a task is repeated
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "aligned")


def _pair(a: Column, b: Column) -> Column:
    """Two ids as one number."""
    return F.shiftleft(a.cast("bigint"), 32).bitwiseOR(b.cast("bigint"))


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, docs, best) of every id pair that some row links: how many rows do, and whether no other B id is linked
    with its A id in more rows. Pairs are counted before the shuffle; the highest counts are one row per A id and are broadcast."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select(_pair(F.col("p.a"), F.col("p.b")).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.count("*").alias("docs")).select(
        "pair", F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "docs")
    counts = stored(counts, "link-counts")
    most = counts.groupBy(F.col("a").alias("_a")).agg(F.max("docs").alias("_most"))
    return counts.join(F.broadcast(most), F.col("a") == F.col("_a")).select(
        "pair", "a", "b", "docs", (F.col("docs") == F.col("_most")).alias("best"))


def rated(aligned: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """``aligned`` with n_best, the links whose pair is best for its A id, and count_sum, the sum of docs over all links.

    The ``hot`` most frequent pairs are broadcast, so the pairs that a large share of all rows have are never shuffled;
    links of all others are joined with their counts by pair. Both parts are summed by row before the last join.
    """
    counts = counts.select("pair", "docs", "best")
    top = F.broadcast(counts.orderBy(F.desc("docs"), "pair").limit(hot))
    links = aligned.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select(
        "row", _pair(F.col("p.a"), F.col("p.b")).alias("pair"), F.col("p.times").alias("times"))
    met = links.join(top, "pair", "left")
    rest = met.where("docs IS NULL").select("row", "pair", "times").join(counts, "pair")

    def sums(df):
        return df.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n"),
                                     F.sum(F.col("docs") * F.col("times")).alias("s"))

    both = sums(met.where("docs IS NOT NULL")).unionAll(sums(rest)).groupBy(F.col("row").alias("_row")).agg(
        F.sum("n").alias("_n"), F.sum("s").alias("_s"))
    return aligned.join(both, F.col("row") == F.col("_row"), "left").withColumns({
        "n_best": F.coalesce("_n", F.lit(0)).cast("bigint"), "count_sum": F.coalesce("_s", F.lit(0)).cast("bigint")}).drop(
        "_row", "_n", "_s")
