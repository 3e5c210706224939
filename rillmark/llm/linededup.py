"""Line dedup (operator 2): segment-partition edit join of lines, verified by banded bit-parallel edit distance."""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import fresh_names, stored
from rillmark.llm.components import components

MOST_WORDS = 1 << 22  # 64-bit words of the bit set that marks wanted lines while texts are read again, at most
SEEN = 100_000  # lines a task remembers, so as not to emit the keys of a repeated line again
_PARITY = 56  # character classes of the parity filter; the bits above hold the role


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the even partition of a string; the later segments take what is left over."""
    base, longer = divmod(length, parts)
    out, at = [], 0
    for k in range(parts):
        size = base + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, threshold: int) -> list[tuple[int, int, int, int]]:
    """(other length, segment, start, size) of the substrings to look up among strings of at most this length.

    Of two strings within ``threshold`` edits, one of the shorter one's segments stands in the longer one near its
    place: at most as many edits lie before it as segments, and what follows must make up for the rest.
    """
    return [x for less in range(threshold + 1) for x in _probes_of(length, less, threshold)]


def _probes_of(length: int, less: int, threshold: int) -> list[tuple[int, int, int, int]]:
    out = []
    for k, (at, size) in enumerate(segments(length - less, threshold + 1) if length >= less else []):
        low = max(0, at - k, at + less - (threshold - k))
        high = min(length - size, at + k, at + less + (threshold - k))
        out += [(length - less, k, start, size) for start in range(low, high + 1)]
    return out


@dataclasses.dataclass(frozen=True)
class Rule:
    """Edits allowed between two lines by the length of the shorter: none under ``least`` code points, one under ``full``,
    else ``threshold``."""

    threshold: int = 2
    least: int = 8
    full: int = 12

    def edits(self, length: int) -> int:
        return 0 if length < self.least else self.threshold if length >= self.full else min(1, self.threshold)


def _parity(lines: list[bytes]) -> np.ndarray:
    """A bit per character class, set if the line has an odd number of them: an edit flips two at most."""
    data = np.frombuffer(b"".join(lines), np.uint8)
    bit = np.where((data & 0xC0) != 0x80, np.uint64(1) << (data % _PARITY).astype(np.uint64), np.uint64(0))
    starts = np.cumsum([0] + [len(x) for x in lines])[:-1]
    return np.bitwise_xor.reduceat(bit, starts).view(np.int64)


def _keys(lines: DataFrame, rule: Rule) -> DataFrame:
    """Segment rows and probe rows (key, id, tag) of every line; a probe at a segment's own place is its segment row.

    id is the line's hash, so no text moves. The tag holds the parity, and above it the role: twice the edits allowed for the length
    that is looked up, and one more for a probe row. A line that a task has met of late gives no rows again.
    """
    def emit(batches):
        plans: dict[int, tuple] = {}
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                met = dict(zip(part.column("h1").to_pylist(), part.column("line").to_pylist(), strict=True))
                own = {h: s for h, s in met.items() if h not in seen}
                seen = {*own} if len(seen) > SEEN else seen | own.keys()
                if not own:
                    continue
                keys, roles, counts = [], [], []
                for s in own.values():
                    n = len(s)
                    if n not in plans:
                        mine = {(n, k, a, z) for k, (a, z) in enumerate(segments(n, rule.edits(n) + 1))}
                        plans[n] = [(x, 2 * rule.edits(n)) for x in mine]
                        for less in range(rule.threshold + 1):
                            edits = rule.edits(n - less)  # those of the shorter line
                            if edits >= max(1, less):
                                plans[n] += [(x, 2 * edits + 1) for x in _probes_of(n, less, edits) if x not in mine]
                        if len(plans) > 1 << 13:
                            plans = {n: plans[n]}
                    for (m, k, a, z), role in plans[n]:
                        keys.append(xxhash.xxh64_intdigest(s[a:a + z].encode(), m * 16 + k))
                        roles.append(role)
                    counts.append(len(plans[n]))
                parity = np.repeat(_parity([s.encode() for s in own.values()]), counts)
                yield pa.record_batch({
                    "key": pa.array(np.array(keys, np.uint64).view(np.int64)),
                    "id": pa.array(np.repeat(np.array(list(own), np.int64), counts)),
                    "tag": pa.array(np.array(roles, np.int64) << _PARITY | parity)})

    return lines.select("h1", "line").mapInArrow(emit, "key bigint, id bigint, tag bigint")


def banded_distances(a: list[str], b: list[str], threshold: int) -> np.ndarray:
    """Whether each pair of strings is within ``threshold`` edits.

    Bit-parallel: a word holds the vertical differences of the 2 * threshold + 1 rows around the diagonal; the band moves
    down one row with each character of ``b``. All pairs advance together, one character at a time.
    """
    m, n = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    width, top = 2 * threshold + 1, np.uint64(2 * threshold)
    full = np.uint64((1 << width) - 1)

    def codes(texts, before, after, filler):
        out = np.full((len(texts), before + max(map(len, texts), default=0) + after), filler, np.int32)
        for k, x in enumerate(texts):
            out[k, before:before + len(x)] = np.frombuffer(x.encode("utf-32-le"), np.int32)
        return np.ascontiguousarray(out.T)

    steps = int(n.max(initial=0))
    ca, cb = codes(a, threshold, int(max(0, steps + threshold - m.max(initial=0))) + 1, -1), codes(b, 0, 1, -2)
    one = np.uint64(1)
    plus = np.full(len(a), full ^ np.uint64((1 << threshold) - 1), np.uint64)
    minus, distance = np.zeros(len(a), np.uint64), np.minimum(m, threshold)
    for j in range(1, steps + 1):
        match = np.zeros(len(a), np.uint64)
        for r in range(width):  # bit r: row j - threshold + r
            match |= (ca[j - 1 + r] == cb[j - 1]).astype(np.uint64) << np.uint64(r)
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & full
        up = (minus | ~(zero | plus)) & full
        down = zero & plus
        low = np.clip(m - j + threshold, 0, width - 1).astype(np.uint64)  # bit of the last row, once it is in the band
        along = (up >> low & one).astype(np.int64) - (down >> low & one).astype(np.int64)
        step = np.where(j + threshold <= m, 1 - (zero >> top & one).astype(np.int64), along)
        distance = distance + np.where(j <= n, step, 0)
        plus, minus = (down | ~(zero >> one | up)) & full, zero >> one & up
    return (np.abs(m - n) <= threshold) & (distance <= threshold)


def _within(pairs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose texts (ta, tb; the shorter one first) are within the edits that the rule allows."""
    def verify(batches):
        for batch in batches:
            a, b = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            edits = np.array([rule.edits(len(x)) for x in a], np.int64)
            order = np.lexsort(([len(x) for x in b], edits))
            ok = np.zeros(len(a), bool)
            at = 0
            while at < len(a):  # runs of similar length and equal edits, bounded in cells
                end = at + 1
                while (end < len(a) and edits[order[end]] == edits[order[at]]
                       and (end - at + 1) * (len(b[order[end]]) + 8) <= 1 << 20):
                    end += 1
                pick = order[at:end]
                ok[pick] = banded_distances([a[k] for k in pick], [b[k] for k in pick], int(edits[order[at]]))
                at = end
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    schema = pairs.select("a", "b").schema
    return pairs.select("a", "b", "ta", "tb").mapInArrow(verify, schema)


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no from 0, line, h1, h2) of the lines with a word, edges trimmed; rows with a null doc_id have none."""
    cut = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    cut = cut.where("doc_id IS NOT NULL").withColumn("line", F.trim("line", F.lit(" \t\n\x0b\x0c\r")))
    return cut.where("line <> ''").select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"))


def _marked(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines that may be among ``wanted`` (h1), by a broadcast bit set of 16 bits for each, up to MOST_WORDS words.

    It only keeps texts of other lines out of the shuffle that follows; lines it lets through by chance are joined away.
    """
    words = 1 << max(10, min(MOST_WORDS.bit_length() - 1, (wanted.count() // 4).bit_length()))
    word, bit = F.pmod("h1", F.lit(words)), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(
        F.shiftright("h1", 40), F.lit(64)).cast("int"))
    bits = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return lines.join(F.broadcast(bits), word == F.col("_word")).where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")


def line_links(lines: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between the first lines of classes, a and b as struct(doc_id, line_no), a < b, each pair once."""
    # one exchange for both sides of the join; a line that several tasks have met becomes one row, its segment row if it has one
    keys = _keys(lines.where(F.length("line") >= rule.least), rule).repartition("key").groupBy("key", "id").agg(F.min("tag").alias("tag"))
    x, y = keys.alias("x"), keys.alias("y")
    role = F.shiftright("x.tag", _PARITY)
    low = F.lit((1 << _PARITY) - 1)
    near = F.bit_count(F.col("x.tag").bitwiseXOR(F.col("y.tag")).bitwiseAND(low)) <= role
    probe = F.shiftright("y.tag", _PARITY) % 2 == 1
    a, b = F.col("x.id"), F.col("y.id")
    # two segment rows meet twice, once from each side; a probe row meets a segment row once
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (role % 2 == 0) & near & (a != b) & (probe | (a < b)))
    pairs = stored(met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "line-candidates")
    ends = stored(pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct(), "candidate-ends")
    texts = _marked(lines, ends).join(ends, "h1", "left_semi").groupBy("h1", "h2").agg(F.first("line").alias("line"))
    texts = stored(texts, "candidate-lines")
    # by the first hash there may be two lines, which are both verified
    both = pairs.join(texts.select(F.col("h1").alias("a"), F.struct("h1", "h2").alias("ha"), F.col("line").alias("ta")), "a").join(
        texts.select(F.col("h1").alias("b"), F.struct("h1", "h2").alias("hb"), F.col("line").alias("tb")), "b")
    # the shorter text first, as the probes look for it
    swap = F.length("ta") > F.length("tb")
    both = both.select(F.col("ha").alias("a"), F.col("hb").alias("b"), F.when(swap, F.col("tb")).otherwise(F.col("ta")).alias("ta"),
                       F.when(swap, F.col("ta")).otherwise(F.col("tb")).alias("tb"))
    links = stored(_within(both, rule).distinct(), "hash-links")
    linked = links.select("a.*").union(links.select("b.*")).distinct()
    places = stored(classes.join(linked, ["h1", "h2"], "left_semi").select(
        F.struct("h1", "h2").alias("h"), F.struct("doc_id", "line_no").alias("p")), "linked-classes")
    named = links.join(places.select(F.col("h").alias("a"), F.col("p").alias("p")), "a").join(
        places.select(F.col("h").alias("b"), F.col("p").alias("q")), "b")
    return named.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def line_classes(docs: DataFrame, threshold: int = 2, least: int = 8, full: int = 12) -> DataFrame:
    """Class of every line with a word: (doc_id, line_no, class_doc_id, class_line_no, links, kept).

    Lines (edges trimmed) are one class when they are equal, or when a chain of lines within ``threshold`` edits of code
    points joins them. Since a few edits make any short line of another, the length of the shorter line counts: under
    ``least`` code points lines are joined only by equality, under ``full`` by one edit (see :class:`Rule`).
    The class is named by its first line in order of (doc_id, line_no); only that line is kept. links counts the other
    distinct texts within the threshold.

    1. Equal lines are grouped by a 128-bit hash with a partial minimum: groups of copies of any size cost no pairs.
    2. Every line is cut into one segment more than its edits; of two lines within the threshold one has a segment
       of the other near its place. Segments are joined with the substrings of lines that are as long or up to threshold
       longer, by hashes: no text moves. Lines stand in by their hash and are told apart once per key; the parity of their
       characters filters in the join.
    3. The texts of the lines that have met another are fetched, and each pair is verified once by a banded bit-parallel distance. No pair within the edits allowed is left out.

    Null and empty texts and lines without a word have no rows; a null doc_id has none either. Rows that repeat a doc_id
    share their line numbers and fate: the row of a (doc_id, line_no) with two texts comes once per text. Other
    columns are ignored. Empty input gives an empty table.
    """
    lines = split_lines(docs.select("doc_id", "text"))
    place = F.struct("doc_id", "line_no")
    classes = lines.groupBy("h1", "h2").agg(F.min(place).alias("p")).select("h1", "h2", "p.*")
    classes = stored(classes, "line-classes")
    links = stored(line_links(lines, classes, Rule(threshold, least, full)), "line-links")
    named = components(links)
    degree = links.select(F.col("a").alias("e")).unionAll(links.select("b")).groupBy("e").agg(F.count("*").alias("links"))
    near = named.join(degree, F.col("node") == F.col("e")).select(
        F.col("node.doc_id").alias("doc_id"), F.col("node.line_no").alias("line_no"), "component", "links")
    classes = classes.join(near, ["doc_id", "line_no"], "left").select(
        "h1", "h2", F.coalesce("component", place).alias("first"), F.coalesce("links", F.lit(0)).alias("links"))
    out = lines.select("doc_id", "line_no", "h1", "h2").join(classes, ["h1", "h2"])
    return out.select("doc_id", "line_no", F.col("first.doc_id").alias("class_doc_id"),
                      F.col("first.line_no").alias("class_line_no"), F.col("links").cast("bigint").alias("links"),
                      (place == F.col("first")).alias("kept"))


def _kept_text(drop: Column) -> Column:
    lines = F.split("text", "\n")
    return F.when(drop.isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(lines, lambda line, k: ~F.array_contains(drop, k)), "\n"))


def without_repeated_lines(docs: DataFrame, threshold: int = 2, least: int = 8, full: int = 12) -> DataFrame:
    """The documents with only the first line of each class (see :func:`line_classes`), all columns kept.

    A document that has lost every line with a word goes; one that had none (null, empty, blank) stays as it is, as does
    a row with a null doc_id. n_chars, where there is one, is counted anew.
    """
    ident, drop = fresh_names(docs, "ident", "drop")
    dropped = line_classes(docs, threshold, least, full).where("NOT kept").select("doc_id", "line_no").distinct()
    dropped = dropped.groupBy(F.col("doc_id").alias(ident)).agg(F.collect_list("line_no").alias(drop))
    joined = docs.join(dropped, F.col("doc_id") == F.col(ident), "left").withColumn("text", _kept_text(F.col(drop)))
    kept = joined.where(F.col(drop).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(drop).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
