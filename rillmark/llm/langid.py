"""Language identification by error-correcting output codes (operator 6)."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.common import text_slices

CELLS = 1 << 15  # hashed byte n-grams
UNKNOWN = "und"


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams of 1 to 4 bytes (A-Z lower-cased) that begin at each byte, -1 where one would leave its text."""
    n = len(data)
    low = (data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)).astype(np.uint64)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    out = np.full((4, n), -1, np.int32)
    code = np.zeros(n, np.uint64)
    for k in range(4):
        code[:n - k] |= low[k:] << np.uint64(8 * k)
        cell = ((code + np.uint64(k + 1) * np.uint64(1 << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(49)).astype(np.int32)
        out[k] = np.where(left > k, cell, -1)
    return out


def codewords(classes: int) -> np.ndarray:
    """Rows of +1/-1 bits, one per class: every way to split few classes in two, else the best of 64 seeded random codes."""
    if classes <= 7:
        rows = [(1, *bits) for bits in itertools.product((1, -1), repeat=max(0, classes - 1))]
        splits = [r for r in rows if len(set(r)) > 1]
        return np.array(splits, np.int64).T.reshape(classes, -1)
    rng, best, most = np.random.default_rng(6), None, -1
    length = int(np.ceil(15 * np.log2(classes)))
    for _ in range(64):
        code = rng.choice((-1, 1), (classes, length))
        apart = (length - code @ code.T) // 2
        least = apart[~np.eye(classes, dtype=bool)].min() if np.all(np.abs(code.sum(0)) < classes) else -1
        if best is None or least > most:
            best, most = code, least
    return best


class Model:
    """Weights of one binary classifier per code bit, with the reliability of each bit for each language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True) if len(langs) else counts
        self.code = codewords(len(langs)) if len(langs) > 1 else np.zeros((len(langs), 0), np.int64)
        weights = []
        for bit in self.code.T:
            weights.append(np.log(share[bit > 0].mean(0)) - np.log(share[bit < 0].mean(0)))
        self.weights = np.array(weights).T.reshape(CELLS, -1)
        # expected output of each classifier for each language: its sign is the bit, its size the trust in it
        expected = share @ self.weights * self.code if len(langs) else np.zeros((0, 0))
        self.scale = np.abs(expected).mean(0) if len(langs) else np.zeros(0)
        trust = np.maximum(expected / np.maximum(self.scale, 1e-12), 0.05) if len(langs) else expected
        self.trust = trust / trust.sum(1, keepdims=True) if self.code.size else trust

    def decode(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword by weighted exponential loss, its share of belief, and whether it is ambiguous.

        Ambiguous: two codewords are equally near, or more bits are wrong than the code can correct.
        """
        n = len(outputs)
        if len(self.langs) == 1:
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
        z = np.clip(outputs / self.scale, -8, 8)
        loss = np.stack([(np.exp(-z * c) * t).sum(1) for c, t in zip(self.code, self.trust, strict=True)], 1)
        order = np.sort(loss, 1)
        best = loss.argmin(1)
        belief = np.exp(-4 * (loss - order[:, :1]))
        bits = np.where(z > 0, 1, -1)
        wrong = (bits != self.code[best]).sum(1)
        apart = min((np.sum(a != b) for a, b in itertools.combinations(self.code, 2)), default=1)
        return best, belief.max(1) / belief.sum(1), (order[:, 1] - order[:, 0] < 1e-9) | (wrong > (apart - 1) // 2)


def fit(labelled: DataFrame, lang: str = "lang") -> Model:
    """Learn from (text, lang) rows: n-gram counts of each language over all rows, by Spark.

    What reaches the driver is CELLS numbers per language. Rows with a null text or language teach nothing.
    """
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for first, data, offsets in text_slices(batch.column("text")):
                grams = _grams(data, offsets)
                for k in range(len(offsets) - 1):
                    cells = grams[:, offsets[k]:offsets[k + 1]].ravel()
                    seen = total.setdefault(names[first + k], np.zeros(CELLS, np.int64))
                    seen += np.bincount(cells[cells >= 0], minlength=CELLS)
        for name, seen in total.items():
            full = np.flatnonzero(seen)
            yield pa.record_batch({"lang": pa.array([name] * len(full), pa.string()), "cell": pa.array(full, pa.int32()),
                                   "n": pa.array(seen[full], pa.int64())})

    rows = labelled.select(F.col(lang).alias("lang"), "text").where("lang IS NOT NULL AND text IS NOT NULL")
    got = rows.mapInArrow(count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(got.column("lang").to_pylist(), object)
    langs = sorted(set(names))
    counts = np.zeros((len(langs), CELLS))
    for k, name in enumerate(langs):
        of = names == name
        counts[k, got.column("cell").to_numpy()[of]] = got.column("n").to_numpy()[of]
    return Model(langs, counts)


def identify(docs: DataFrame, model: Model, names: Sequence[str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """Add the predicted language, score (0 to 1) and ambiguous (boolean) to every row, under ``names``; columns so named are replaced.

    Null texts and texts without a letter are ``und`` with score 0 and not ambiguous, as is everything if no language was
    learned. Whole texts are read; the outputs are means over all n-grams, so length does not matter.
    """
    docs = docs.drop(*names)
    lang, score_name, vague_name = names
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS numbers per code bit

    def run(batches):
        m = shared.value
        for batch in batches:
            outputs = np.zeros((batch.num_rows, m.weights.shape[1]))
            if m.weights.size:
                for first, data, offsets in text_slices(batch.column("text")):
                    grams = _grams(data, offsets)
                    for k in range(len(offsets) - 1):
                        cells = grams[:, offsets[k]:offsets[k + 1]].ravel()
                        cells = cells[cells >= 0]
                        if len(cells):
                            outputs[first + k] = np.bincount(cells, minlength=CELLS) @ m.weights / len(cells)
            if m.langs:
                best, score, vague = m.decode(outputs)
                found = [m.langs[k] for k in best]
            else:
                found, score, vague = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            yield (batch.append_column(lang, pa.array(found, pa.string()))
                   .append_column(score_name, pa.array(score, pa.float64())).append_column(vague_name, pa.array(vague)))

    extra = [T.StructField(lang, T.StringType()), T.StructField(score_name, T.DoubleType()),
             T.StructField(vague_name, T.BooleanType())]
    out = docs.mapInArrow(run, T.StructType(docs.schema.fields + extra))
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.langs))
    return out.withColumns({lang: F.when(known, F.col(lang)).otherwise(UNKNOWN),
                            score_name: F.when(known, F.col(score_name)).otherwise(0.0),
                            vague_name: known & F.col(vague_name)})
