"""Helpers the operators of this subpackage share: tables, stored intermediate results, hashed words."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage is cut and the loss of an executor costs one task."""
    return checkpointed(df, name)


def fold(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(parts)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Array of the words of a whole text; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SLICE = 1 << 17  # bytes of text hashed at once; bounds a task's memory, not what it reads


@functools.lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and its inverses modulo 2^64."""
    up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(int(_BASE), -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every bit of a hash depends on every bit of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, most: int = _SLICE):
    """Cut a string column into runs of whole texts: (first row, bytes, offsets). Nulls count as empty texts.

    A run holds about ``most`` bytes; one longer text is a run of its own and is never cut.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        data = np.zeros(0, np.uint8)
    else:
        data = np.frombuffer(column.buffers()[2], np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lower-cased) of a run of texts, and for each text where its words begin.

    One pass of prefix sums over the bytes: no Python object per word. Words never reach over the end of a text.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    upper = (data >= 65) & (data <= 90)
    low = data.astype(np.uint64) + np.uint64(1) + np.where(upper, np.uint64(32), np.uint64(0))
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = powers(max(_SLICE, n))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low * up[:n], out=total[1:])
    return mix((total[last + 1] - total[first]) * down[first]), np.searchsorted(first, offsets)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """Hashes of the runs of ``n`` words of each text, repeats included; a shorter text is one run of all its words."""
    each = [np.zeros(0, np.uint64)] * (len(bounds) - 1)
    if not len(hashes):
        return each
    with np.errstate(over="ignore"):
        seed = mix(np.array([n], np.uint64))[0]
        runs = np.full(max(0, len(hashes) - n + 1), seed, np.uint64)
        for j in range(n):
            runs = mix(runs * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + len(runs)])
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b - a >= n:
                each[k] = runs[a:b - n + 1]
            elif b > a:
                one = mix(np.array([b - a], np.uint64))
                for h in hashes[a:b]:
                    one = mix(one * np.uint64(0xD6E8FEB86659FD93) + h)
                each[k] = one
    return each
