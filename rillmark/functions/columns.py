"""Scalar column expressions. Everything here stays inside Catalyst; there is no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hex_int(text: Column, start: int = 1, digits: int = 8) -> Column:
    """The number written as ``digits`` hexadecimal characters of ``text`` from ``start`` (1-based)."""
    return F.conv(F.substring(text, start, digits), 16, 10).cast("bigint")


def sha_hex(*parts) -> Column:
    """SHA-256, in hex, of the parts joined by ':'. Any engine with SHA-256 can repeat the value."""
    return F.sha2(F.concat_ws(":", *[col(p) for p in parts]), 256)


def sha_int(*parts) -> Column:
    """32-bit number from the first eight hex digits of :func:`sha_hex`; the source of all repeatable randomness."""
    return hex_int(sha_hex(*parts))


def micros(ts) -> Column:
    return F.unix_micros(col(ts))


def time_bucket(ts, seconds: float) -> Column:
    """Number of the fixed-width time bucket that holds ``ts``."""
    return F.floor(micros(ts) / F.lit(int(seconds * 1_000_000))).cast("bigint")


def event_time(text) -> Column:
    """ISO 8601 text to timestamp; unreadable text becomes null instead of failing the job under ANSI rules."""
    return F.try_to_timestamp(col(text))


def hours_since(ts, as_of) -> Column:
    """Hours from ``ts`` to the as-of time, with fractions."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return (F.unix_micros(at) - micros(ts)) / F.lit(3_600_000_000.0)


def safe_ratio(num, den) -> Column:
    """``num / den``, and 0.0 where the denominator is zero or null."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def json_field(text, field: str) -> Column:
    return F.get_json_object(col(text), f"$.{field}")


def is_type(name: str, event_type="event_type") -> Column:
    return col(event_type) == F.lit(name)


def dot(a, b) -> Column:
    """Inner product of two numeric arrays, accumulated in double."""
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v,
    )


def cosine(a, b) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def jaccard(a, b) -> Column:
    """Shared share of two category arrays; 0.0 if either is empty or missing."""
    x, y = col(a), col(b)
    empty = F.coalesce(F.size(x) <= 0, F.lit(True)) | F.coalesce(F.size(y) <= 0, F.lit(True))
    shared = F.size(F.array_intersect(x, y)).cast("double")
    return F.when(empty, F.lit(0.0)).otherwise(shared / F.size(F.array_union(x, y)))


def id_prefix(item) -> Column:
    """The id without its last '_' section."""
    return F.regexp_replace(col(item), "_[^_]*$", "")


# Coefficients of the error-function approximation 7.1.26 in Abramowitz and Stegun.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 (absolute error below 1.5e-7)."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(ERF_A[4])
    for a in reversed(ERF_A[:4]):
        poly = F.lit(a) + t * poly
    return t * poly * F.exp(-x * x)
