"""Column-level building blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between the parts of a surrogate key.
KEY_SEPARATOR = "|"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: Column | str, sentinel: Any) -> Column:
    """NULL where the value equals the sentinel; NULL input stays NULL."""
    return F.nullif(_column(c), F.lit(sentinel))


def mask(c: Column | str, integral: bool = True, salt: str | None = None) -> Column:
    """SHA-256 hex digest of the value's text; NULL stays NULL.

    ``integral`` normalises the number first, so -3000 and -3000.0 give one digest.
    Without a salt a small integer domain can be enumerated; pass one where the digest
    does not have to equal that of other systems.
    """
    value = _column(c)
    text = (value.cast("bigint") if integral else value).cast("string")
    if salt is not None:
        text = F.concat(F.lit(salt), text)
    return F.sha2(text, 256)


# Fixed values of HMAC: block length of SHA-256 in bytes, inner and outer pad.
_HMAC_BLOCK, _INNER, _OUTER = 64, 0x36, 0x5C


def keyed_mask(c: Column | str, key: bytes, integral: bool = True) -> Column:
    """HMAC-SHA256 hex digest of the value's text under a secret key; NULL stays NULL.

    Unlike a digest with a salt in front it cannot be extended, and without the key a small
    domain cannot be enumerated. Built-in expressions only: the key enters as two padded blocks.
    """
    if not key:
        raise ValueError("a keyed mask needs a key")
    short = hashlib.sha256(key).digest() if len(key) > _HMAC_BLOCK else key
    padded = short.ljust(_HMAC_BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in padded)) for pad in (_INNER, _OUTER))
    value = _column(c)
    text = (value.cast("bigint") if integral else value).cast("string").cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the parts' text joined by ``|``, with NULL read as the empty string.

    Build keys from integers, strings, dates or timestamps only: the text form of a
    floating-point number differs between engines.
    """
    texts = [F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division giving NULL, not an error, for a zero denominator."""
    return _column(numerator) / F.nullif(_column(denominator), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Share of ``part`` in ``whole`` as a double between 0 and 100."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))


def day_gap(end: Column | str, start: Column | str) -> Column:
    """Difference of two relative-day numbers; positive means ``end`` is later."""
    return _column(end) - _column(start)


def bracket(c: Column | str, edges: Sequence[float]) -> Column:
    """Index of the value's bracket among ascending edges: 0 below the first edge.

    A constant-size CASE, so no global ranking of the rows is needed.
    """
    value = _column(c)
    result = F.when(value < edges[0], F.lit(0))
    for position, edge in enumerate(edges[1:], start=1):
        result = result.when(value < edge, F.lit(position))
    return F.when(value.isNotNull(), result.otherwise(F.lit(len(edges))))


def unit_hash(c: Column | str, salt: int) -> Column:
    """Reproducible number in [0, 1) from a key, independent of partitioning and retries."""
    buckets = 1 << 30
    return F.pmod(F.xxhash64(_column(c), F.lit(salt)), F.lit(buckets)).cast("double") / F.lit(
        float(buckets)
    )
