"""Values derived from a hash of a row key: the same key always gives the same value,
however the data is partitioned and however often a task is retried."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

_SEPARATOR, _MISSING = "\u0001", "\u0002"
HASH_BITS = 60


def hash_hex(keys: list[Column], seed: int | str | None = None) -> Column:
    """md5 hex of the key columns, prefixed by the seed. NULL keys hash as their own value."""
    text = [F.coalesce(k.cast("string"), F.lit(_MISSING)) for k in keys]
    joined = F.concat_ws(_SEPARATOR, *text) if len(text) > 1 else text[0]
    if seed is not None:
        joined = F.concat(F.lit(f"{seed}:"), joined)
    return F.md5(joined)


def _hex_to_long(hex_text: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(hex_text, start, length), 16, 10).cast("bigint")


def hash_long(keys: list[Column], seed: int | str | None = None) -> Column:
    """The first HASH_BITS bits of the hash, as a number that is never negative."""
    return _hex_to_long(hash_hex(keys, seed), 1, HASH_BITS // 4)


def as_fraction(hashed: Column) -> Column:
    """Uniform value in [0, 1) from the leading 32 bits of ``hash_long``."""
    return F.shiftright(hashed, HASH_BITS - 32) / F.lit(float(2**32))


def hash_normals(key: Column, seed: int | str) -> tuple[Column, Column]:
    """Two independent standard normal values per key (Box-Muller on 2 x 52 hash bits)."""
    digest = hash_hex([key], seed)
    u1 = (_hex_to_long(digest, 1, 13) + 1) / F.lit(float(2**52))
    u2 = _hex_to_long(digest, 14, 13) / F.lit(float(2**52))
    radius = F.sqrt(F.log(u1) * -2.0)
    angle = u2 * (2.0 * math.pi)
    return radius * F.cos(angle), radius * F.sin(angle)
