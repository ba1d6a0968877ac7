"""Deterministic per-row randomness.

Every random choice in the library goes through ``h``: the first 32 bits of
``md5(salt:k1:k2...)`` as a non-negative BIGINT. It depends only on the row's
values, so results do not change with partitioning, retries or executor loss,
and an SQL engine can recompute it (``md5`` + hex parse).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def _key(salt: str, *cols) -> Column:
    parts = [F.lit(str(salt))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.concat_ws(":", *parts)


def h(salt: str, *cols) -> Column:
    """32-bit hash in ``[0, 2**32)`` of ``salt`` and the given columns."""
    return F.conv(F.substring(F.md5(_key(salt, *cols)), 1, 8), 16, 10).cast("bigint")


def md5_key(salt: str, *cols) -> Column:
    """Full md5 hex string; a total order that is stable under any partitioning."""
    return F.md5(_key(salt, *cols))


def hex_part(md5_hex: Column, part: int) -> Column:
    """32-bit slice ``part`` (0..3) of an md5 hex string as a BIGINT; four
    independent draws from one hash."""
    return F.conv(F.substring(md5_hex, 1 + 8 * part, 8), 16, 10).cast("bigint")
