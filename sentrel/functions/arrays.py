"""Array expressions over score vectors (one double per class).

Lambdas read only their own elements: per-row scalars (max, log-sum-exp) are
broadcast into a second array with ``array_repeat`` and zipped, so they are
evaluated once per row, not once per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row: a plain column that a lambda uses may be
    inlined there and computed again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def logsumexp(z) -> Column:
    z = _c(z)
    m = F.array_max(z)
    shifted = F.zip_with(z, F.array_repeat(m, F.size(z)), lambda x, mm: F.exp(x - mm))
    return m + F.log(F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x))


def log_softmax(z) -> Column:
    z = _c(z)
    return F.zip_with(z, F.array_repeat(logsumexp(z), F.size(z)), lambda x, l: x - l)


def softmax(z) -> Column:
    """I03 softmax over the class axis (max-shifted)."""
    return F.transform(log_softmax(z), lambda x: F.exp(x))


def argmax(z) -> Column:
    """I04 index (0-based) of the largest score; first index on ties."""
    z = _c(z)
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def at(z, idx) -> Column:
    """Element at a 0-based index (NULL when out of range)."""
    i = _c(idx)
    return F.when(i >= 0, F.try_element_at(_c(z), (i + 1).cast("int")))


def decode_probs(text) -> Column:
    """E05 whitespace-separated numbers -> array<double>."""
    return F.transform(F.split(F.trim(_c(text)), r"\s+"), lambda x: x.try_cast("double"))


def format_fixed(x, digits: int) -> Column:
    """``%.<digits>f`` text that rounds the exact binary value, as Python and C
    do. ``x * 10**digits`` is split into the rounded product and its exact error
    (Dekker's product), which decides what looks like a tie; true ties go to the
    even digit. NULL and NaN give NULL; magnitudes of 2**52 and more have no decimals."""
    x = _c(x).cast("double")
    a, k = F.abs(x), float(10 ** digits)
    high = a * 134217729.0 - (a * 134217729.0 - a)
    p = a * k
    error = (high * k - p) + (a - high) * k
    low = F.floor(p)
    part = p - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (low % 2 == 1))))
    n = low + F.when(up, 1).otherwise(0)
    n, whole = n.cast("bigint"), F.floor(n / k).cast("bigint")
    rest = F.lpad((n - whole * 10 ** digits).cast("string"), digits, "0")
    text = F.concat_ws(".", whole.cast("string"), rest) if digits else whole.cast("string")
    text = F.when(a >= float(2 ** 52) / k, F.format_string(f"%.{digits}f", a)).otherwise(text)
    sign = F.when((x < 0) | (x.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNotNull() & ~F.isnan(x), F.concat(sign, text))


def format_probs(p, digits: int = 3, sep: str = " ") -> Column:
    """I06 numbers as ``%.<digits>f`` joined by ``sep``."""
    return F.array_join(F.transform(_c(p), lambda x: format_fixed(x, digits)), sep)
