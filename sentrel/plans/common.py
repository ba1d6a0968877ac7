"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.session import materialize  # noqa: F401


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output normal form: integral columns BIGINT, floating columns DOUBLE
    rounded to ``digits`` places (so results compare across engines)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def join_ints(arr) -> Column:
    """Integer array as text ``a,b,c`` (arrays compare as text across engines)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    text = F.to_json(a)  # several times faster than a text for each number
    inner = F.substring(text, F.lit(2), F.octet_length(text) - 2)
    return F.when(F.contains(text, F.lit("null")), F.array_join(a.cast("array<string>"), ",")).otherwise(inner)


def join_doubles(arr, digits: int = 6) -> Column:
    """Double array as text with fixed decimals."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(F.transform(a, lambda x: F.format_string(f"%.{digits}f", F.bround(x, digits))), ",")
