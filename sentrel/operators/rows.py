"""Row filters evaluated where they stand.

Catalyst pushes a ``Filter`` below every deterministic projection and
substitutes each alias in the predicate by its defining expression. For a
predicate over columns that are themselves built from many references to
earlier columns (offsets parsed out of a text cell, a marked sentence built
from those offsets, ...) the substituted predicate grows multiplicatively with
every projection it passes, and is then evaluated per row without sharing.
``keep_rows`` expresses the filter as a generator (``explode`` of a 0/1-element
array), which the optimizer does not move, so the predicate reads the already
computed columns once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEEP = "_keep_row"


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Rows where ``cond`` is true (NULL counts as false), evaluated in place."""
    return df.select("*", F.explode(F.when(cond, F.array(F.lit(True)))).alias(_KEEP)).drop(_KEEP)
