"""Missing-value rules.

The crawled records treat "", 0, false and NaN as missing, while empty lists
count as present. Plain ``coalesce`` does not express that.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def blank_to_null(c: Column) -> Column:
    """Empty text becomes NULL; other text is untouched."""
    return F.nullif(c, F.lit(""))


def falsy_to_null(c: Column, dtype: T.DataType) -> Column:
    """NULL for "", 0, NaN and false; lists and structs pass through."""
    if isinstance(dtype, T.StringType):
        return blank_to_null(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when((c != 0) & ~F.isnan(c), c)
    if isinstance(dtype, T.NumericType):
        return F.when(c != 0, c)
    return c
