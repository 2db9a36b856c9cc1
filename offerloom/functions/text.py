"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# White space as browsers see it: ASCII blanks plus the no-break space.
WS = r"[\s\u00A0]"


def trim_text(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def squash(c: Column) -> Column:
    """Trim and collapse every run of white space into one blank."""
    return F.regexp_replace(trim_text(c), rf"{WS}+", " ")


def stars(style: Column) -> Column:
    """Star score 0..5 from an inline style such as ``width:80%;``."""
    pct = F.nullif(F.regexp_extract(style, r"width:(\d+)%;", 1), F.lit(""))
    return pct.cast("double") / 100 * 5


def simple(c: Column, dtype: T.DataType) -> Column:
    """Scalars stay, arrays keep scalar items or turn items into JSON,
    structs, maps and variants become JSON text."""
    if isinstance(dtype, T.ArrayType):
        if _nested(dtype.elementType):
            return F.transform(c, lambda x: F.to_json(x))
        return c
    if _nested(dtype):
        return F.to_json(c)
    return c


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType))


def leading_number(c: Column) -> Column:
    """Longest leading decimal number as DOUBLE, NULL when there is none."""
    return F.regexp_extract(c, r"^\s*([+-]?[0-9]*\.?[0-9]*)", 1).try_cast("double")


def leading_integer(c: Column) -> Column:
    """Longest leading integer as DOUBLE, NULL when there is none."""
    return F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1).try_cast("double")
