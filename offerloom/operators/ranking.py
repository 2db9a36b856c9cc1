"""Exact row numbers inside groups of any size.

``row_number() over (partition by group)`` sends a whole group to one task.
Here a group is cut along a coarse integer key (a page number, a rank), rows
are counted per cut, and the counts are summed up in two levels. No window ever
sees more than one cut of rows or one block of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def number_rows(
    df: DataFrame,
    group: list[str],
    coarse: str,
    fine: list[str | Column],
    alias: str,
    width_bits: int = 8,
    block_bits: int = 12,
    total: str | None = None,
) -> DataFrame:
    """Add ``alias`` = 1..n per group, in order of ``coarse``, then ``fine``, and
    n itself as ``total``, if a name is given for it.

    A cut holds the rows of ``2**width_bits`` consecutive values of the integer
    ``coarse``, a block the counts of ``2**block_bits`` consecutive cuts. ``(coarse, fine)`` must be a total
    order of the group, else equal rows may swap numbers. Rows with a NULL in
    ``group`` form a group like others, and a NULL ``coarse`` comes last in its
    group.
    """
    # one key that is never NULL, although its fields may be
    key = F.struct(*group)

    def before(n: str, within: list[str], key: str) -> Column:
        frame = (
            Window.partitionBy(*within)
            .orderBy(key)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return F.coalesce(F.sum(n).over(frame), F.lit(0))

    at = F.coalesce(F.col(coarse).cast("bigint"), F.lit(2**62))
    rows = df.withColumn("_g", key).withColumn("_cut", F.shiftright(at, width_bits))
    cuts = (
        rows.groupBy("_g", "_cut")
        .agg(F.count("*").alias("_n"))
        .withColumn("_block", F.shiftright(F.col("_cut"), block_bits))
    )
    blocks = (
        cuts.groupBy("_g", "_block")
        .agg(F.sum("_n").alias("_n"))
        .select(
            "_g",
            "_block",
            before("_n", ["_g"], "_block").alias("_b0"),
            F.sum("_n").over(Window.partitionBy("_g")).alias("_all"),
        )
    )
    starts = (
        cuts.withColumn("_c0", before("_n", ["_g", "_block"], "_cut"))
        .join(blocks, ["_g", "_block"])
        .select("_g", "_cut", (F.col("_b0") + F.col("_c0")).alias("_start"), "_all")
    )
    inside = F.row_number().over(
        Window.partitionBy("_g", "_cut").orderBy(F.col(coarse).asc_nulls_last(), *fine)
    )
    out = rows.join(starts, ["_g", "_cut"]).withColumn(alias, (inside + F.col("_start")).cast("bigint"))
    if total is not None:
        out = out.withColumn(total, F.col("_all").cast("bigint"))
    return out.drop("_g", "_cut", "_start", "_all")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key. Partial aggregation collapses hot keys before
    the shuffle, unlike ``row_number() = 1``. Columns of types without an order
    (maps, VARIANT) travel along; rows that differ in nothing else tie."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    order = [c for c in order if c not in keys]
    if not order and not rest:
        return df.select(*keys).distinct().select(*df.columns)
    loose = [c for c in rest if _unordered(df.schema[c].dataType)]
    if not loose:
        best = F.min(F.struct(*order, *rest)).alias("_first")
    else:
        best = F.min_by(
            F.struct(*order, *rest), F.struct(*order, *[c for c in rest if c not in loose])
        ).alias("_first")
    return df.groupBy(*keys).agg(best).select(*keys, "_first.*").select(*df.columns)


def _unordered(kind: T.DataType) -> bool:
    """Whether a type, or one inside it, has no order."""
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))
