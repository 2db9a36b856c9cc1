"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives the loss of executors and does not
    compute ``df`` again.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; NULL counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; decides about a broadcast only."""
    return df.limit(rows + 1).count() <= rows


#: Rows per Arrow batch of whole texts; Spark's default of 10,000 rows takes several times the memory.
BATCH_ROWS = 2000


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, after making the session's Arrow batches short enough for whole texts. Changes no result."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df
