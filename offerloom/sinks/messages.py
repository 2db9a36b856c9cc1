"""Messages as rows: one JSON payload per row, ready for any topic writer.

Every job, of one row or of any number, is numbered parts of at most ``size``
records. A payload says which part it is and how many there are, so a subscriber
knows when it has a job whole, and a part that comes twice is told by its key
(job, part, number of parts). No task collects a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.operators.offers import existing
from offerloom.operators.ranking import number_rows


def to_messages(
    rows: DataFrame,
    order: str,
    tie: list[str],
    size: int = 1000,
    job: str = "job_id",
    field: str = "productListings",
    context: Column | None = None,
    ranked: bool = False,
) -> DataFrame:
    """``(job, part, n_parts, n_rows, payload)`` with at most ``size`` rows a
    payload, in order of the integer column ``order``, then ``tie``.

    Rows without an order value come last in their job. ``ranked`` says that
    ``order`` is 1..n among the others already, as popularity ranks are; they
    then need no numbering.
    """
    record = F.struct(*[c for c in rows.columns if c != job]).alias("_r")
    key = F.struct(F.col(job).alias("job")).alias("_j")  # never NULL, although the job may be
    rows = rows.select(job, key, F.col(order).cast("bigint").alias("_order"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)], record)
    ties = [f"_t{i}" for i in range(len(tie))]
    # those without an order value are dealt by a hash: many of them are not one cut
    at = F.coalesce("_order", F.lit(2**62) + F.shiftleft(F.pmod(F.xxhash64(*ties), F.lit(2**16)), 8))
    if ranked:
        counts = rows.groupBy("_j").agg(F.count("_order").alias("_known"), F.count("*").alias("_total"))
        loose = number_rows(rows.where(F.col("_order").isNull()).withColumn("_at", at), ["_j"], "_at", ties, "_n").drop("_at")
        firm = rows.where(F.col("_order").isNotNull()).withColumn("_n", F.col("_order"))
        numbered = firm.unionByName(loose).join(counts, "_j")
        place = F.col("_n") + F.when(F.col("_order").isNull(), F.col("_known")).otherwise(F.lit(0))
        numbered = numbered.withColumn("_n", place)
    else:
        numbered = number_rows(rows.withColumn("_at", at), ["_j"], "_at", ties, "_n", total="_total")
    job_context = F.struct(F.col(job).alias("jobId")) if context is None else context
    parts = numbered.select(
        job,
        F.floor((F.col("_n") - 1) / size).alias("part"),
        F.ceil(F.col("_total") / size).cast("bigint").alias("n_parts"),
        F.struct(F.col("_n").alias("n"), F.col("_r").alias("r")).alias("_e"),
    )
    return (
        parts.groupBy(job, "part", "n_parts")
        .agg(F.sort_array(F.collect_list("_e")).alias("_e"))
        .select(
            job,
            "part",
            "n_parts",
            F.size("_e").alias("n_rows"),
            F.to_json(
                F.struct(
                    F.transform("_e", lambda e: e["r"]).alias(field),
                    job_context.alias("jobContext"),
                    F.col("part"),
                    F.col("n_parts").alias("nParts"),
                )
            ).alias("payload"),
        )
    )


def popularity_message(
    rows: DataFrame, size: int = 1000, job: str = "job_id", ranked: bool = False
) -> DataFrame:
    """Popularity data of a job."""
    return to_messages(rows, "popularity_index", ["url"], size, job, ranked=ranked)


def update_message(
    offers: DataFrame, order: str, tie: list[str], size: int = 1000, job: str = "job_id"
) -> DataFrame:
    """Details of products that were known before; nothing for other jobs."""
    return to_messages(existing(offers), order, tie, size, job, field="productDetails")


def schedule_message(schedules: DataFrame, new: str = "new_categories") -> DataFrame:
    """Schedule with known and new categories united in first-seen order and
    its seeds cleared. Columns other than ``new`` travel along."""
    none = F.array().cast("array<string>")
    united = F.array_distinct(
        F.concat(F.coalesce("category_urls", none), F.coalesce(F.col(new), none))
    )
    keep = [
        c
        for c in schedules.columns
        if c not in ("category_urls", "intermediate_categories", new)
    ]
    return schedules.select(
        *keep,
        F.to_json(F.struct(*keep, united.alias("category_urls"))).alias("payload"),
    )


def publishable(rows: DataFrame, flag: str = "skip_publishing") -> DataFrame:
    """Rows of jobs that publish; the table append does not ask."""
    return rows.where(~F.coalesce(F.col(flag), F.lit(False)))
