"""Table and file writers. All writes run on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from offerloom import schemas
from offerloom.operators.offers import project_to, stamp_job, to_warehouse_row


def write_offers(offers: DataFrame, path: str, job_id: str | None = None) -> DataFrame:
    """Append shaped offers to the offers table, partitioned by job. Unknown
    columns are dropped. An empty input adds no rows. Returns what is stored."""
    rows = offers if job_id is None else stamp_job(offers, job_id)
    shaped = project_to(to_warehouse_row(rows), schemas.WAREHOUSE)
    shaped.write.mode("append").partitionBy("job_id").parquet(path)
    return shaped


def write_offer_dump(offers: DataFrame, path: str) -> None:
    """Offers as JSON lines; a batch table format for re-reading."""
    offers.write.mode("error").json(path)


def load_dump(dump: DataFrame, path: str, size: int = 500) -> None:
    """Store a dump with at most ``size`` rows a file."""
    shaped = project_to(to_warehouse_row(dump), schemas.WAREHOUSE)
    shaped.write.mode("append").option("maxRecordsPerFile", size).partitionBy(
        "job_id"
    ).parquet(path)


def write_found_missing(report: DataFrame, path: str, sku: str = "sku") -> None:
    """``<path>/found`` as ``sku,url`` and ``<path>/not_found`` as ``sku``, both
    without a header."""
    found = report.where(F.col("url").isNotNull())
    found.select(sku, "url").write.mode("error").csv(f"{path}/found")
    report.where(F.col("url").isNull()).select(sku).write.mode("error").csv(
        f"{path}/not_found"
    )
