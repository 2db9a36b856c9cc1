"""Readers with explicit schemas (the article list alone infers its types)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from offerloom import schemas


def read_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None
) -> DataFrame:
    """Captured pages (Parquet or JSON lines)."""
    return spark.read.format(fmt).schema(schema or schemas.PAGES).load(path)


def read_request_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per detail request: ``url``, ``user_data``, ``job_context``."""
    batches = spark.read.schema(schemas.REQUEST_BATCH).json(path)
    return batches.select(
        F.explode("productDetails").alias("r"), F.col("jobContext").alias("job_context")
    ).select("r.url", F.col("r.userData").alias("user_data"), "job_context")


def read_requests(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Category, search or leaf-category requests with their ``label``; leaf
    requests give one row per seed category."""
    schema, label = schemas.REQUESTS[kind]
    rows = spark.read.schema(schema).json(path).withColumn("label", F.lit(label))
    if kind == "leaf_category":
        rows = rows.withColumn("url", F.explode("intermediate_categories"))
    return rows


def read_schedules(spark: SparkSession, path: str) -> DataFrame:
    """Schedule documents: known and seed categories, the rest as VARIANT."""
    text = spark.read.text(path).withColumn("rest", F.try_parse_json("value"))
    return text.select(
        F.try_variant_get("rest", "$.category_urls", "array<string>").alias("category_urls"),
        F.try_variant_get("rest", "$.intermediate_categories", "array<string>").alias(
            "intermediate_categories"
        ),
        "rest",
    )


def import_catalog(spark: SparkSession, csv: str, table: str | None = None) -> DataFrame:
    """Supplier article list with inferred types, saved as a table on demand
    (fails when the table exists)."""
    rows = spark.read.option("header", True).option("inferSchema", True).csv(csv)
    if table is not None:
        rows.write.mode("error").saveAsTable(table)
    return rows


def read_offer_dump(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Offers dumped as a JSON array, or as JSON lines."""
    reader = spark.read.schema(schemas.OFFER_DUMP).option("multiLine", not lines)
    return reader.json(path)


def read_category_dim(spark: SparkSession, path: str) -> DataFrame:
    """Static dimension: category URL -> category path."""
    return spark.read.schema(schemas.CATEGORY_DIM).json(path)
