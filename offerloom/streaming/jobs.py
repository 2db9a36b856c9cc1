"""Stream jobs.

State is keyed by single URLs, never by a whole run: a run may hold a large
share of all rows. It lies in RocksDB, on disk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from offerloom.operators.cascade import auto_extract
from offerloom.plans.jobs import extract_by_shop
from offerloom.operators.offers import clean_offer, stamp_offer
from offerloom.operators.ranking import number_rows
from offerloom.sinks.messages import popularity_message, publishable, to_messages
from offerloom.sinks.tables import write_offers


def offers_of(pages: DataFrame, registry=None) -> DataFrame:
    """Captured pages -> cleaned offers that passed all checks. No shuffle."""
    found = auto_extract(pages) if registry is None else extract_by_shop(pages, registry)
    found = stamp_offer(found, F.col("fetched_at"))
    cleaned = clean_offer(found, registry)
    return cleaned.where(F.col("reject_reason").isNull()).drop("reject_reason")


def stream_offers(
    pages: DataFrame, path: str, checkpoint: str, registry=None, trigger: dict | None = None
) -> StreamingQuery:
    """Extract, clean and append pages as they arrive."""
    return (
        offers_of(pages, registry)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def stream_frontier(requests: DataFrame, key: str = "unique_key") -> DataFrame:
    """First request per key, however late it is. Keys are remembered for as
    long as the run's checkpoint lives: state ends with the run, not by time, and
    is kept on disk."""
    return use_rocksdb(requests).dropDuplicates([key])


def publish_batches(
    rows: DataFrame,
    checkpoint: str,
    table: str,
    publish: Callable[[DataFrame, str, int], None],
    size: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Every micro-batch becomes a table append and, for jobs that publish,
    listing messages of at most ``size`` rows and popularity messages.

    The append goes to a folder of its own per batch, so a replayed batch
    replaces its earlier attempt. ``publish(messages, kind, batch_id)`` hands
    the messages on; it may see a batch again after a failure.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
            out = publishable(batch).drop("skip_publishing")
            publish(to_messages(out, "popularity_index", ["url"], size), "listings", batch_id)
            publish(popularity_message(out), "popularity", batch_id)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def use_rocksdb(df: DataFrame) -> DataFrame:
    """``df``, after choosing the state store that keeps state on disk, unless one is chosen."""
    conf, name = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(name, ""):
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return df


def first_sights(cards: DataFrame) -> DataFrame:
    """The cards of a stream that show a product of their run for the first time,
    with the time of their batch as ``batch_at``; for output mode ``update``.

    The state of a run and URL is the first card: the earliest batch's lowest
    page and position. A batch looks up the keys it holds, however many came
    before it, and lets those through whose first card is its own.
    """
    at = F.current_timestamp()  # the batch's, also when it is replayed
    place = F.struct(F.col("page_number").isNull(), "page_number", F.col("position").isNull(), "position")
    first = use_rocksdb(cards).select("run", "url", F.struct(at.alias("at"), place.alias("place")).alias("card"))
    state = first.groupBy("run", "url").agg(F.min("card").alias("card"))
    fresh = state.where(F.col("card.at") == F.current_timestamp())
    return fresh.select("run", "url", "card.place.page_number", "card.place.position", F.col("card.at").alias("batch_at"))


def stream_popularity(
    cards: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """First-sight rank of products per run, carried on across batches.

    New products of a batch go to ``<path>/new`` and are numbered behind those of
    earlier batches. Ranks go to ``<path>/ranks`` and the products per run so far,
    one row per run, to ``<path>/counts``, all overwritten per batch id, so a
    replayed batch leaves no trace. A batch reads its own cards and the counts of
    the batch before it, never the ranks. Numbers come from counts per page range,
    so no run is in one task. Batches are told apart by their times: behind a clock
    that has gone back a batch fails, rather than counting products twice.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out = f"{path}/ranks/batch_id={batch_id}"
        run = dict(batch.dtypes)["run"]
        # numbering reads them for counts and again for rows
        new = f"{path}/new/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(new)
        fresh = spark.read.schema(batch.schema).parquet(new)
        ranked = number_rows(fresh, ["run"], "page_number", ["position", "url"], "popularity_index")
        counts = f"run {run}, n bigint, batch_at timestamp"
        before = None
        if batch_id > 0:
            before = spark.read.schema(counts).parquet(f"{path}/counts/batch_id={batch_id - 1}")
            start = before.select(F.col("run").alias("_run"), F.col("n").alias("_before"), F.col("batch_at").alias("_last"))
            late = F.col("batch_at") <= F.col("_last")
            shifted = F.when(
                late, F.raise_error(F.lit("the clock went back behind the last batch")).cast("bigint")
            ).otherwise(F.col("popularity_index") + F.coalesce("_before", F.lit(0)))
            ranked = ranked.join(start, F.col("run").eqNullSafe(F.col("_run")), "left")
            ranked = ranked.withColumn("popularity_index", shifted)
        names = ["run", "url", "page_number", "position", "popularity_index"]
        ranked.select(*names, "batch_at").write.mode("overwrite").parquet(out)
        found = spark.read.schema(f"run {run}, batch_at timestamp").parquet(out)
        found = found.groupBy("run").agg(F.count("*").alias("n"), F.max("batch_at").alias("batch_at"))
        if before is not None:
            both = found.unionByName(before).groupBy("run")
            found = both.agg(F.sum("n").alias("n"), F.max("batch_at").alias("batch_at"))
        found.write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")

    return (
        first_sights(cards)
        .writeStream.outputMode("update")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def store_offers(pages: DataFrame, path: str, job_id: str, registry=None) -> DataFrame:
    """Batch twin of :func:`stream_offers`."""
    return write_offers(offers_of(pages, registry), path, job_id)
