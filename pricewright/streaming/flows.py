"""The recurring flows as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from pricewright.operators.experiments import score_valid
from pricewright.operators.models import FittedPriceModel
from pricewright.operators.select import transform_listings
from pricewright.schemas import LISTINGS
from pricewright.sources.writers import only_new, path_exists


def listing_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New JSON-lines batches as they arrive in a folder."""
    return spark.readStream.schema(LISTINGS).option("maxFilesPerTrigger", files_per_trigger).json(path)


def ingest_stream(listings: DataFrame, path: str, checkpoint: str, key: str = "id", day: str = "parsing_date") -> StreamingQuery:
    """Clean arriving listings and append every one, each id once, however late it comes.

    A micro-batch is stored in a folder of its own (column ``batch``), so a batch
    that is replayed after a failure replaces itself. Ids stored by earlier
    batches are left out; of a repeated id inside a batch the first day's row
    stays. Rows without an id are all kept.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = transform_listings(batch)
        order = [F.col(day).asc_nulls_last(), F.xxhash64(*rows.columns)]
        once = F.row_number().over(Window.partitionBy(key, F.when(F.col(key).isNull(), F.monotonically_increasing_id())).orderBy(*order))
        rows = rows.withColumn("__turn", once).where("__turn = 1").drop("__turn")
        if path_exists(spark, path):
            stored = spark.read.parquet(path)
            if "batch" in stored.columns:  # an earlier batch may have had no rows
                rows = only_new(rows, stored.where(F.col("batch") < number), key)
        rows.write.mode("overwrite").partitionBy(day).parquet(f"{path}/batch={number}")

    return (
        listings.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(listings: DataFrame, model: FittedPriceModel, path: str, checkpoint: str) -> StreamingQuery:
    """Score submitted listings batch by batch.

    Results carry the status and the batch number; a batch that is replayed after
    a failure replaces its own folder, so every task has one result.
    """

    def store(batch: DataFrame, number: int) -> None:
        good, bad = score_valid(batch, model)
        rows = good.unionByName(bad, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        listings.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def usage_windows(requests: DataFrame, window: str = "1 day", lateness: str | None = "10 minutes") -> DataFrame:
    """Request statistics per time window and path; works on streams and on tables.

    Without a lateness there is no watermark: requests count however late they come.
    """
    if lateness is not None:
        requests = requests.withWatermark("timestamp", lateness)
    return (
        requests.groupBy(F.window("timestamp", window).alias("w"), "request_path")
        .agg(
            F.count("*").alias("requests"),
            F.avg("response_time").alias("avg_response_time"),
            F.try_divide(
                F.lit(100.0) * F.count_if(F.col("status_code") >= 400).cast("double"), F.count("*")
            ).alias("error_rate"),
        )
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "request_path", "requests", "avg_response_time", "error_rate")
    )


def usage_updates(requests: DataFrame, path: str, checkpoint: str, window: str = "1 day") -> StreamingQuery:
    """Complete usage statistics, open windows included, for as long as the log is read.

    Each micro-batch stores the windows that it touched, with their totals so
    far, in a folder of its own (column ``batch``); a batch that is replayed
    after a failure replaces itself. ``read_usage`` gives the latest totals. The
    state is one row per window and path, without a watermark, so late requests
    count; requests without a timestamp are in no window.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        usage_windows(requests, window, None)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """The latest totals of every window and path that ``usage_updates`` stored."""
    values = ["end", "requests", "avg_response_time", "error_rate"]
    stored = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("bigint"))
    latest = stored.groupBy("start", "request_path").agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return latest.select("start", "last.end", "request_path", "last.requests", "last.avg_response_time", "last.error_rate")


def compact_usage(spark: SparkSession, path: str, output: str) -> None:
    """Write the latest totals as one table, for logs that were read in very many batches."""
    read_usage(spark, path).write.mode("overwrite").parquet(output)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only parquet sink; closed windows are written once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def usage_stream(requests: DataFrame, path: str, checkpoint: str, window: str = "1 day") -> StreamingQuery:
    return append_stream(usage_windows(requests, window), path, checkpoint)
