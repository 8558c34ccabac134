"""Sinks: CSV and JSON-lines files, append-only tables, archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


CSV_TEXT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def only_new(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of the new batch whose key is not stored yet."""
    return new.join(existing.select(key), key, "left_anti")


def _located(spark, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    store, target = _located(spark, path)
    return store.exists(target)


def is_folder(spark, path: str) -> bool:
    """Whether a path is a folder on the file system it names."""
    store, target = _located(spark, path)
    return store.exists(target) and store.getFileStatus(target).isDirectory()


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled and spaces kept, so free text reads back whole."""
    df.write.mode("overwrite").options(**CSV_TEXT).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def one_per_key(df: DataFrame, key: str, first_by: str | None = None) -> DataFrame:
    """One defined row per key: the least by ``first_by``, then by all columns in order.

    Rows of a key combine on the map side, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.dropDuplicates([key])
    lead = [first_by] if first_by in rest else []
    ordered = F.struct(*lead, *[c for c in rest if c not in lead])
    return df.groupBy(key).agg(F.min(ordered).alias("__row")).select(*[key if c == key else F.col("__row")[c].alias(c) for c in df.columns])


def append_batch(
    new: DataFrame, path: str, key: str | None = None, partition_by: str | None = None, first_by: str | None = "parsing_date"
) -> bool:
    """Append a batch to a table, creating it when absent; an empty batch writes nothing.

    Only the batch is written: the stored table is never read back and rewritten.
    With ``key`` the ids already stored (and repeats inside the batch) are left
    out; of rows with one id in a batch the earliest collected stays. Returns
    whether something was written.
    """
    spark = new.sparkSession
    if key is not None:
        new = one_per_key(new, key, first_by)
        if path_exists(spark, path):
            new = only_new(new, spark.read.parquet(path), key)
    new = new.persist()
    try:
        if new.isEmpty():
            return False
        writer = new.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        return True
    finally:
        new.unpersist()


def append_images(new: DataFrame, path: str) -> bool:
    """Add images whose name is not in the archive yet."""
    return append_batch(new.select("name", "content"), path, key="name")


def log_requests(requests: DataFrame, path: str) -> bool:
    """Append request rows, partitioned by day; failed requests are kept with their detail.

    A request that ended in an exception has no status of its own and is stored as 500.
    """
    rows = requests.withColumns(
        {
            "status_code": F.coalesce("status_code", F.when(F.col("error_detail").isNotNull(), 500)),
            "user_agent": F.coalesce("user_agent", F.lit("Unknown")),
            "day": F.to_date("timestamp"),
        }
    )
    return append_batch(rows, path, partition_by="day")


