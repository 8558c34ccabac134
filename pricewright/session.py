"""Session helpers: settings for local runs and the shared checkpoint folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Terms and vectors in order: starts that neighbours share are written once.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
_cleaning = threading.RLock()
_cleaners: list[str | None] = []


def local_session(cores: str | int = "*", name: str = "pricewright") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session of one machine (tests, laptops) that names none gets a folder below
    its warehouse; a cluster has to name one.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not configured:
        current = context.getCheckpointDir()
        if current is not None:
            # getCheckpointDir ends with a per-context random part
            return current.rsplit("/", 1)[0]
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that end inside are removed then, and not when the driver next collects its garbage."""
    with _cleaning:
        _cleaners.append(spark.conf.get(CLEANUP_KEY, None))
        spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        with _cleaning:
            before = _cleaners.pop()
            # nested and parallel uses: the last one out restores what the first one found
            if not _cleaners:
                spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)


def materialize(df: DataFrame, label: str = "table", compact: bool = False) -> DataFrame:
    """Cut lineage through a parquet table in the shared folder.

    The table survives lost executors and keeps real size statistics, so later
    joins against it are planned from its true size. The shuffles that made it
    are removed once it is written. ``compact`` tables are smaller and take longer.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.options(**COMPACT if compact else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
