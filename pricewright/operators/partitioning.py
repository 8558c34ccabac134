"""Task balance for small inputs of CPU-heavy jobs, for rows that are passed many times and for rare keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Below this many bytes per core the cost of moving the rows is negligible.
SMALL_SHARE = 8 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a table over all cores when it is tiny and may sit in one split.

    A small parquet file has a single row group and so a single task, however
    long its texts take to process. Larger tables have enough splits and are
    returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if planned_bytes(df) < cores * SMALL_SHARE else df


def keys_together(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys before they are counted, for keys that mostly occur once.

    Sums within the map tasks would hold nearly every row there, fill the tasks'
    memory and spill without making the shuffle smaller.
    """
    return df.repartition(*keys)


# Rows of a task in jobs that pass over them many times.
PASSED_ROWS = 1 << 18


def spread_evenly(df: DataFrame, passed_rows: int = PASSED_ROWS) -> DataFrame:
    """Rows dealt evenly over all cores, in whole rounds of tasks of at most ``passed_rows``.

    A written table of short rows has few files, and a file of one row group is
    one task, so repeated passes over it would leave cores idle. Counts the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, -(-df.count() // (cores * passed_rows)))
    return df.repartition(cores * rounds)
