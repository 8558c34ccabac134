"""Written tables, texts as Arrow batches, and row filters shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.session import materialize

__all__ = ["ascii_lower", "column", "kept_rows", "map_batches", "materialize", "numbered", "text_digest", "text_or_empty", "unique_name"]


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return df["`" + name.replace("`", "``") + "`"]


def unique_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def text_or_empty(df: DataFrame, text: str) -> Column:
    return F.coalesce(column(df, text).cast("string"), F.lit(""))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a batch function inside tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    # by position: mapInArrow does not take every column name
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, schema)


def ascii_lower(text: Column) -> Column:
    """The text with A-Z lower-cased and all else as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def text_digest(text: Column, lowered: bool = False) -> Column:
    """SHA-256 of a text in UTF-8, A-Z lower-cased first when asked."""
    return F.unhex(F.sha2(ascii_lower(text) if lowered else text, 256))


def kept_rows(docs: DataFrame, listed: DataFrame, id_col: str, text_col: str, lowered: bool = False) -> DataFrame:
    """Rows of ``docs`` whose (id, text digest) is listed, one of each; null ids match null.

    The join key is one hash of both, so no text or id gathers rows in a task
    unless the very same row repeats, and the documents are shuffled once.
    """
    mine, theirs, pair, turn = (unique_name(docs, s) for s in ("digest", "digest_listed", "pair", "turn"))
    wanted = unique_name(docs, "id_listed")
    right = listed.select(F.col("doc_id").alias(wanted), F.col("digest").alias(theirs)).withColumn(pair, F.xxhash64(wanted, theirs)).distinct()
    left = docs.withColumn(mine, text_digest(text_or_empty(docs, text_col), lowered))
    left = left.withColumn(pair, F.xxhash64(column(docs, id_col).cast("bigint"), F.col(mine)))
    same = F.col(mine) == F.col(theirs)
    joined = left.join(right, pair).where(same & column(left, id_col).cast("bigint").eqNullSafe(F.col(wanted)))
    first = F.row_number().over(Window.partitionBy(pair, mine, wanted).orderBy(mine))
    return joined.withColumn(turn, first).where(F.col(turn) == 1).select(*[column(joined, c) for c in docs.columns])


def numbered(rows: DataFrame, within: str, by: list[str], name: str, label: str) -> DataFrame:
    """``rows`` with a gapless number from 0 inside each value of ``within``, in the order of ``by``.

    One range shuffle; no task holds a whole value of ``within``. Rows that are
    equal in all of ``by`` are dealt over several tasks. The values of ``within``
    are integers without null.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [within, *by]
    # the place of a row in its input spreads equal rows; which of them comes first is open
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_tie").sortWithinPartitions(*keys, "_tie")
    place = F.monotonically_increasing_id()
    stored = materialize(dealt.drop("_tie").withColumn("_part", F.spark_partition_id()).withColumn("_place", place.bitwiseAND((1 << 33) - 1)), label)
    # a part holds neighbouring values: parts and values together, at most, are the rows here
    runs = stored.groupBy(within, "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = runs.select(within, "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return stored.join(F.broadcast(shift), [within, "_part"]).withColumn(name, F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")
