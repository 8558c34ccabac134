"""Packing by optimal length buckets and token-budget batches.

Texts longer than ``longest`` are cut into pieces of that length and a rest, so
the histogram of piece lengths has at most ``longest`` rows. Dynamic programming
over it chooses the bucket boundaries of least total padding. Pieces of a bucket
are numbered without gathering a bucket in one task: by slices of bounded size,
whose counts give each slice its offset. Consecutive pieces form batches of at
most ``budget`` tokens, padding included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pricewright.llm.tables import column, map_batches, materialize, text_or_empty
from pricewright.llm.token_counts import text_token_counts

LONGEST = 2048
BUCKETS = 16
BUDGET = 65536
#: Pieces numbered in one task, about.
SLICE_ROWS = 200_000


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least padding.

    ``lengths`` are distinct and rising. Ties take the lower boundary.
    """
    n = len(lengths)
    if not n:
        return []
    size = np.asarray(lengths, np.float64)
    upto = np.concatenate(([0.0], np.cumsum(np.asarray(counts, np.float64))))
    # tokens are the same for every choice: least padding is least padded volume
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    back = []
    for _ in range(min(buckets, n)):
        new, come = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            with_last = cost[:j] + size[j - 1] * (upto[j] - upto[:j])
            come[j] = int(np.argmin(with_last))
            new[j] = with_last[come[j]]
        cost, back = new, [*back, come]
    out, j = [], n
    for come in reversed(back):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(come[j])
    return sorted(out)


def text_lengths(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    named = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), text_or_empty(docs, text_col).alias("body"))

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, n = text_token_counts(batch.column(1), tokenizer)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return map_batches(named, measured, "doc_id bigint, n_tokens bigint").withColumn("row", F.monotonically_increasing_id())


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bucket, batch, slot.

    ``bucket`` is the length that the piece is padded to, ``batch`` numbers the
    batches of a bucket from 0 and ``slot`` the places in a batch. A batch has
    budget // bucket slots, one at least. A text without tokens (null, empty) has
    one row of length 0 without bucket, batch and slot. Rows repeat as in the
    input, also with null ids; an empty table gives no rows; further columns are
    ignored.
    """
    measured = materialize(text_lengths(docs, tokenizer, id_col, text_col), "lengths")
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / longest) - 1)
    pieces = measured.select("doc_id", "row", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("piece"))
    pieces = pieces.select(
        "doc_id", "row", "piece", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest), F.col("n_tokens") - F.col("piece") * longest).alias("length")
    )
    histogram = pieces.where("length > 0").groupBy("length").count().orderBy("length").collect()  # at most ``longest`` rows
    bounds = best_boundaries(np.array([r[0] for r in histogram], np.int64), np.array([r[1] for r in histogram], np.int64), buckets)
    slices = -(-sum(r[1] for r in histogram) // SLICE_ROWS) or 1
    bucket = F.coalesce(*[F.when(F.col("length") <= b, F.lit(b)) for b in bounds], F.lit(None).cast("int"))
    placed = pieces.withColumn("bucket", F.when(F.col("length") > 0, bucket).cast("bigint"))
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(slices)))
    full, none = placed.where("bucket is not null"), placed.where("bucket is null")
    per_slice = full.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("doc_id", "row", "piece"))
    numbered = full.withColumn("within", within).join(offsets, ["bucket", "slice"]).withColumn("at", F.col("offset") + F.col("within") - 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket"))).cast("bigint")
    shown = ["doc_id", "piece", "start", "length", "bucket"]
    return numbered.select(*shown, F.floor(F.col("at") / room).cast("bigint").alias("batch"), (F.col("at") % room).cast("bigint").alias("slot")).unionByName(
        none.select(*shown, F.lit(None).cast("bigint").alias("batch"), F.lit(None).cast("bigint").alias("slot"))
    )
