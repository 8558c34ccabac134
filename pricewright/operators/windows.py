"""Ranking, running values, limits, ordering and set operations."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.operators.aggregates import count_mean
from pricewright.operators.lookup import lookup_join
from pricewright.operators.select import price_tail
from pricewright.session import materialize
from pricewright.vocab import size_order, values_table

ROWS_PER_SLICE = 5_000_000


def top_k(groups: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k largest groups by count; equal counts are ordered by key.

    Ranking runs over the k rows a bounded top-k sort leaves, never over all groups.
    """
    top = groups.orderBy(F.desc("count"), F.asc(key)).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("count"), F.asc(key)))
    return top.withColumn("rank", rank)


def top_k_by_tail(
    df: DataFrame, feature: str, tail: str, low: float, high: float, k: int = 10, price: str = "sold_price"
) -> DataFrame:
    """Most frequent values of a feature inside one price tail, with their mean price."""
    return top_k(count_mean(price_tail(df, tail, low, high, price), feature, price), feature, k)


def top_k_per_group(groups: DataFrame, by: list[str], key: str, k: int = 10) -> DataFrame:
    """Top k per group; the rank filter is applied per task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc("count"), F.asc(key))
    return groups.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recent_predictions(df: DataFrame, session: str, at: str, tie: str, k: int = 10) -> DataFrame:
    """The last k predictions of each session, newest first."""
    w = Window.partitionBy(session).orderBy(F.desc(at), F.desc(tie))
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= k)


def _slice_by_lead(df: DataFrame, lead_name: str, slices: int) -> DataFrame:
    """Slices of about equal size along the leading order column (no shuffle)."""
    lead, kind = F.col(lead_name), dict(df.dtypes)[lead_name]
    if kind.startswith("timestamp"):
        lead = F.unix_micros(lead.cast("timestamp"))
    elif kind == "date":
        lead = F.unix_date(lead)
    elif kind == "string":
        # strings are sliced by range below
        return df.withColumn("__slice", F.lit(0.0))
    sliced = df.withColumn("__lead", lead.cast("double"))
    cuts = sliced.approxQuantile("__lead", [i / slices for i in range(1, slices)], 1 / (10 * slices))
    if not cuts:  # a column of missing values only: one slice
        return df.withColumn("__slice", F.lit(-1.0))
    cuts = [float("-inf")] + sorted(set(cuts)) + [float("inf")]
    buckets = Bucketizer(splits=cuts, inputCol="__lead", outputCol="__bucket", handleInvalid="keep").transform(sliced)
    # missing values sort first, as they do in the window
    return buckets.withColumn("__slice", F.when(F.col("__lead").isNull(), -1.0).otherwise(F.col("__bucket"))).drop(
        "__lead", "__bucket"
    )


def _slice_by_range(df: DataFrame, order: list[str], slices: int) -> DataFrame:
    """Slices along all order columns, for a leading column with hot values.

    The range bounds are sampled, so the sliced rows are written once; every
    later step, also after a lost executor, sees the same slices.
    """
    ranged = df.repartitionByRange(slices, *[F.asc(c) for c in order])
    return materialize(ranged.withColumn("__slice", F.spark_partition_id().cast("double")), "slices")


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Running sum, count, min or max over ordered rows, also inside hot groups.

    ``values`` maps an output name to (function, expression). When the table is
    too large for one task per group, the ordered rows are cut into slices: each
    slice is windowed by itself and the totals of the slices before it are added,
    so a group that holds a third of all rows still spreads over many tasks. The
    result is the same for any slicing.
    """
    combine = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    single = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    until = 0 if inclusive else -1
    ordering = [F.asc(c) for c in order]
    slices = max(1, -(-df.count() // rows_per_slice))
    if slices == 1:
        w = Window.partitionBy(*by).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, until)
        return df.withColumns({name: single[fn](expr).over(w) for name, (fn, expr) in values.items()})

    sliced = _slice_by_lead(df, order[0], slices)
    largest = sliced.groupBy(*by, "__slice").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if largest > 3 * rows_per_slice:
        sliced = _slice_by_range(df, [*by, *order], slices)

    own = Window.partitionBy(*by, "__slice").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, until)
    inner = sliced.withColumns({f"__own_{n}": single[fn](e).over(own) for n, (fn, e) in values.items()})
    totals = sliced.groupBy(*by, "__slice").agg(*[single[fn](e).alias(f"__total_{n}") for n, (fn, e) in values.items()])
    earlier = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__key{i}") for i, c in enumerate(by)],
        F.col("__slice").alias("__at"),
        *[combine[fn](f"__total_{n}").over(earlier).alias(f"__before_{n}") for n, (fn, _) in values.items()],
    )
    matches = F.col("__slice") == F.col("__at")
    for i, c in enumerate(by):
        matches = matches & F.col(c).eqNullSafe(F.col(f"__key{i}"))
    joined = inner.join(offsets, matches, "left")

    def merged(name: str, fn: str) -> Column:
        own_value, before = F.col(f"__own_{name}"), F.col(f"__before_{name}")
        if fn == "count":
            return F.coalesce(before, F.lit(0)) + own_value
        if fn == "sum":
            return F.coalesce(before + own_value, before, own_value)
        return F.least(before, own_value) if fn == "min" else F.greatest(before, own_value)

    return joined.select(*df.columns, *[merged(n, fn).alias(n) for n, (fn, _) in values.items()])


def running_best(
    runs: DataFrame, by: list[str], order: list[str], metric: str = "rmsle_eval", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Tuning progress: 0-based attempt number and the best metric so far."""
    out = running(
        runs,
        by,
        order,
        {"__seen": ("count", F.lit(1)), f"running_{metric}": ("min", F.col(metric))},
        rows_per_slice=rows_per_slice,
    )
    return out.withColumn("try", F.col("__seen") - 1).drop("__seen")


def with_size_rank(df: DataFrame, size: str = "size") -> DataFrame:
    """Place of a size in the display order; unknown sizes sort last."""
    ranks = values_table(df.sparkSession, size_order(), [size, "size_rank"])
    return lookup_join(df, ranks, size, rows=len(size_order())).withColumn(
        "size_rank", F.coalesce("size_rank", F.lit(len(size_order())))
    )


def take_exact(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in key order; fewer rows are an error."""
    head = df.orderBy(*order).limit(n)
    found = head.count()
    if found != n:
        raise ValueError(f"expected {n} rows, found {found}")
    return head


def head(df: DataFrame, n: int, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """Row-capped scan; the order makes the cap reproducible."""
    narrowed = df.select(*dict.fromkeys([*(columns or df.columns), *order]))
    return narrowed.orderBy(*order).limit(n).select(*(columns or df.columns))


def drop_exact_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def union_same(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def union_ragged(*frames: DataFrame) -> DataFrame:
    """Union of tables with different columns; absent ones become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def number_rows(df: DataFrame, by: list[str], output: str) -> DataFrame:
    """``df`` with gapless numbers from 0 in the order of ``by``, which tells all rows apart.

    One range sort into the session's shuffle partitions; the only window runs
    over one row per partition.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    stored = materialize(ordered.withColumns({"__part": F.spark_partition_id(), "__place": place}), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("__part").agg(F.count("*").alias("__rows"))
    shift = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift"))
    numbered = stored.join(F.broadcast(shift), "__part").withColumn(output, F.col("__place") + F.col("__shift"))
    return numbered.select(*df.columns, output)
