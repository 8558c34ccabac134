"""Joins against dimension and encoder tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.let import spread

# A dimension of this many short rows stays well below a hundred megabytes.
BROADCAST_ROWS = 500_000


def small_enough(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Count the table, reading no further than the limit."""
    return table.limit(limit + 1).count() <= limit


def lookup_join(
    df: DataFrame, table: DataFrame, on: str | list[str], rows: int | None = None, how: str = "left"
) -> DataFrame:
    """Join a lookup table; broadcast it only when its row count is proven small.

    ``rows`` is the known row count (for example taken when an encoder was
    fitted). Without it the table is counted first. A larger table goes through
    a shuffle join, where adaptive execution splits hot keys.
    """
    bounded = rows <= BROADCAST_ROWS if rows is not None else small_enough(table)
    return df.join(F.broadcast(table) if bounded else table, on, how)


def encode_with(
    df: DataFrame,
    mapping: DataFrame,
    key: str,
    value: str,
    output: str,
    default: Column | float | None,
    rows: int | None = None,
) -> DataFrame:
    """Replace a category by its statistic; unseen or missing ones get the default."""
    table = mapping.select(F.col(key), F.col(value).alias("__value"))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return (
        lookup_join(df, table, key, rows)
        .withColumn(output, F.coalesce("__value", fallback))
        .drop("__value")
    )


def pair_strict(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Pair two tables one to one by key; a key without a partner is an error.

    Unequal pairing fails while the job runs, so nothing is dropped silently.
    """
    sides = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), on, "full_outer")
    paired = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    checked = F.when(paired, F.col(on)).otherwise(
        F.raise_error(F.concat(F.lit("no partner for key "), F.col(on).cast("string")))
    )
    return sides.withColumn(on, checked).drop("__l", "__r")


def check_options(df: DataFrame, options: DataFrame, columns: list[str], flag: str = "is_option") -> DataFrame:
    """Mark whether a combination of values is among the offered options."""
    table = options.select(*columns).distinct().withColumn(flag, F.lit(True))
    return lookup_join(df, table, columns).withColumn(flag, F.coalesce(flag, F.lit(False)))


def token_overlap(df: DataFrame, token_columns: list[str]) -> DataFrame:
    """Distinct tokens shared by each pair of text features.

    Each token becomes one row with a flag per feature, so the pair counts are
    sums of flag products: no self join, and tokens are merged before the shuffle.
    """

    def tagged(i: int, column: str) -> Column:
        return F.transform(F.array_distinct(column), lambda t: F.struct(t.alias("token"), F.lit(i).alias("feature")))

    entries = F.concat(*[tagged(i, c) for i, c in enumerate(token_columns)])
    per_token = (
        spread(df, [], entries, "e")
        .groupBy("e.token")
        .agg(*[F.max((F.col("e.feature") == i).cast("int")).alias(f"__in_{c}") for i, c in enumerate(token_columns)])
    )
    pairs = [(a, b) for a in token_columns for b in token_columns]
    totals = per_token.agg(
        *[
            F.coalesce(F.sum(F.col(f"__in_{a}") * F.col(f"__in_{b}")), F.lit(0)).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.col(f"p{i}").alias("intersection_count")
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return totals.select(F.explode(cells).alias("c")).select("c.*")
