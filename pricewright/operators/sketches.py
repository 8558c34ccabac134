"""Quantile sketches: small, mergeable summaries of a column with a stated rank error.

A sketch of a group is a binary value of bounded size, whatever the group holds.
It is built in one map-side combined aggregate, stored as a column, and sketches
of parts (days, categories, batches) merge into that of the whole without reading
the rows again. ``operators/quantiles.py`` has the exact form.

NULL and NaN values are left out; infinities count as values. A group without
values has no sketch; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_ERROR = 0.01
#: The published rank error of a KLL sketch, 2.296 / k ** 0.9723, holds with 99 per cent confidence.
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9723
SMALLEST_K, LARGEST_K = 8, 65_535


def sketch_size(error: float) -> int:
    """The parameter k whose rank error, as a share of the rows, is at most ``error``."""
    if not 0 < error < 1:
        raise ValueError(f"a rank error lies between 0 and 1, not at {error}")
    k = max(SMALLEST_K, math.ceil((ERROR_FACTOR / error) ** (1 / ERROR_POWER)))
    if k > LARGEST_K:
        raise ValueError(f"a rank error of {error} needs a sketch of {k}; the largest is {LARGEST_K}: use exact quantiles")
    return k


def _value(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def quantile_sketches(df: DataFrame, by: list[str], column: str, error: float = DEFAULT_ERROR) -> DataFrame:
    """One row (by, n, sketch) per group that holds a value; NULL group keys are a group of their own."""
    values = df.select(*by, _value(column).alias("__v")).where(F.col("__v").isNotNull())
    built = F.kll_sketch_agg_double("__v", F.lit(sketch_size(error)))
    return values.groupBy(*by).agg(F.count("*").alias("n"), built.alias("sketch")).where(F.col("n") > 0)


def merge_sketches(sketches: DataFrame, by: list[str], error: float = DEFAULT_ERROR) -> DataFrame:
    """Sketches of coarser groups from those of finer ones; the rank error stays that of ``error``."""
    merged = F.kll_merge_agg_double("sketch", F.lit(sketch_size(error)))
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), merged.alias("sketch")).where(F.col("n") > 0)


def sketch_quantiles(sketches: DataFrame, by: list[str], qs: list[float]) -> DataFrame:
    """Rows (by, quantile, value): a value of the group whose rank is near ``quantile`` times the rows."""
    wrong = [q for q in qs if not 0 <= q <= 1]
    if wrong:
        raise ValueError(f"quantiles lie between 0 and 1, not at {wrong}")
    cells = [F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for q in qs]
    return sketches.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")


def sketch_rank(value: Column, sketch: str = "sketch") -> Column:
    """Estimated share of the group's rows that are not above ``value``."""
    return F.kll_sketch_get_rank_double(F.col(sketch), value)


def rank_distance(df: DataFrame, by: list[str], column: str, answers: DataFrame) -> DataFrame:
    """Answers (by, quantile, value) with ``distance``: how far the wanted rank is from the true ranks of the value.

    A value that stands on several ranks is at distance 0 from all of them. The
    values are counted per group once; the answers, a few per group, are joined.
    """
    if not by:
        raise ValueError("name the columns of the groups; add a constant one for the whole table")
    values = df.select(*by, _value(column).alias("__v")).where(F.col("__v").isNotNull())
    counted = values.groupBy(*by, "__v").agg(F.count("*").alias("__n"))
    same = [F.col(f"c.{b}").eqNullSafe(F.col(f"a.{b}")) for b in by]
    marked = answers.alias("a").join(counted.alias("c"), same)
    keys = [F.col(f"a.{c}") for c in (*by, "quantile", "value")]
    below = F.sum(F.when(F.col("__v") < F.col("a.value"), F.col("__n")).otherwise(0))
    upto = F.sum(F.when(F.col("__v") <= F.col("a.value"), F.col("__n")).otherwise(0))
    found = marked.groupBy(*keys).agg(below.alias("__below"), upto.alias("__upto"), F.sum("__n").alias("__rows"))
    low, high = F.col("__below") / F.col("__rows"), F.col("__upto") / F.col("__rows")
    gap = F.greatest(low - F.col("quantile"), F.col("quantile") - high, F.lit(0.0))
    return found.select(*by, "quantile", "value", gap.alias("distance"))
