"""Exact quantiles that never gather a column in one place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

BINS = 1024
EXACT_ROWS = 4_000_000


def _narrow(values: DataFrame, lo: float, hi: float) -> list[tuple[float, float, int]]:
    """(min, max, count) of each filled bin of [lo, hi], ascending; at most BINS rows."""
    place = F.least(F.lit(BINS - 1), F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(BINS))))
    rows = (
        values.where(F.col("v").between(lo, hi))
        .groupBy(place.alias("bin"))
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
        .collect()
    )
    return sorted((r["lo"], r["hi"], r["n"]) for r in rows)


def order_statistics(values: DataFrame, ranks: list[int], exact_rows: int = EXACT_ROWS) -> dict[int, float]:
    """Values at 0-based ranks of column ``v``.

    Every pass is one map-side combined count over at most BINS bins and keeps
    only the bin that holds a wanted rank, so the range shrinks a thousandfold
    per scan until the bin is a single value or few enough rows to sort.
    """
    # infinite values and NaN, the greatest of all, have no width to divide: they are counted apart
    low, high, nan = F.col("v") == float("-inf"), F.col("v") == float("inf"), F.isnan("v")
    finite = F.when(~low & ~high & ~nan, F.col("v"))
    first = values.agg(F.min(finite), F.max(finite), F.count(finite), F.count_if(low), F.count_if(high)).first()
    inside, lowest, highest = first[2], first[3], first[4]
    found: dict[int, float] = {r: float("-inf") for r in ranks if r < lowest}
    found |= {r: float("inf") if r < lowest + inside + highest else float("nan") for r in ranks if r >= lowest + inside}
    middle = sorted({r for r in ranks if lowest <= r < lowest + inside})
    pending: dict[tuple[float, float, int, int], list[int]] = {(first[0], first[1], lowest, inside): middle} if middle else {}
    while pending:
        (lo, hi, below, rows), wanted = pending.popitem()
        if lo == hi:
            found.update({r: lo for r in wanted})
            continue
        if rows <= exact_rows:
            inside = values.where(F.col("v").between(lo, hi))
            positions = F.array(*[F.lit(r - below + 1) for r in wanted])
            picked = inside.agg(F.array_sort(F.collect_list("v")).alias("s")).select(
                F.transform(positions, lambda p: F.element_at("s", p.cast("int"))).alias("p")
            ).first()["p"]
            found.update(dict(zip(wanted, picked)))
            continue
        left = list(wanted)
        start = below
        for bin_lo, bin_hi, n in _narrow(values, lo, hi):
            here = [r for r in left if start <= r < start + n]
            if here:
                pending[(bin_lo, bin_hi, start, n)] = here
            start += n
    return found


def quantiles(
    df: DataFrame, qs: list[float], column: str = "sold_price", exact_rows: int = EXACT_ROWS
) -> dict[float, float | None]:
    """Quantiles with linear interpolation between neighbours.

    A bounded number of rows goes through the built-in ``percentile``; beyond
    that the ranks are found by narrowing value ranges.
    """
    if column not in df.columns:
        raise KeyError(f"no column {column!r}")
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return {q: None for q in qs}
    if n <= exact_rows:
        got = values.agg(F.percentile("v", F.array(*[F.lit(float(q)) for q in qs])).alias("p")).first()["p"]
        return dict(zip(qs, got))
    at = {q: q * (n - 1) for q in qs}
    ranks = sorted({int(math.floor(p)) for p in at.values()} | {int(math.ceil(p)) for p in at.values()})
    stat = order_statistics(values, ranks, exact_rows)
    out = {}
    for q, p in at.items():
        lo, hi = stat[int(math.floor(p))], stat[int(math.ceil(p))]
        share = p - math.floor(p)
        out[q] = lo if lo == hi else (1 - share) * lo + share * hi
    return out


def quantile_table(df: DataFrame, qs: list[float], column: str = "sold_price") -> DataFrame:
    """Quantiles as rows (quantile, value)."""
    from pricewright.vocab import values_table

    got = quantiles(df, qs, column)
    return values_table(df.sparkSession, [(float(q), float(v)) for q, v in got.items()], ["quantile", column])
