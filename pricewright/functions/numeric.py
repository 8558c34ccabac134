"""Target transforms and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_target(price: Column) -> Column:
    return F.log1p(price.cast("double"))


def unlog(value: Column) -> Column:
    return F.expm1(value)


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Half-even rounding, as metrics and quoted prices use it."""
    return F.bround(value.cast("double"), digits)


def whole_price(value: Column) -> Column:
    return round_half_even(value).cast("int")
