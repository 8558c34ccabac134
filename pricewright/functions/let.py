"""Bind an expression once and use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression that is mentioned inside a lambda would be computed again for
    every element; bound to a lambda variable it is a plain reference.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def spread(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """One row per array element, for arrays that are expensive to compute.

    A plain explode makes the optimizer add a filter that computes the array a
    second time to see whether it is empty; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
