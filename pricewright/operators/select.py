"""Projections and filters over listings and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.strings import extract_size
from pricewright.vocab import PLACEHOLDER

TARGET_SIDE = ("sold_price", "id", "parsing_date")


def features_target(df: DataFrame) -> DataFrame:
    """Model inputs: everything but the target, the id and the collection date."""
    return df.drop(*TARGET_SIDE)


def shorten_run_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Rename dotted run columns to their last part, or by an explicit mapping."""
    if names is None:
        names = {c: c.rsplit(".", 1)[-1] for c in df.columns if "." in c}
    return df.withColumnsRenamed(names)


def tag(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def fill_missing(df: DataFrame, column: str = "hashtags", placeholder: str = PLACEHOLDER) -> DataFrame:
    return df.fillna({column: placeholder})


def blank_placeholder(df: DataFrame, column: str = "hashtags", placeholder: str = PLACEHOLDER) -> DataFrame:
    return df.replace({placeholder: ""}, subset=[column])


def features_used(tabular: Column, text: Column) -> Column:
    return F.when(tabular & text, "both").when(tabular, "tabular").otherwise("text")


def encoder_columns_label(columns: Column) -> Column:
    return F.when(F.size(columns) == 4, "mid_high").when(F.array_contains(columns, "color"), "high").otherwise("mid")


def hashtag_usage(hashtags: Column, placeholder: str = PLACEHOLDER) -> Column:
    return F.when(hashtags == placeholder, "no").otherwise("yes")


def display_listings(df: DataFrame) -> DataFrame:
    """Listings for display: id as text, last column first, no collection date."""
    shown = df.drop("parsing_date").withColumn("id", F.col("id").cast("string"))
    *rest, last = shown.columns
    return shown.select(last, *rest)


def transform_listings(df: DataFrame) -> DataFrame:
    """The cleaning step of collection: size pattern and hashtag placeholder in one projection."""
    return df.withColumns(
        {"size": extract_size(F.col("size")), "hashtags": F.coalesce("hashtags", F.lit(PLACEHOLDER))}
    )


def where_equal(df: DataFrame, **wanted) -> DataFrame:
    """Rows matching the chosen option of each selector; None selects everything."""
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def price_tail(df: DataFrame, tail: str, low: float, high: float, column: str = "sold_price") -> DataFrame:
    """Listings strictly above the high or below the low quantile; ties are in neither."""
    if tail == "top":
        return df.where(F.col(column) > F.lit(high))
    if tail == "bottom":
        return df.where(F.col(column) < F.lit(low))
    raise ValueError(f"tail must be 'top' or 'bottom', not {tail!r}")


def price_tails(df: DataFrame, low: float, high: float, column: str = "sold_price") -> DataFrame:
    """Both tails in one pass, tagged."""
    label = F.when(F.col(column) > F.lit(high), "top").when(F.col(column) < F.lit(low), "bottom")
    return df.where((F.col(column) > F.lit(high)) | (F.col(column) < F.lit(low))).withColumn("tail", label)


def drop_empty_values(df: DataFrame, column: str = "value", placeholder: str = PLACEHOLDER) -> DataFrame:
    """Without NULLs, zero statistics or placeholder n-grams."""
    kind = dict(df.dtypes)[column]
    empty = placeholder if kind == "string" else 0
    return df.where(F.col(column).isNotNull() & (F.col(column) != F.lit(empty)))


def impute_zero_photos(df: DataFrame, median: float) -> DataFrame:
    """Optional repair of listings whose photos were not seen by the collector."""
    return df.withColumn(
        "n_photos", F.when(F.col("n_photos") == 0, F.lit(int(median))).otherwise(F.col("n_photos"))
    )
