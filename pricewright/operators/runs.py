"""Analysis of experiment runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.operators.select import encoder_columns_label, features_used

ENCODED = "transformer_params.catboost_cols"


def with_features_used(runs: DataFrame) -> DataFrame:
    return runs.withColumn("features_used", features_used(F.col("use_tab_features"), F.col("use_text_features")))


def with_encoder_label(runs: DataFrame, column: str = ENCODED) -> DataFrame:
    return runs.withColumn("cboost_encoder_cols", encoder_columns_label(F.col(f"`{column}`")))


def both_feature_kinds(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("use_tab_features") & F.col("use_text_features"))


def with_list_length(runs: DataFrame, n: int, column: str = ENCODED) -> DataFrame:
    """Runs whose list-valued setting has n entries."""
    return runs.where(F.size(F.col(f"`{column}`")) == n)


def list_label(column: Column) -> Column:
    """List setting as one label, e.g. [1, 3]."""
    return F.concat(F.lit("["), F.array_join(column.cast("array<string>"), ", "), F.lit("]"))


def best_runs(runs: DataFrame, by: list[str], metric: str = "rmsle_eval") -> DataFrame:
    return runs.groupBy(*by).agg(F.min(metric).alias(metric))
