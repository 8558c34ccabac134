"""Ordered target statistics over several random orders of the training rows.

In every order a row's category is coded by the targets of the rows before it, so
no row sees its own target; the mean over the orders steadies the codes of the
first rows. New rows are coded by all training rows.

The order follows from a hash of the row's key, so it does not depend on the
layout of the table. Rows of one key, null included, stand at one place and do not
see each other. Rows without a target count for nothing and are coded like the
others; a missing category has the prior as its code; without any target the prior
and all codes are NaN. An empty table gives no codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewright.operators.encoders import MeanEncoderModel, PriorMean, category_counts, category_stats, prior_mean
from pricewright.operators.splits import hash_share
from pricewright.operators.windows import ROWS_PER_SLICE, running
from pricewright.session import materialize

#: Hexadecimal digits of the hash that orders the rows; a double holds them exactly.
ORDER_DIGITS = 13


def ordered_codes(
    df: DataFrame,
    columns: list[str],
    target: str,
    key: str,
    permutations: int = 4,
    a: float = 1,
    seed: int = 42,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(key, feature, category, permutation, code) for each key and category, in one pass over all columns.

    Rows of one key and category are added up before the orders are made; a
    category with a third of all rows is cut into slices of its order.
    """
    y = F.col(f"`{target}`").cast("double")
    prior = df.agg(F.avg(y)).first()[0]
    prior = float("nan") if prior is None else float(prior)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for c in columns])
    long = df.select(F.col(f"`{key}`").alias("key"), y.alias("y"), F.explode(entries).alias("e"))
    per_key = (
        long.select("key", "e.feature", "e.category", "y")
        .where(F.col("category").isNotNull())
        .groupBy("key", "feature", "category")
        .agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("total"))
    )
    placed = per_key.withColumn("permutation", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    placed = materialize(placed.withColumn("place", hash_share(F.col("key"), F.col("permutation") + seed, ORDER_DIGITS)), "orders")
    before = running(
        placed, ["permutation", "feature", "category"], ["place", "key"],
        {"n_before": ("sum", F.col("n")), "total_before": ("sum", F.col("total"))}, inclusive=False, rows_per_slice=rows_per_slice,
    )
    code = prior_mean(F.coalesce("n_before", F.lit(0)), F.coalesce("total_before", F.lit(0.0)), prior, a)
    return before.select("key", "feature", "category", "permutation", code.alias("code"))


class OrderedTargetEncoder:
    """Codes of training rows by orders, codes of new rows by all training rows."""

    def __init__(self, columns: list[str], permutations: int = 4, a: float = 1, seed: int = 42):
        if permutations < 1:
            raise ValueError("at least one order is needed")
        self.columns, self.permutations, self.a, self.seed = list(columns), permutations, a, seed

    def fit(self, df: DataFrame, target: str, key: str) -> "OrderedTargetModel":
        codes = ordered_codes(df, self.columns, target, key, self.permutations, self.a, self.seed)
        mean = F.avg("code").alias("code")
        averaged = materialize(codes.groupBy("key", "feature", "category").agg(mean), "ordered-codes")
        stats = materialize(category_stats(df, self.columns, target), "category-stats")
        prior = df.agg(F.avg(target)).first()[0]
        return OrderedTargetModel(self, key, averaged, stats, float("nan") if prior is None else float(prior))


class OrderedTargetModel:
    """``codes`` (key, feature, category, code) and ``stats`` (feature, category, n, total) are written tables."""

    def __init__(self, encoder: OrderedTargetEncoder, key: str, codes: DataFrame, stats: DataFrame, prior: float):
        self.encoder, self.key, self.codes, self.stats, self.prior = encoder, key, codes, stats, prior

    def training(self, df: DataFrame, suffix: str = "_enc") -> DataFrame:
        """The training rows with the mean of their codes over the orders; no row is lost or repeated."""
        for c in self.encoder.columns:
            own = self.codes.where(F.col("feature") == c).select(
                F.col("key").alias("__key"), F.col("category").alias("__category"), F.col("code").alias("__code")
            )
            match = F.col(f"`{self.key}`").eqNullSafe(F.col("__key")) & (F.col(f"`{c}`").cast("string") == F.col("__category"))
            df = df.join(own, match, "left").withColumn(f"{c}{suffix}", F.coalesce("__code", F.lit(self.prior)))
            df = df.drop("__key", "__category", "__code")
        return df

    def transform(self, df: DataFrame, suffix: str = "_enc") -> DataFrame:
        """New rows with codes from all training rows; unseen and missing categories get the prior."""
        whole = MeanEncoderModel(PriorMean(self.encoder.a), self.encoder.columns, self.stats, category_counts(self.stats), self.prior)
        return whole.transform(df, suffix)
