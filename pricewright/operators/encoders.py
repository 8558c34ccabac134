"""Categorical and numeric feature encoders."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.constants import constant_lookup
from pricewright.operators.lookup import BROADCAST_ROWS, encode_with, lookup_join
from pricewright.operators.windows import ROWS_PER_SLICE, number_rows, running
from pricewright.session import materialize
from pricewright.vocab import ACCESSORIES, CATEGORICAL_COLUMNS, CONDITION_RANK, ONE_SIZE, size_positions


def fixed_size(
    size: Column, category: Column, normalize: bool = False, accessories: str = ACCESSORIES
) -> Column:
    """Accessories have one size; normalised sizes are the text of their place in the chart."""
    if not normalize:
        return F.when(category == accessories, F.lit(ONE_SIZE)).otherwise(size)
    places = dict(size_positions())
    place = constant_lookup(size, places, "double")
    return (
        F.when(category == accessories, F.lit(str(places[ONE_SIZE])))
        .otherwise(F.coalesce(place.cast("string"), F.lit("None")))
    )


def standard_parameters(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one pass; 0 and 1 for a column without values."""
    row = df.agg(*[e for c in columns for e in (F.avg(c), F.stddev_pop(c))]).first()
    return {c: (float(row[2 * i] or 0.0), float(row[2 * i + 1] or 0.0) or 1.0) for i, c in enumerate(columns)}


def standardize(
    df: DataFrame, columns: list[str], parameters: dict | None = None, with_mean: bool = True, with_std: bool = True
) -> DataFrame:
    parameters = parameters or standard_parameters(df, columns)
    return df.withColumns(
        {
            f"{c}_scaled": (F.col(c) - F.lit(mean if with_mean else 0.0)) / F.lit(sd if with_std else 1.0)
            for c, (mean, sd) in parameters.items()
        }
    )


def labels_of(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a column; the driver holds them, as a fitted string indexer does."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


class LabelTable:
    """The labels of a column in order, as a written table (label, place) that never passes through the driver."""

    def __init__(self, table: DataFrame, size: int):
        self.table, self.size = table, size

    @staticmethod
    def of(df: DataFrame, column: str) -> "LabelTable":
        found = df.select(F.col(column).alias("label")).where(F.col("label").isNotNull()).distinct()
        table = materialize(number_rows(found, ["label"], "place"), "labels")
        return LabelTable(table, table.count())

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        """The labels themselves; whoever asks for them holds them."""
        return iter([r["label"] for r in self.table.orderBy("place").collect()])

    def index(self, df: DataFrame, column: str, output: str, handle_unknown: str = "ignore") -> DataFrame:
        """Place of each value among the labels; NULL and unseen values get their number, or fail on ``error``."""
        table = self.table.select(F.col("label").alias(column), F.col("place").alias(output))
        # a compressed table looks smaller than it is once it is sent to every task
        table = table if self.size <= BROADCAST_ROWS else table.hint("merge")
        other = F.lit(self.size).cast("long")
        if handle_unknown == "error":
            other = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))).cast("long")
        placed = lookup_join(df, table, column, rows=self.size)
        return placed.withColumn(output, F.when(F.col(output).isNotNull(), F.col(output)).otherwise(other))


def label_index(df: DataFrame, column: str, labels: list[str], output: str, handle_unknown: str = "ignore") -> DataFrame:
    """Place of each value among the labels; NULL and unseen values get their number, or fail on ``error``."""
    if not labels:
        return df.withColumn(output, F.lit(0.0))
    invalid = "error" if handle_unknown == "error" else "keep"
    return StringIndexerModel.from_labels(labels, column, output, handleInvalid=invalid).transform(df)


@dataclass
class OneHot:
    """0/1 vectors of categorical columns, sparse, for any number of labels.

    ``handle_unknown`` is ``ignore`` (NULL and unseen values are all zeros) or
    ``error``; ``drop`` is ``first`` to leave out the first label of each column.
    """

    handle_unknown: str = "ignore"
    drop: str | None = None

    def __post_init__(self):
        if self.handle_unknown not in ("ignore", "error") or self.drop not in (None, "first"):
            raise ValueError("one-hot settings: handle_unknown is 'ignore' or 'error', drop is None or 'first'")

    def fit(self, df: DataFrame, columns: list[str]) -> "OneHotModel":
        return OneHotModel(self, {c: LabelTable.of(df, c) for c in columns})


@F.arrow_udf(VectorUDT())
def _ones(size: pa.Array, indices: pa.Array) -> pa.Array:
    """Sparse vectors that are 1 at the indices."""
    ends = np.concatenate(([0], np.cumsum(indices.value_lengths().to_numpy())))
    values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ones(ends[-1])))
    at = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), indices.flatten().cast(pa.int32()))
    return pa.StructArray.from_arrays([pa.array(np.zeros(len(size)), pa.int8()), size.cast(pa.int32()), at, values], ["type", "size", "indices", "values"])


class OneHotModel:
    """Labels by column, in order: a table of any size, or a list."""

    def __init__(self, encoder: OneHot, labels: dict[str, LabelTable | list[str]]):
        self.encoder, self.labels = encoder, labels

    def names(self) -> list[str]:
        first = 1 if self.encoder.drop else 0
        return [f"{c}={label}" for c, labels in self.labels.items() for label in [*labels][first:]]

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        """One vector over all columns, in the order of ``names``; labels are joined, and no slot is named."""
        kept, first = df.columns, 1 if self.encoder.drop else 0
        width, places = 0, []
        for n, (c, labels) in enumerate(self.labels.items()):
            slots = max(0, len(labels) - first)
            if not slots:
                continue
            name, unknown = f"__label_{n}", self.encoder.handle_unknown
            df = labels.index(df, c, name, unknown) if isinstance(labels, LabelTable) else label_index(df, c, labels, name, unknown)
            place = F.col(name).cast("int") - first
            # the slot after the last stands for no label
            places.append(F.when(place.between(0, slots - 1), place + width))
            width += slots
        if not places:
            return df.withColumn(output, array_to_vector(F.array().cast("array<double>")))
        found = F.filter(F.array(*places), lambda i: i.isNotNull())
        # not deterministic: readers of a part of the vector must not make it again
        hot = _ones.asNondeterministic()(F.lit(width), found).alias(output, metadata={"ml_attr": {"num_attrs": width}})
        return df.select(*[c for c in kept if c != output], hot)


def one_hot(column: str, labels: list[str]) -> list[Column]:
    """One 0/1 column per label; an unseen value is all zeros."""
    return [F.coalesce((F.col(column) == label).cast("double"), F.lit(0.0)).alias(f"{column}={label}") for label in labels]


def ordinal(column: Column, ranks: dict[str, int]) -> Column:
    """Rank of a value in a fixed order, -1 when unknown."""
    return F.coalesce(constant_lookup(column, ranks, "int"), F.lit(-1))


def category_stats(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Count and target sum per category of every column: (feature, category, n, total).

    One job serves all columns; categories are summed on the map side, so a
    frequent category costs its final task a few partial rows only.
    """
    long = df.select(target, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [target], columns, "feature", "category"
    )
    return (
        long.where(F.col("category").isNotNull() & F.col(target).isNotNull())
        .groupBy("feature", "category")
        .agg(F.count("*").alias("n"), F.sum(target).cast("double").alias("total"))
    )


def shrunken_mean(n: Column, total: Column, prior: float, min_samples_leaf: float = 20, smoothing: float = 10) -> Column:
    """Category mean pulled to the prior by a sigmoid of the category size."""
    weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))
    return F.lit(prior) * (F.lit(1.0) - weight) + (total / n) * weight


def prior_mean(n: Column, total: Column, prior: float, a: float = 1) -> Column:
    """Category mean with the prior counted as ``a`` more rows."""
    return (total + F.lit(a * prior)) / (n + F.lit(float(a)))


class MeanEncoder:
    """Target statistics per category; subclasses choose the shrinkage."""

    def value(self, prior: float) -> Column:
        raise NotImplementedError

    def fit(self, df: DataFrame, columns: list[str], target: str) -> "MeanEncoderModel":
        stats = materialize(category_stats(df, columns, target), "category-stats")
        prior = df.agg(F.avg(target)).first()[0]
        return self.model(columns, stats, category_counts(stats), prior)

    def model(self, columns: list[str], stats: DataFrame, counts: dict[str, int], prior: float | None) -> "MeanEncoderModel":
        return MeanEncoderModel(self, list(columns), stats, counts, float(prior) if prior is not None else 0.0)


def category_counts(stats: DataFrame) -> dict[str, int]:
    return {r["feature"]: r["n"] for r in stats.groupBy("feature").agg(F.count("*").alias("n")).collect()}


class MeanEncoderModel:
    def __init__(self, encoder: MeanEncoder, columns: list[str], stats: DataFrame, counts: dict[str, int], prior: float):
        self.encoder, self.columns, self.stats, self.counts, self.prior = encoder, columns, stats, counts, prior

    def transform(self, df: DataFrame, suffix: str = "_enc") -> DataFrame:
        for c in self.columns:
            mapping = self.stats.where(F.col("feature") == c).select(
                F.col("category").alias(c), self.encoder.value(self.prior).alias("value")
            )
            df = encode_with(df, mapping, c, "value", f"{c}{suffix}", self.prior, self.counts.get(c, 0))
        return df


class TargetMean(MeanEncoder):
    def __init__(self, min_samples_leaf: float = 20, smoothing: float = 10):
        self.min_samples_leaf, self.smoothing = min_samples_leaf, smoothing

    def value(self, prior: float) -> Column:
        return shrunken_mean(F.col("n"), F.col("total"), prior, self.min_samples_leaf, self.smoothing)


class PriorMean(MeanEncoder):
    def __init__(self, a: float = 1):
        self.a = a

    def value(self, prior: float) -> Column:
        return prior_mean(F.col("n"), F.col("total"), prior, self.a)


def ordered_prior_mean(
    df: DataFrame,
    column: str,
    target: str,
    order: list[str],
    a: float = 1,
    output: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Leak-free form for training rows: only rows earlier in the order count.

    Without any target value the codes are NaN; an empty table stays empty.
    """
    prior = df.agg(F.avg(target)).first()[0]
    prior = float("nan") if prior is None else float(prior)
    seen = running(
        df,
        [column],
        order,
        {"__n": ("count", F.lit(1)), "__total": ("sum", F.col(target).cast("double"))},
        inclusive=False,
        rows_per_slice=rows_per_slice,
    )
    value = prior_mean(F.col("__n"), F.coalesce("__total", F.lit(0.0)), prior, a)
    return seen.withColumn(output or f"{column}_enc", value).drop("__n", "__total")


@dataclass
class FeaturePlan:
    """Which column gets which encoder.

    Columns not named for one-hot, ordinal or prior-mean encoding get the
    shrunken target mean. ``size`` is fixed by category before its encoder.
    """

    numeric_cols: list[str] | None = field(default_factory=lambda: ["n_photos"])
    ohe_cols: list[str] | None = field(default_factory=lambda: ["department", "category"])
    oe_cols: list[str] | None = field(default_factory=lambda: ["condition"])
    catboost_cols: list[str] | None = None
    te_cols: list[str] | None = None
    scaler_params: dict | None = None
    ohe_params: dict | None = None
    oe_params: dict | None = None
    catboost_params: dict | None = None
    te_params: dict | None = None
    normalize_size: bool = False
    no_encoding: bool = False

    def __post_init__(self):
        # copies: the caller's lists stay untouched
        self.numeric_cols = list(self.numeric_cols or [])
        self.ohe_cols = list(self.ohe_cols or [])
        self.oe_cols = list(self.oe_cols or [])
        self.catboost_cols = list(self.catboost_cols or [])
        taken = {*self.ohe_cols, *self.oe_cols, *self.catboost_cols}
        self.te_cols = list(self.te_cols or sorted(set(CATEGORICAL_COLUMNS) - taken))
        # made here so that unknown settings fail before any job runs
        self.one_hot = OneHot(**(self.ohe_params or {}))
        self.rank_unknown = {"handle_unknown": "value", **(self.oe_params or {})}
        if set(self.rank_unknown) != {"handle_unknown"} or self.rank_unknown["handle_unknown"] not in ("value", "return_nan", "error"):
            raise ValueError("ordinal settings: handle_unknown is 'value' (-1), 'return_nan' or 'error'")

    def size_encoder(self) -> str | None:
        for kind in ("ohe", "oe", "catboost", "te"):
            if "size" in getattr(self, f"{kind}_cols"):
                return kind
        return None

    def columns(self) -> list[str]:
        return [*self.numeric_cols, *self.oe_cols, *self.ohe_cols, *self.catboost_cols, *self.te_cols]

    def passthrough(self, df: DataFrame) -> DataFrame:
        """Without encoding: the planned columns as they are, the size fixed."""
        fixed = fixed_size(F.col("size"), F.col("category"), self.normalize_size)
        others = [c for c in dict.fromkeys(self.columns()) if c != "size"]
        return df.select(*others, fixed.alias("size"))

    def _sized(self, df: DataFrame) -> DataFrame:
        if self.size_encoder() is None:
            return df
        return df.withColumn("size", fixed_size(F.col("size"), F.col("category"), self.normalize_size))

    def fit(self, df: DataFrame, target: str) -> "FeaturePlanModel":
        if self.no_encoding:
            raise ValueError("a plan without encoding has nothing to fit; use passthrough()")
        df = self._sized(df)
        # one pass for the numbers, one for the statistics of every category
        row = df.agg(
            F.avg(target).alias("prior"), *[e for c in self.numeric_cols for e in (F.avg(c), F.stddev_pop(c))]
        ).first()
        scaling = {
            c: (float(row[2 * i + 1] or 0.0), float(row[2 * i + 2] or 0.0) or 1.0) for i, c in enumerate(self.numeric_cols)
        }
        wanted = list(dict.fromkeys([*self._listed(), *self.catboost_cols, *self.te_cols]))
        stats = materialize(category_stats(df, wanted, target), "category-stats") if wanted else None
        return self.model(scaling, row["prior"], stats)

    def _listed(self) -> list[str]:
        """Columns whose labels are numbered; the condition has a fixed order of its own."""
        return [c for c in self.oe_cols if c != "condition"] + self.ohe_cols

    def model(self, scaling: dict, prior: float | None, stats: DataFrame | None) -> "FeaturePlanModel":
        """Fitted encoders from the learned numbers and the written table of category statistics."""
        listed = self._listed()
        labels, means = {c: [] for c in listed}, []
        if stats is not None:
            counts = category_counts(stats)
            for r in stats.where(F.col("feature").isin(listed)).select("feature", "category").collect() if listed else []:
                labels[r["feature"]].append(r["category"])
            if self.catboost_cols:
                means.append(PriorMean(**(self.catboost_params or {})).model(self.catboost_cols, stats, counts, prior))
            if self.te_cols:
                means.append(TargetMean(**(self.te_params or {})).model(self.te_cols, stats, counts, prior))
        ranks = {c: None if c == "condition" else sorted(labels[c]) for c in self.oe_cols}
        fitted = FeaturePlanModel(self, scaling, {c: sorted(labels[c]) for c in self.ohe_cols}, ranks, means)
        fitted.prior, fitted.stats = prior, stats
        return fitted


class FeaturePlanModel:
    """Fitted encoders; ``transform`` adds one feature vector in a fixed column order."""

    def __init__(self, plan: FeaturePlan, scaling: dict, labels: dict, ranks: dict, means: list[MeanEncoderModel]):
        # ranks: the labels of a column in order; the condition has a fixed order of its own
        self.plan, self.scaling, self.labels, self.ranks, self.means = plan, scaling, labels, ranks, means
        self.hot = OneHotModel(plan.one_hot, labels)
        # what the encoders were made from: all that has to be stored
        self.prior: float | None = None
        self.stats: DataFrame | None = None

    def names(self) -> list[str]:
        out = [f"{c}_scaled" for c in self.scaling]
        out += self.hot.names()
        out += [f"{c}_rank" for c in self.ranks]
        return out + [f"{c}_enc" for model in self.means for c in model.columns]

    def _numbers(self, df: DataFrame) -> DataFrame:
        """Every feature but the one-hot ones as a double column; the size as given is kept in ``__size``."""
        df = self.plan._sized(df.withColumn("__size", F.col("size"))) if "size" in df.columns else df
        if self.scaling:
            df = standardize(df, list(self.scaling), self.scaling, **(self.plan.scaler_params or {}))
        unknown = self.plan.rank_unknown["handle_unknown"]
        for c, labels in self.ranks.items():
            if labels is None:
                rank = ordinal(F.col(c), CONDITION_RANK).cast("double")
                known = rank >= 0
            else:
                df = label_index(df, c, labels, "__place")
                rank = F.col("__place") + 1.0
                known = F.col("__place") < len(labels)
            other = {"value": F.lit(-1.0), "return_nan": F.lit(float("nan"))}.get(unknown)
            if other is None:
                other = F.raise_error(F.concat(F.lit(f"unknown value in {c}: "), F.coalesce(F.col(c), F.lit("NULL")))).cast("double")
            df = df.withColumn(f"{c}_rank", F.when(known, rank).otherwise(other)).drop("__place")
        for model in self.means:
            df = model.transform(df)
        return df

    def _listed(self) -> tuple[list[str], list[str]]:
        """Number columns before and after the one-hot block."""
        return [f"{c}_scaled" for c in self.scaling], [f"{c}_rank" for c in self.ranks] + [f"{c}_enc" for model in self.means for c in model.columns]

    def encoded(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Kept columns and one double column per feature: for plans of few labels; ``transform`` has no such limit."""
        first = 1 if self.plan.one_hot.drop else 0
        hot = [column for c, labels in self.labels.items() for column in one_hot(c, labels[first:])]
        before, after = self._listed()
        kept = [F.col("__size").alias("size") if c == "size" else F.col(c) for c in keep]
        return self._numbers(df).select(*kept, *before, *hot, *after)

    def transform(self, df: DataFrame, output: str = "tab_features") -> DataFrame:
        """One vector in the order of ``names``; one-hot parts are sparse, so any number of labels will do."""
        columns = df.columns
        df, (before, after) = self._numbers(df), self._listed()
        blocks = [*before, *after]
        if self.hot.names():
            df = self.hot.transform(df, "__hot")
            blocks = [*before, "__hot", *after]
        # NaN is a wanted code there; elsewhere a missing number is a fault
        invalid = "keep" if self.plan.rank_unknown["handle_unknown"] == "return_nan" else "error"
        kept = [F.col("__size").alias("size") if c == "size" else F.col(c) for c in columns]
        return VectorAssembler(inputCols=blocks, outputCol=output, handleInvalid=invalid).transform(df).select(*kept, output)


def assemble(df: DataFrame, blocks: list[str], output: str = "features") -> DataFrame:
    """Concatenate feature blocks into one vector."""
    return VectorAssembler(inputCols=blocks, outputCol=output, handleInvalid="error").transform(df)
