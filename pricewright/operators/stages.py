"""Feature blocks, price regressors and the price itself as pipeline stages.

A fitted stage stores its settings and a few learned numbers as stage metadata and
everything that grows with the data (category statistics, vocabularies with their
weights, components, neighbours) as Parquet tables beside it, written and read by
Spark. ``Pipeline`` and ``PipelineModel`` save and load them like built-in stages.
Tables are written before the metadata, so a stage whose writing was cut short has
no metadata and does not load.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from pricewright.functions.numeric import log_target, unlog
from pricewright.operators.encoders import FeaturePlan, FeaturePlanModel
from pricewright.operators.knn import knn_predict
from pricewright.operators.quantiles import quantiles
from pricewright.operators.regressors import TREES, linear_regression, tree_estimator
from pricewright.operators.text_features import BagOfWordsModel, ReduceModel
from pricewright.operators.text_plan import TextPlan, TextPlanModel
from pricewright.session import materialize


class StageWriter(MLWriter):
    def __init__(self, stage: "Stored"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        for name, table in self.stage.tables().items():
            table.write.parquet(f"{path}/{name}")
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, {"learned": self.stage.learned()})


class StageReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.restore(metadata["learned"], lambda name: self.sparkSession.read.parquet(f"{path}/{name}"))
        return stage


class Stored(MLReadable, MLWritable):
    """A stage that is saved as its parameters, learned numbers and tables."""

    def tables(self) -> dict[str, DataFrame]:
        return {}

    def learned(self) -> dict:
        return {}

    def restore(self, learned: dict, table: Callable[[str], DataFrame]) -> None:
        """Take up what ``learned`` and ``tables`` gave when the stage was saved."""

    def write(self) -> StageWriter:
        return StageWriter(self)

    @classmethod
    def read(cls) -> StageReader:
        return StageReader(cls)


class HasSettings(Params):
    """Settings of a feature block or regressor, by name; values have a JSON form."""

    settings: Param = Param(Params._dummy(), "settings", "settings by name")

    def given(self) -> dict:
        return dict(self.getOrDefault("settings")) if self.isDefined("settings") else {}


class LogPrice(Transformer, HasInputCol, HasOutputCol, Stored):
    """Adds the log of the price where rows have one; listings still to be priced pass unchanged."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _transform(self, df: DataFrame) -> DataFrame:
        price = self.getInputCol()
        return df.withColumn(self.getOutputCol(), log_target(F.col(price))) if price in df.columns else df


class TabularFeatures(Estimator, HasSettings, HasLabelCol, HasOutputCol, Stored):
    """Fits a feature plan; ``settings`` are those of ``FeaturePlan``."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _fit(self, df: DataFrame) -> "TabularFeaturesModel":
        fitted = FeaturePlan(**self.given()).fit(df, self.getLabelCol())
        return self._copyValues(TabularFeaturesModel(fitted))


class TabularFeaturesModel(Model, HasSettings, HasLabelCol, HasOutputCol, Stored):
    def __init__(self, fitted: FeaturePlanModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df, self.getOutputCol())

    def tables(self) -> dict[str, DataFrame]:
        return {"category-stats": self.fitted.stats} if self.fitted.stats is not None else {}

    def learned(self) -> dict:
        return {"scaling": self.fitted.scaling, "prior": self.fitted.prior, "has_stats": self.fitted.stats is not None}

    def restore(self, learned: dict, table: Callable[[str], DataFrame]) -> None:
        scaling = {c: tuple(v) for c, v in learned["scaling"].items()}
        stats = table("category-stats") if learned["has_stats"] else None
        self.fitted = FeaturePlan(**self.given()).model(scaling, learned["prior"], stats)


class TextFeatures(Estimator, HasSettings, HasOutputCol, Stored):
    """Fits a text plan; ``settings`` are those of ``TextPlan``."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _fit(self, df: DataFrame) -> "TextFeaturesModel":
        return self._copyValues(TextFeaturesModel(TextPlan(**self.given()).fit(df)))


class TextFeaturesModel(Model, HasSettings, HasOutputCol, Stored):
    """Vocabularies (term, index, df, idf) and components (index, weights) are tables, one pair per text column."""

    def __init__(self, fitted: TextPlanModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df, self.getOutputCol())

    def tables(self) -> dict[str, DataFrame]:
        found = {}
        for i, column in enumerate(self.fitted.vectors):
            found[f"vocabulary-{i}"] = self.fitted.vectors[column].terms
            found[f"components-{i}"] = self.fitted.reductions[column].table()
        return found

    def learned(self) -> dict:
        return {"vectors": [m.described() for m in self.fitted.vectors.values()]}

    def restore(self, learned: dict, table: Callable[[str], DataFrame]) -> None:
        vectors, reductions = {}, {}
        for i, data in enumerate(learned["vectors"]):
            vectors[data["text"]] = BagOfWordsModel.of(table(f"vocabulary-{i}"), data)
            reductions[data["text"]] = ReduceModel.of(table(f"components-{i}"))
        self.fitted = TextPlanModel(TextPlan(**self.given()), vectors, reductions)


class LogPriceRegressor(Estimator, HasSettings, HasFeaturesCol, HasLabelCol, HasPredictionCol, Stored):
    """Fits one of the named estimators; most give a built-in model, which stores itself."""

    estimator: Param = Param(Params._dummy(), "estimator", "name of the estimator")
    idCol: Param = Param(Params._dummy(), "idCol", "column that names the training rows")

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _fit(self, df: DataFrame) -> Model:
        kind, given, label = self.getOrDefault("estimator"), self.given(), self.getLabelCol()
        columns = dict(featuresCol=self.getFeaturesCol(), labelCol=label, predictionCol=self.getPredictionCol())
        if kind == "c-median":
            median = MedianModel(quantiles(df, [0.5], label)[0.5])
            return median._set(predictionCol=self.getPredictionCol())
        if kind == "knn":
            vectors = df.select(F.col(self.getOrDefault("idCol")).alias("id"), vector_to_array(self.getFeaturesCol()).alias("vector"), F.col(label).alias("target"))
            near = NeighbourModel(materialize(vectors, "neighbours"))
            return near._set(k=int(given.get("n_neighbors", 5)), featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        data = df.select(self.getFeaturesCol(), label).persist()
        try:
            if kind in TREES:
                estimator = tree_estimator(kind, given, columns)
            else:
                n, sigma = data.agg(F.count("*"), F.stddev_pop(label)).first()
                estimator = linear_regression(kind, given, n, float(sigma or 1.0) or 1.0, columns)
            return estimator.fit(data)
        finally:
            data.unpersist()


class MedianModel(Model, HasPredictionCol, Stored):
    """Predicts the median of the training rows; NULL when there were none."""

    def __init__(self, median: float | None = None):
        super().__init__()
        self.median = median

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(), F.lit(self.median).cast("double"))

    def learned(self) -> dict:
        return {"median": self.median}

    def restore(self, learned: dict, table: Callable[[str], DataFrame]) -> None:
        self.median = learned["median"]


class NeighbourModel(Model, HasFeaturesCol, HasPredictionCol, Stored):
    """Mean target of the nearest training rows.

    Each distinct vector is searched once and joined back by its digest, so rows
    with repeated or NULL ids all get their prediction.
    """

    k: Param = Param(Params._dummy(), "k", "number of neighbours")

    def __init__(self, rows: DataFrame | None = None):
        super().__init__()
        self.rows = rows

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getPredictionCol()
        keyed = df.withColumn("__digest", F.sha2(F.to_json(vector_to_array(self.getFeaturesCol())), 256))
        asked = keyed.groupBy("__digest").agg(F.first(vector_to_array(self.getFeaturesCol())).alias("vector"))
        found = knn_predict(self.rows, asked, "target", self.getOrDefault("k"), query_key="__digest", output=name)
        return keyed.join(found, "__digest", "left").drop("__digest")

    def tables(self) -> dict[str, DataFrame]:
        return {"neighbours": self.rows}

    def restore(self, learned: dict, table: Callable[[str], DataFrame]) -> None:
        self.rows = table("neighbours")


class Price(Transformer, HasInputCol, HasOutputCol, Stored):
    """Turns the predicted log into a price; carries the description and metrics of its model."""

    spec: Param = Param(Params._dummy(), "spec", "description of the model")
    metrics: Param = Param(Params._dummy(), "metrics", "metrics by name")

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), unlog(F.col(self.getInputCol())))
