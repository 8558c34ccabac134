"""Experiments, sweeps, retraining and batch scoring."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.numeric import whole_price
from pricewright.functions.strings import iso_timestamp, prediction_id
from pricewright.functions.text import clean_text
from pricewright.operators.aggregates import evaluate
from pricewright.operators.models import LOG_TARGET, PRICE, TARGET, FittedPriceModel, PriceModel
from pricewright.operators.quality import validate
from pricewright.operators.reshape import nest_config
from pricewright.session import materialize
from pricewright.vocab import TEXT_COLUMNS

DEFAULTS = {"use_tab_features": True, "use_text_features": False, "estimator_class": "lr"}
RUN_SCHEMA = (
    "run string, config string, estimator_class string, use_tab_features boolean, use_text_features boolean, "
    "rmsle_train double, wape_train double, rmsle_eval double, wape_eval double"
)


def model_of(name: str, config: dict) -> PriceModel:
    """Model described by a flat (dotted) or nested configuration."""
    nested = nest_config({**DEFAULTS, **config})
    return PriceModel(
        name,
        estimator_class=nested["estimator_class"],
        use_tab_features=nested["use_tab_features"],
        use_text_features=nested["use_text_features"],
        estimator_params=nested.get("estimator_params") or {},
        transformer_params=nested.get("transformer_params") or {},
        extractor_params=nested.get("extractor_params") or {},
    )


IN_TRAINING = "__in_training"


def _labelled(train: DataFrame, eval_: DataFrame) -> DataFrame:
    return train.withColumn(IN_TRAINING, F.lit(True)).unionByName(eval_.withColumn(IN_TRAINING, F.lit(False)))


def feature_setting(model: PriceModel) -> str:
    """Names the features of a model: models of one setting share their fitted stages and rows."""
    if model.estimator_class == "c-median":
        return "none"
    used = [model.transformer_params if model.use_tab_features else None, model.extractor_params if model.use_text_features else None]
    return json.dumps(used, sort_keys=True, default=list)


def featured(model: PriceModel, labelled: DataFrame) -> tuple[list, DataFrame]:
    """(feature stages fitted on the training rows, written rows of both parts with their features)."""
    fitted = Pipeline(stages=model.pipeline().getStages()[:-2]).fit(labelled.where(IN_TRAINING))
    rows = fitted.transform(labelled)
    kept = [c for c in ("id", TARGET, LOG_TARGET, "__features", IN_TRAINING) if c in rows.columns]
    return fitted.stages, materialize(rows.select(*kept), "features")


def run_with_features(name: str, model: PriceModel, config: dict, stages: list, rows: DataFrame) -> tuple[FittedPriceModel, tuple]:
    """Fit the estimator on prepared features and measure both parts in one aggregate; (model, run row)."""
    regressor, price = model.pipeline().getStages()[-2:]
    fitted = FittedPriceModel(model, PipelineModel([*stages, regressor.fit(rows.where(IN_TRAINING)), price]))
    priced = rows
    for stage in fitted.pipeline.stages[-2:]:
        priced = stage.transform(priced)
    found = {r[IN_TRAINING]: (r["rmsle"], r["wape"]) for r in evaluate(priced, TARGET, PRICE, [IN_TRAINING], rounded=True).collect()}
    on_train, on_eval = (found.get(part, (None, None)) for part in (True, False))
    settings = (json.dumps(config, sort_keys=True), model.estimator_class, model.use_tab_features, model.use_text_features)
    return fitted, (name, *settings, *on_train, *on_eval)


def run_experiment(name: str, train: DataFrame, eval_: DataFrame, config: dict) -> tuple[FittedPriceModel, DataFrame]:
    """Fit on train, measure on both parts; (fitted model, one run row)."""
    model = model_of(name, config)
    fitted, row = run_with_features(name, model, config, *featured(model, _labelled(train, eval_)))
    return fitted, train.sparkSession.createDataFrame([row], RUN_SCHEMA)


def grid(lists: dict[str, list], constants: dict | None = None) -> Iterator[dict]:
    """Configurations of a grid sweep: each combination once, feature-less ones left out."""
    seen = set()
    for values in itertools.product(*lists.values()):
        config = {**DEFAULTS, **(constants or {}), **dict(zip(lists, values))}
        label = json.dumps(config, sort_keys=True, default=list)
        if label in seen or not (config["use_tab_features"] or config["use_text_features"]):
            continue
        seen.add(label)
        yield config


def run_sweep(
    train: DataFrame, eval_: DataFrame, lists: dict[str, list], constants: dict | None = None, at_once: int = 4
) -> DataFrame:
    """Run rows of a whole grid, in its order; a grid without runs gives none.

    Features are fitted and computed once for each feature setting and written;
    the runs over them go ``at_once`` at a time, each in a scheduler pool of its
    own, which share the executors evenly where ``spark.scheduler.mode`` is FAIR.
    """
    spark = train.sparkSession
    models = [(f"run-{i}", c, model_of(f"run-{i}", c)) for i, c in enumerate(grid(lists, constants))]
    labelled = materialize(_labelled(train, eval_), "sweep-rows")
    by_setting = {feature_setting(m): m for _, _, m in models}

    def pooled(work):
        def run(task: tuple[int, object]):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sweep-{task[0] % at_once}")
            return work(task[1])

        # the thread of the caller passes on its local properties
        return inheritable_thread_target(spark)(run)

    def features(setting: str):
        return setting, featured(by_setting[setting], labelled)

    def fit(entry: tuple[str, dict, PriceModel]) -> tuple:
        name, config, model = entry
        return run_with_features(name, model, config, *shared[feature_setting(model)])[1]

    with ThreadPool(at_once) as pool:
        shared = dict(pool.map(pooled(features), list(enumerate(by_setting)), chunksize=1))
        rows = pool.map(pooled(fit), list(enumerate(models)), chunksize=1)
    return spark.createDataFrame(rows, RUN_SCHEMA)


# The configuration that the experiments ended with.
BEST = {
    "estimator_class": "catboost",
    "use_tab_features": True,
    "use_text_features": True,
    "transformer_params.catboost_cols": ["designer", "color", "size", "subcategory"],
    "transformer_params.ohe_cols": ["department", "category"],
    "transformer_params.oe_cols": ["condition"],
    "extractor_params.vectorizer_class": "tfidf",
    "extractor_params.vectorizer_params": {"ngram_range": [1, 3], "min_df": 5},
    "extractor_params.reducer_class": "pca",
    "extractor_params.reducer_params": {"n_components": 100},
}


def retrain(train: DataFrame, eval_: DataFrame, path: str, config: dict | None = None, name: str = "best") -> FittedPriceModel:
    """Fit on train and eval together and save the model."""
    fitted = model_of(name, config or BEST).fit(train.unionByName(eval_))
    fitted.save(path)
    return fitted


def prediction_metadata(model_name: str, at: Column) -> Column:
    return F.create_map(
        F.lit("model_name"), F.lit(model_name), F.lit("prediction_timestamp"), iso_timestamp(at)
    )


def score(listings: DataFrame, model: FittedPriceModel, at: Column | None = None, columns=TEXT_COLUMNS) -> DataFrame:
    """Priced listings: cleaned text, whole price, prediction id and metadata."""
    at = F.current_timestamp() if at is None else at
    cleaned = listings.withColumns({c: clean_text(F.col(c)) for c in columns})
    priced = model.predict(cleaned, "__price")
    return priced.select(
        "id",
        prediction_id(at).alias("prediction_id"),
        whole_price(F.col("__price")).alias("predicted_price"),
        prediction_metadata(model.spec.model_name, at).alias("metadata"),
    )


def score_valid(listings: DataFrame, model: FittedPriceModel, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored rows with status SUCCESS, invalid rows with status FAILURE and their violations)."""
    checked = validate(listings)
    good = checked.where(F.size("violations") == 0).drop("violations")
    bad = checked.where(F.size("violations") > 0)
    return (
        score(good, model, at).withColumn("status", F.lit("SUCCESS")),
        bad.select("id", "violations").withColumn("status", F.lit("FAILURE")),
    )
