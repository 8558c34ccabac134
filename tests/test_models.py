import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricewright.operators import experiments as X
from pricewright.operators import splits as P
from pricewright.operators.models import FittedPriceModel, PriceModel
from pricewright.operators.regressors import linear_regression
from pricewright.operators.stages import TabularFeatures, TabularFeaturesModel
from pricewright.session import fresh_path


@pytest.fixture(scope="module")
def listings(spark):
    k = F.col("id")
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (k % len(v) + 1).cast("int"))
    return spark.range(400).select(
        k.cast("string").alias("id"),
        (k % 9 + 1).cast("int").alias("n_photos"),
        pick("acme", "bolt", "crow", "dune", "ember", "fox", "gray").alias("designer"),
        pick("menswear", "womenswear").alias("department"),
        pick("tops", "footwear", "accessories").alias("category"),
        pick("polos", "boots", "belts", "denim").alias("subcategory"),
        pick("S", "M", "9", "28", "34R").alias("size"),
        pick("red", "blue", "black").alias("color"),
        pick("New", "Used", "Worn", "Gently Used").alias("condition"),
        F.concat(F.lit("item "), pick("shirt", "boot")).alias("item_name"),
        F.concat(F.lit("a great "), pick("red", "old", "rare"), F.lit(" thing number "), k.cast("string")).alias("description"),
        F.when(k % 4 == 0, "missing").otherwise("tag one").alias("hashtags"),
        (50 + (k % 7) * 60 + (k % 3) * 10 + (k % 9) * 3).cast("int").alias("sold_price"),
    )


def test_unknown_estimator_and_no_features():
    with pytest.raises(ValueError, match="unknown estimator_class"):
        PriceModel("m", "nothing")
    with pytest.raises(ValueError, match="tabular features, text features or both"):
        PriceModel("m", use_tab_features=False, use_text_features=False)


@pytest.mark.parametrize("kind", ["ridge", "lasso", "enet"])
def test_penalties_match_the_sum_of_squares_scale(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 3)) * [1.0, 5.0, 0.3]
    y = x @ [2.0, -1.0, 3.0] + 4 + rng.standard_normal(200)
    alpha, ratio = (30.0, 0.0) if kind == "ridge" else (0.4, 1.0 if kind == "lasso" else 0.5)
    df = spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "y"])
    fitted = linear_regression(kind, {"alpha": alpha, "l1_ratio": ratio, "max_iter": 500}, 200, float(y.std()),
                               dict(featuresCol="features", labelCol="y")).setTol(1e-10).fit(df)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.zeros(3)
    l1, l2 = (0.0, alpha) if kind == "ridge" else (200 * alpha * ratio, 200 * alpha * (1 - ratio))
    for _ in range(2000):  # coordinate descent on 1/2 |y - xw|^2 + l1 |w| + l2/2 |w|^2
        for j in range(3):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j])
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (xc[:, j] @ xc[:, j] + l2)
    assert np.array(fitted.coefficients) == pytest.approx(w, abs=2e-3)


def test_model_beats_the_median_and_survives_saving(spark, listings):
    train, eval_, test = P.split(listings, "id")
    median = PriceModel("base", "c-median").fit(train).evaluate(eval_)
    config = {"estimator_class": "ridge", "use_text_features": True,
              "extractor_params.reducer_params": {"n_components": 3},
              "extractor_params.vectorizer_params": {"max_features": 20},
              "transformer_params.catboost_cols": ["designer", "size"]}
    fitted, run = X.run_experiment("r", train, eval_, config)
    row = run.first()
    assert row["rmsle_eval"] < median["rmsle"] and row["wape_eval"] >= 0
    path = fresh_path(spark, "saved")
    fitted.save(path, {"rmsle": row["rmsle_eval"]})
    loaded, metrics = FittedPriceModel.load(spark, path)
    assert metrics == {"rmsle": row["rmsle_eval"]}
    before = {r["id"]: r["prediction"] for r in fitted.predict(test).collect()}
    after = {r["id"]: r["prediction"] for r in loaded.predict(test).collect()}
    assert before.keys() == after.keys() and min(before.values()) >= 0
    for key in before:
        assert after[key] == pytest.approx(before[key])
    with pytest.raises(FileNotFoundError):
        FittedPriceModel.load(spark, path + "-absent")


@pytest.mark.parametrize("kind, params", [("gboost", {"n_estimators": 5}), ("knn", {}), ("rforest", {"n_estimators": 5})])
def test_other_estimators_predict_every_row(listings, kind, params):
    model = PriceModel("m", kind, estimator_params=params).fit(listings)
    got = model.predict(listings).agg(F.count("prediction"), F.min("prediction")).first()
    assert got[0] == 400 and got[1] >= 0


def test_grid_drops_repeats_and_featureless_runs():
    configs = list(X.grid({"estimator_class": ["lasso", "lasso"], "use_tab_features": [True, False]}))
    assert len(configs) == 1
    assert configs[0]["use_tab_features"]


def test_scoring_routes_invalid_listings(listings):
    model = PriceModel("m", "ridge").fit(listings)
    asked = listings.withColumn("condition", F.when(F.col("id") == "5", "Torn").otherwise(F.col("condition")))
    good, bad = X.score_valid(asked, model, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    assert (good.count(), bad.count()) == (399, 1)
    row = good.first()
    assert row["prediction_id"] == "pred_20240201_000000"
    assert row["metadata"] == {"model_name": "m", "prediction_timestamp": "2024-02-01T00:00:00.000000"}
    assert isinstance(row["predicted_price"], int)


def test_splits_are_disjoint_exhaustive_and_repeatable(spark):
    df = spark.range(3000)
    parts = P.split(df, "id")
    again = P.split(df.repartition(13), "id")
    ids = [{r[0] for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 3000 and len(set.union(*ids)) == 3000
    assert ids == [{r[0] for r in p.collect()} for p in again]
    assert len(ids[0]) == pytest.approx(1800, rel=0.05)
    assert [p.count() for p in P.split_exact(df, "id", exact_rows=100)] == [1800, 600, 600]


def test_pipelines_are_stored_before_and_after_fitting(spark, listings):
    unfitted = PriceModel("near", "knn", estimator_params={"n_neighbors": 3}).pipeline()
    path = fresh_path(spark, "pipeline")
    unfitted.write().save(f"{path}/unfitted")
    fitted = Pipeline.load(f"{path}/unfitted").fit(listings)
    fitted.write().save(f"{path}/fitted")
    loaded = PipelineModel.load(f"{path}/fitted")
    # repeated and NULL ids keep their rows and get the prediction of their own features
    asked = listings.where("id < 6").withColumn("id", F.when(F.col("n_photos") > 3, "same")).drop("sold_price")
    before, after = ([(r["id"], r["n_photos"], r["__price_of_model"]) for r in p.transform(asked).collect()] for p in (fitted, loaded))
    assert sorted(before, key=str) == sorted(after, key=str)
    assert len(before) == asked.count() and all(r[2] > 0 for r in before) and {r[0] for r in before} == {"same", None}


def test_a_stage_without_metadata_does_not_load(spark, listings, tmp_path):
    stage = TabularFeatures(settings={"ohe_cols": ["department"]}, labelCol="sold_price", outputCol="v").fit(listings)
    for table in stage.tables().values():
        table.write.parquet(f"{tmp_path}/cut/category-stats")
    with pytest.raises(Exception, match="metadata"):
        TabularFeaturesModel.load(f"{tmp_path}/cut")
    stage.write().save(f"{tmp_path}/whole")
    again = TabularFeaturesModel.load(f"{tmp_path}/whole")
    assert again.fitted.names() == stage.fitted.names()
    a, b = ({r["id"]: r["v"] for r in s.transform(listings).collect()} for s in (stage, again))
    assert a == b


def test_sweeps_share_features_and_keep_the_order_of_the_grid(listings, monkeypatch):
    train, eval_, _ = P.split(listings, "id")
    made = []
    featured = X.featured
    monkeypatch.setattr(X, "featured", lambda model, rows: made.append(X.feature_setting(model)) or featured(model, rows))
    lists = {"estimator_class": ["c-median", "ridge", "lr"], "transformer_params.te_cols": [["designer"], ["color"]]}
    runs = X.run_sweep(train, eval_, lists).collect()
    assert [r["run"] for r in runs] == [f"run-{i}" for i in range(6)]
    assert sorted(made) == sorted(set(made)) and len(made) == 3
    monkeypatch.undo()
    alone = X.run_experiment("one", train, eval_, {"estimator_class": "ridge", "transformer_params.te_cols": ["color"]})[1].first()
    assert [alone[c] for c in ("rmsle_train", "wape_train", "rmsle_eval", "wape_eval")] == [runs[3][c] for c in ("rmsle_train", "wape_train", "rmsle_eval", "wape_eval")]
    assert X.run_sweep(train, eval_, {"estimator_class": ["lr"], "use_tab_features": [False]}).collect() == []


def test_prepared_parts_are_counted_while_written(spark):
    df = spark.createDataFrame([(i % 300, f"red shirts {i % 300}", None) for i in range(600)], "id long, description string, note string")
    rows, sizes = P.write_datasets(df, 250, columns=("description",))
    assert sum(sizes.values()) == 250
    assert {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()} == sizes
    assert sorted(r["id"] for r in rows.collect()) == list(range(250))
    assert {r["description"] for r in rows.where("id = 7").collect()} == {"red shirt 7"}
    with pytest.raises(ValueError, match="301"):
        P.write_datasets(df, 301, columns=("description",))
    parts = P.prepare_datasets(df, None, columns=("description",), exact=True)
    assert [p.count() for p in parts] == [180, 60, 60]
    none, sizes = P.write_datasets(df.where("false"), None, columns=("description",))
    assert none.collect() == [] and sizes == {"train": 0, "eval": 0, "test": 0}
