"""Model, experiment, scoring and streaming queries."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from pricewright.operators import experiments as X
from pricewright.operators import splits as P
from pricewright.operators.models import FittedPriceModel, PriceModel
from pricewright.operators.ordered_codes import OrderedTargetEncoder, ordered_codes
from pricewright.operators.partitioning import spread_evenly
from pricewright.operators.regressors import tree_estimator
from pricewright.operators.text_plan import TextPlan
from pricewright.plans.registry import query
from pricewright.plans.views import request_rows
from pricewright.session import fresh_path, materialize
from pricewright.sources.writers import only_new
from pricewright.streaming import flows

TABULAR = ("id", "n_photos", "designer", "department", "category", "subcategory", "size", "color", "condition", "sold_price")
TEXTUAL = ("item_name", "description", "hashtags")


def _parts(t, *columns) -> tuple[DataFrame, DataFrame]:
    train, eval_, _ = P.split(t.described(*columns), "id")
    return train, eval_


def _experiment(t, estimator: str, text: bool = False, **config) -> DataFrame:
    train, eval_ = _parts(t, *TABULAR, *(TEXTUAL if text else ()))
    settings = {"estimator_class": estimator, "use_text_features": text, **config}
    return X.run_experiment(estimator, train, eval_, settings)[1]


_LINEAR = (("lr", {}), ("ridge", {"estimator_params.alpha": 1.0}), ("lasso", {"estimator_params.alpha": 0.01}),
           ("enet", {"estimator_params.alpha": 0.01}), ("huber", {}))
_TREES = (("dtree", {}), ("rforest", {"estimator_params.n_estimators": 20}), ("xtrees", {"estimator_params.n_estimators": 20}),
          ("gboost", {"estimator_params.n_estimators": 20}),
          ("catboost", {"estimator_params.n_estimators": 20,
                        "transformer_params.catboost_cols": ["designer", "color", "size", "subcategory"]}))


_MEDIAN_SQL = """WITH d AS (SELECT *, ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 AS u FROM {described}),
       m AS (SELECT exp(quantile_cont(ln(1 + sold_price), 0.5)) - 1 AS p FROM d WHERE u < 0.6),
       e AS (SELECT u < 0.6 AS train, round_even(sqrt(avg(pow(ln(1 + sold_price) - ln(1 + p), 2))), 3) AS rmsle,
                    round_even(sum(abs(sold_price - p)) / sum(sold_price), 2) AS wape FROM d, m WHERE u < 0.8 GROUP BY 1)
       SELECT 'c-median' AS run, '{"estimator_class": "c-median", "use_text_features": false}' AS config,
              'c-median' AS estimator_class, true AS use_tab_features, false AS use_text_features,
              max(rmsle) FILTER (WHERE train) AS rmsle_train, max(wape) FILTER (WHERE train) AS wape_train,
              max(rmsle) FILTER (WHERE NOT train) AS rmsle_eval, max(wape) FILTER (WHERE NOT train) AS wape_eval FROM e"""


def _register(kind: str, config: dict, ids: str, sql: str | None = None) -> None:
    @query(f"experiment_{kind.replace('-', '_')}", ids, sql)
    def build(t):
        return _experiment(t, kind, **config)


for _kind, _config in _LINEAR:
    _register(_kind, _config, "ML3 ML8")
for _kind, _config in _TREES:
    _register(_kind, _config, "ML5 ML8" if _kind == "catboost" else "ML4 ML8")
_register("knn", {}, "ML6 ML8")
_register("c-median", {}, "ML7 ML8 AGG15 AGG16", _MEDIAN_SQL)

_TEXT = {
    "extractor_params.vectorizer_params": {"ngram_range": [1, 1], "max_features": 300, "min_df": 2},
    "extractor_params.reducer_params": {"n_components": 10},
}


@query("experiment_text_and_tabular", "ML8 ENC11 ENC14 ENC16")
def experiment_text_and_tabular(t):
    return _experiment(t, "ridge", text=True, **_TEXT)


@query("text_feature_vectors", "ENC14 ENC16")
def text_feature_vectors(t):
    """Wide vocabulary, so the reduction runs as subspace iteration."""
    from pyspark.ml.functions import vector_to_array

    rows = t.described("id", *TEXTUAL)
    plan = TextPlan(
        vectorizer_class="tfidf",
        vectorizer_params={"ngram_range": (1, 1), "max_features": 3000, "min_df": 2},
        reducer_params={"n_components": 8},
    )
    out = plan.fit(rows).transform(rows)
    return out.select("id", vector_to_array("text_features").alias("text_features"))


@query("feature_sweep", "ML9 SRC7")
def feature_sweep(t):
    train, eval_ = _parts(t, *TABULAR, *TEXTUAL)
    lists = {"estimator_class": ["ridge", "ridge", "c-median"], "use_tab_features": [True, False], "use_text_features": [False]}
    return X.run_sweep(train, eval_, lists)


_ONE_FEATURE_SQL = """WITH d AS (SELECT *, ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 AS u, ln(1 + sold_price) AS y
            FROM {described}),
       f AS (SELECT 'designer' AS feature, designer AS category, u < 0.6 AS train, sold_price, y FROM d WHERE u < 0.8
             UNION ALL SELECT 'color', color, u < 0.6, sold_price, y FROM d WHERE u < 0.8
             UNION ALL SELECT 'category', category, u < 0.6, sold_price, y FROM d WHERE u < 0.8),
       q AS (SELECT avg(y) AS prior, quantile_cont(y, 0.5) AS med FROM d WHERE u < 0.6),
       s AS (SELECT feature, category, count(*) AS n, sum(y) AS total, 1 / (1 + exp(-(count(*) - 20) / 10.0::DOUBLE)) AS w
             FROM f WHERE train GROUP BY ALL),
       x AS (SELECT f.*, coalesce(prior * (1 - w) + total / n * w, prior) AS x FROM f LEFT JOIN s USING (feature, category), q),
       m AS (SELECT feature, avg(x) AS xm, avg(y) AS ym, covar_pop(y, x) AS c, var_pop(x) AS v, count(*) AS n FROM x WHERE train GROUP BY 1),
       k AS (SELECT feature, xm, ym, estimator_class,
                    CASE estimator_class WHEN 'lr' THEN c / v WHEN 'ridge' THEN c * n / (v * n + 0.01)
                         WHEN 'lasso' THEN sign(c) * greatest(abs(c) - 0.01, 0) / v END AS slope
             FROM m, (VALUES ('c-median'), ('lr'), ('ridge'), ('lasso')) e(estimator_class)),
       p AS (SELECT estimator_class, feature, train, sold_price,
                    exp(CASE estimator_class WHEN 'c-median' THEN med ELSE ym + slope * (x - xm) END) - 1 AS p
             FROM x JOIN k USING (feature), q),
       e AS (SELECT estimator_class, feature, train, round_even(sqrt(avg(pow(ln(1 + sold_price) - ln(1 + p), 2))), 3) AS rmsle,
                    round_even(sum(abs(sold_price - p)) / sum(sold_price), 2) AS wape FROM p GROUP BY ALL)
       SELECT estimator_class, feature, max(rmsle) FILTER (WHERE train) AS rmsle_train, max(wape) FILTER (WHERE train) AS wape_train,
              max(rmsle) FILTER (WHERE NOT train) AS rmsle_eval, max(wape) FILTER (WHERE NOT train) AS wape_eval FROM e GROUP BY ALL"""


@query("one_feature_sweep", "ML9 ML8 ML3 ML7 ENC6 ENC11", _ONE_FEATURE_SQL)
def one_feature_sweep(t):
    """Twelve runs over three feature settings of one encoded column each, whose fits have closed forms."""
    train, eval_ = _parts(t, *TABULAR)
    lists = {"estimator_class": ["c-median", "lr", "ridge", "lasso"], "transformer_params.te_cols": [["designer"], ["color"], ["category"]]}
    others = {f"transformer_params.{kind}_cols": [] for kind in ("numeric", "ohe", "oe")}
    runs = X.run_sweep(train, eval_, lists, {**others, "estimator_params.alpha": 0.01})
    feature = F.get_json_object("config", "$['transformer_params.te_cols'][0]")
    return runs.select("estimator_class", feature.alias("feature"), "rmsle_train", "wape_train", "rmsle_eval", "wape_eval")


def _ordered_parts(t):
    train, _, test = P.split(t.described(*TABULAR), "id")
    train = train.withColumn("log_price", F.log1p("sold_price"))
    return train, test, OrderedTargetEncoder(["designer", "color", "size", "subcategory"])


_ORDERED_SQL = """WITH d AS (SELECT *, ln(1 + sold_price) AS y, ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 AS u FROM {described}),
       f AS (SELECT id, y, unnest(['designer', 'color', 'size', 'subcategory']) AS feature,
                    unnest([designer, color, size, subcategory]) AS category FROM d WHERE u < 0.6),
       q AS (SELECT avg(y) AS prior FROM d WHERE u < 0.6),
       o AS (SELECT f.*, k AS permutation, substr(md5(id || '#' || (42 + k)), 1, 13) AS place FROM f, range(4) r(k))
       SELECT id, feature, permutation, round((coalesce(sum(y) OVER w, 0) + prior) / (count(*) OVER w + 1), 8) AS code FROM o, q
       WINDOW w AS (PARTITION BY feature, category, permutation ORDER BY place, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("ordered_target_codes", "ML5 ENC8", _ORDERED_SQL)
def ordered_target_codes(t):
    """The codes of every training row in each of four orders."""
    train, _, encoder = _ordered_parts(t)
    codes = ordered_codes(train, encoder.columns, "log_price", "id", encoder.permutations, encoder.a, encoder.seed)
    return codes.select(F.col("key").alias("id"), "feature", F.col("permutation").cast("long").alias("permutation"), F.round("code", 8).alias("code"))


@query(
    "ordered_boosting",
    "ML5 ENC8",
    """SELECT id, true AS is_priced, true AS fits_better_than_mean FROM {described}
       WHERE ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 >= 0.8""",
)
def ordered_boosting(t):
    """A hundred trees over ordered codes; test rows carry the codes of all training rows."""
    train, test, encoder = _ordered_parts(t)
    coded = encoder.fit(train, "log_price", "id")
    columns = ["n_photos", *[f"{c}_enc" for c in encoder.columns]]
    vectors = VectorAssembler(inputCols=columns, outputCol="features")
    rows = materialize(vectors.transform(coded.training(train)).select("features", "log_price"), "boosting-rows")
    model = tree_estimator("catboost", {"n_estimators": 100}, {"featuresCol": "features", "labelCol": "log_price"}).fit(spread_evenly(rows))
    gap = F.col("log_price") - F.col("prediction")
    fit = model.transform(rows).agg((F.avg(gap * gap) < F.var_pop("log_price")).alias("fits_better_than_mean"))
    priced = model.transform(vectors.transform(coded.transform(test))).select("id", (F.expm1("prediction") > 0).alias("is_priced"))
    return priced.crossJoin(F.broadcast(fit))  # one row


def _small_model(t, name: str = "ridge") -> FittedPriceModel:
    train, _ = _parts(t, *TABULAR, *TEXTUAL)
    return PriceModel(name, "ridge").fit(train)


@query("retrained_model_scores", "ML10 SNK5 ML11")
def retrained_model_scores(t):
    train, eval_ = _parts(t, *TABULAR, *TEXTUAL)
    path = fresh_path(t.spark, "model")
    X.retrain(train, eval_, path, {"estimator_class": "ridge"}, "retrained")
    model, _ = FittedPriceModel.load(t.spark, path)
    _, _, test = P.split(t.described(*TABULAR, *TEXTUAL), "id")
    return X.score(test, model, F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query(
    "stored_model_predictions",
    "ML10 SNK5 ENC9 ENC13 ENC14 ENC16",
    """SELECT id, true AS is_equal, true AS is_priced FROM {described}
       WHERE ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 >= 0.8""",
)
def stored_model_predictions(t):
    """The encoders of the final configuration, TF-IDF and a ridge model: fitted, saved as stages and tables, loaded.

    Both models price every test row alike.
    """
    train, eval_, test = P.split(t.described(*TABULAR, *TEXTUAL), "id")
    path = fresh_path(t.spark, "stored-model")
    fitted = X.retrain(train, eval_, path, {**X.BEST, "estimator_class": "ridge", **_TEXT})
    loaded, _ = FittedPriceModel.load(t.spark, path)
    before = fitted.predict(test).select("id", F.col("prediction").alias("before"))
    after = loaded.predict(test).select("id", F.col("prediction").alias("after"))
    same = F.col("before").eqNullSafe(F.col("after"))
    return before.join(after, "id", "full_outer").select("id", same.alias("is_equal"), F.coalesce(F.col("after") > 0, F.lit(False)).alias("is_priced"))


@query("scored_listings", "ML11 PRJ8 STR-15")
def scored_listings(t):
    return X.score(t.described(*TABULAR, *TEXTUAL), _small_model(t), F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query(
    "usage_stream",
    "STM3 AGG14",
    """WITH r AS {requests},
       g AS (SELECT date_trunc('day', "timestamp") AS start, request_path, count(*) AS requests,
                    round(avg(response_time), 6) AS avg_response_time,
                    100.0::DOUBLE * count(*) FILTER (WHERE status_code >= 400) / count(*) AS error_rate
             FROM r GROUP BY ALL)
       SELECT start, request_path, requests, avg_response_time, error_rate FROM g
       WHERE start + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM r) - INTERVAL 10 MINUTE""",
)
def usage_stream(t):
    out, checkpoint = fresh_path(t.spark, "usage"), fresh_path(t.spark, "usage-checkpoint")
    flows.usage_stream(request_rows(t.stream("events")), out, checkpoint).awaitTermination()
    rows = t.spark.read.parquet(out)
    return rows.select(
        F.col("start").cast("timestamp_ntz").alias("start"), "request_path", "requests",
        F.round("avg_response_time", 6).alias("avg_response_time"), "error_rate",
    )


@query(
    "usage_updates",
    "STM3 AGG14",
    """WITH r AS {requests}
       SELECT date_trunc('day', "timestamp") AS start, request_path, count(*) AS requests,
              round(avg(response_time), 6) AS avg_response_time,
              100.0::DOUBLE * count(*) FILTER (WHERE status_code >= 400) / count(*) AS error_rate
       FROM r GROUP BY ALL""",
)
def usage_updates(t):
    """The whole log, read out of order in several micro-batches; every window is there, the open ones too."""
    log, out, checkpoint = (fresh_path(t.spark, f"usage-{name}") for name in ("log", "totals", "checkpoint"))
    requests = t.requests()
    # rows of one day are dealt over all files
    requests.repartition(5, F.pmod(F.xxhash64("id"), F.lit(5))).write.parquet(log)
    stream = t.spark.readStream.schema(t.spark.read.parquet(log).schema).option("maxFilesPerTrigger", 1).parquet(log)
    flows.usage_updates(stream, out, checkpoint).awaitTermination()
    rows = flows.read_usage(t.spark, out)
    return rows.select(
        F.col("start").cast("timestamp_ntz").alias("start"), "request_path", "requests",
        F.round("avg_response_time", 6).alias("avg_response_time"), "error_rate",
    )


@query(
    "request_log_stream",
    "SNK6 STM3 SRC6",
    """WITH r AS {requests} SELECT id, request_path, status_code FROM r""",
)
def request_log_stream(t):
    out, checkpoint = fresh_path(t.spark, "requests"), fresh_path(t.spark, "requests-checkpoint")
    flows.append_stream(request_rows(t.stream("events")), out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out).select("id", "request_path", "status_code")


@query(
    "ingest_stream",
    "STM1 DQ4 SNK3",
    """SELECT CAST(doc_id AS VARCHAR) AS id, DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS parsing_date,
              coalesce(CASE WHEN doc_id % 3 <> 0 THEN lang END, 'missing') AS hashtags,
              CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 40 AS VARCHAR) ELSE source END AS size FROM documents""",
)
def ingest_stream(t):
    arriving = t.stream("documents")
    k = F.col("doc_id")
    listings = arriving.select(
        k.cast("string").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int")).alias("parsing_date"),
        F.when(k % 3 != 0, F.col("lang")).alias("hashtags"),
        F.when(k % 2 == 0, F.concat(F.lit("Men's / US "), (k % 40).cast("string"))).otherwise(F.col("source")).alias("size"),
    )
    out, checkpoint = fresh_path(t.spark, "ingest"), fresh_path(t.spark, "ingest-checkpoint")
    flows.ingest_stream(listings, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out).select("id", F.col("parsing_date").cast("date").alias("parsing_date"), "hashtags", "size")


@query(
    "score_stream",
    "STM2 ML11 DQ3",
    """SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN v = '' THEN 'SUCCESS' ELSE 'FAILURE' END AS status, v = '' AS is_priced,
              nullif(v, '') AS violations
       FROM (SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 5 = 0 THEN 'condition' END,
                                      CASE WHEN doc_id % 30 NOT BETWEEN 1 AND 25 THEN 'n_photos' END) AS v FROM documents)""",
)
def score_stream(t):
    """Submitted listings scored as they arrive; those with violations fail with the reasons."""
    model = _small_model(t, "stream")
    arriving = t.stream("documents")
    k = F.col("doc_id")
    listings = arriving.select(
        k.cast("string").alias("id"),
        F.when(k % 3 == 0, "womenswear").otherwise("menswear").alias("department"),
        F.lit("tops").alias("category"),
        F.lit("polos").alias("subcategory"),
        F.when(k % 5 == 0, "Torn").otherwise("New").alias("condition"),
        F.lit("M").alias("size"),
        F.lit("Brand#1").alias("designer"),
        F.lit("red").alias("color"),
        (k % 30).cast("int").alias("n_photos"),
        F.substring("text", 1, 60).alias("item_name"),
        F.col("text").alias("description"),
        F.lit(None).cast("string").alias("hashtags"),
    )
    out, checkpoint = fresh_path(t.spark, "scores"), fresh_path(t.spark, "scores-checkpoint")
    flows.score_stream(listings, model, out, checkpoint).awaitTermination()
    rows = t.spark.read.parquet(out)
    return rows.select(
        "id", "status", (F.col("predicted_price") > 0).alias("priced"), F.array_join("violations", ",").alias("violations")
    ).select("id", "status", F.coalesce("priced", F.lit(False)).alias("is_priced"), "violations")


@query(
    "stored_and_new_images",
    "SNK4 JOI3",
    "SELECT doc_id || '.webp' AS name FROM documents",
)
def stored_and_new_images(t):
    """The archive after a batch that overlaps what is stored."""
    images = t.images()
    stored = images.where("doc_id % 3 = 0").select("name")
    return stored.unionByName(only_new(images.select("name"), stored, "name"))
