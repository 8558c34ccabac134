"""Experiment-run queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import aggregates as A
from pricewright.operators import reshape as R
from pricewright.operators import runs as X
from pricewright.operators import select as S
from pricewright.operators import windows as W
from pricewright.plans.registry import query

COLS = "transformer_params.catboost_cols"


@query(
    "run_feature_metrics",
    "PRJ5 RSH2 JOI2 SRC7",
    """WITH r AS (SELECT CASE WHEN use_tab_features AND use_text_features THEN 'both'
                             WHEN use_tab_features THEN 'tabular' ELSE 'text' END AS features_used, * FROM {runs})
       SELECT features_used, estimator_class, 'rmsle_train' AS rmsle, rmsle_train AS rmsle_value,
              'wape_train' AS wape, wape_train AS wape_value FROM r
       UNION ALL SELECT features_used, estimator_class, 'rmsle_eval', rmsle_eval, 'wape_eval', wape_eval FROM r""",
)
def run_feature_metrics(t):
    return R.melt_metrics(X.with_features_used(t.runs()), ["features_used", "estimator_class"])


@query(
    "run_encoder_comparison",
    "PRJ3 PRJ6 SET3 FLT4",
    """WITH r AS {runs}
       SELECT run, estimator_class, rmsle_eval, catboost_cols AS "transformer_params.catboost_cols", NULL::DOUBLE AS wape_eval,
              CASE WHEN len(catboost_cols) = 4 THEN 'mid_high'
                   WHEN list_contains(catboost_cols, 'color') THEN 'high' ELSE 'mid' END AS cboost_encoder_cols FROM r
       UNION ALL SELECT run, estimator_class, rmsle_eval, NULL, wape_eval, 'none' FROM r
       WHERE use_tab_features AND use_text_features""",
)
def run_encoder_comparison(t):
    runs = t.runs()
    labelled = X.with_encoder_label(runs.select("run", "estimator_class", "rmsle_eval", f"`{COLS}`"))
    plain = S.tag(
        X.both_feature_kinds(runs).select("run", "estimator_class", "rmsle_eval", "wape_eval"), "cboost_encoder_cols", "none"
    )
    return W.union_ragged(labelled, plain)


@query(
    "run_short_names",
    "PRJ2",
    "SELECT run, normalize_size, catboost_cols, rmsle_train AS train, rmsle_eval AS eval FROM {runs}",
)
def run_short_names(t):
    short = S.shorten_run_columns(t.runs())
    short = S.shorten_run_columns(short, {"rmsle_train": "train", "rmsle_eval": "eval"})
    return short.select("run", "normalize_size", "catboost_cols", "train", "eval")


@query(
    "run_condition_encoder",
    "FLT4 PRJ3 SET3",
    """WITH r AS {runs}
       SELECT run, rmsle_eval, 'ordinal' AS condition_encoder FROM r WHERE len(catboost_cols) = 4
       UNION ALL SELECT run, rmsle_eval, 'ohe' FROM r WHERE sweep = '2-HIGH'""",
)
def run_condition_encoder(t):
    runs = t.runs()
    ordinal = S.tag(X.with_list_length(runs, 4).select("run", "rmsle_eval"), "condition_encoder", "ordinal")
    one_hot = S.tag(S.where_equal(runs, sweep="2-HIGH").select("run", "rmsle_eval"), "condition_encoder", "ohe")
    return W.union_ragged(one_hot, ordinal)


@query(
    "tuning_progress",
    "WIN2 WIN3",
    """SELECT sweep, run, rmsle_eval,
              min(rmsle_eval) OVER (PARTITION BY sweep ORDER BY _timestamp, run
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_rmsle_eval,
              row_number() OVER (PARTITION BY sweep ORDER BY _timestamp, run) - 1 AS "try" FROM {runs}""",
)
def tuning_progress(t):
    runs = t.runs().select("sweep", "run", "_timestamp", "rmsle_eval")
    return W.running_best(runs, ["sweep"], ["_timestamp", "run"]).drop("_timestamp")


@query(
    "order_price_floor",
    "WIN2 WIN3",
    """SELECT o_orderkey, min(o_totalprice) OVER w AS running_o_totalprice, row_number() OVER w - 1 AS "try" FROM orders
       WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def order_price_floor(t):
    """The running form over a whole table; slices of a few thousand rows show the large-table path."""
    rows = t.table("orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    out = W.running_best(rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_totalprice", rows_per_slice=4000)
    return out.select("o_orderkey", "running_o_totalprice", "try")


@query(
    "tuning_before_after",
    "AGG13",
    """SELECT 'before' AS tuning, min(rmsle_eval) AS rmsle_eval FROM {runs} WHERE sweep = '1-URGENT'
       UNION ALL SELECT 'after', min(rmsle_eval) FROM {runs} WHERE sweep = '5-LOW'""",
)
def tuning_before_after(t):
    runs = t.runs()
    return A.before_after(S.where_equal(runs, sweep="1-URGENT"), S.where_equal(runs, sweep="5-LOW"))


@query(
    "gain_over_baseline",
    "AGG17 AGG13 SRT1",
    """WITH g AS (SELECT estimator_class, sweep, min(rmsle_eval) AS rmsle_eval FROM {runs} GROUP BY ALL)
       SELECT *, round(100 * (1.017 - rmsle_eval) / 1.017, 9) AS improvement_pct,
              1.017::DOUBLE - rmsle_eval >= 0.01 AS is_significant FROM g""",
)
def gain_over_baseline(t):
    best = X.best_runs(t.runs(), ["estimator_class", "sweep"])
    out = A.improvement(best, 1.017).withColumn("improvement_pct", F.round("improvement_pct", 9))
    return out.orderBy(F.asc("rmsle_eval"), "estimator_class", "sweep")


@query(
    "nested_run_settings",
    "RSH4",
    """SELECT run, len(catboost_cols) AS n_cols, normalize_size FROM {runs}""",
)
def nested_run_settings(t):
    nested = R.nest_columns(t.runs())
    return nested.select(
        "run", F.size("transformer_params.catboost_cols").alias("n_cols"), "transformer_params.normalize_size"
    )


@query(
    "setting_labels",
    "PRJ2 FLT4",
    """SELECT run, '[' || array_to_string(catboost_cols, ', ') || ']' AS label FROM {runs}
       WHERE use_tab_features AND use_text_features""",
)
def setting_labels(t):
    return X.both_feature_kinds(t.runs()).select("run", X.list_label(F.col(f"`{COLS}`")).alias("label"))
