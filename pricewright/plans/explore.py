"""Exploration queries: counts, shares, quantile tails, histograms, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions.numeric import log_target, unlog, whole_price
from pricewright.operators import aggregates as A
from pricewright.operators import select as S
from pricewright.operators import sketches as K
from pricewright.operators import windows as W
from pricewright.operators.quantiles import quantile_table, quantiles
from pricewright.plans.registry import query
from pricewright.vocab import CATEGORICAL_COLUMNS

TAIL_SQL = """
WITH l AS {listings},
q AS (SELECT quantile_cont(sold_price, 0.25) AS lo, quantile_cont(sold_price, 0.75) AS hi FROM l),
g AS (SELECT %(feature)s, count(*) AS count, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean
      FROM l, q WHERE sold_price %(side)s GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY count DESC, %(feature)s) AS rank FROM g
QUALIFY rank <= 10
"""


def _tail(feature: str, tail: str):
    side = "> hi" if tail == "top" else "< lo"

    @query(
        f"top_{feature}s_{tail}_quarter",
        "WIN1 FLT2 AGG4 SRT1",
        TAIL_SQL % {"feature": feature, "side": side},
    )
    def build(t):
        q = quantiles(t.listings("sold_price"), [0.25, 0.75])
        return W.top_k_by_tail(t.listings(feature, "sold_price"), feature, tail, q[0.25], q[0.75])

    return build


for _feature in ("designer", "color"):
    for _tail_name in ("top", "bottom"):
        _tail(_feature, _tail_name)


@query(
    "price_quantiles",
    "AGG4",
    """
    WITH l AS {listings}
    SELECT q AS quantile, CASE q WHEN 0.25 THEN quantile_cont(sold_price, 0.25) WHEN 0.5 THEN quantile_cont(sold_price, 0.5)
           ELSE quantile_cont(sold_price, 0.75) END AS sold_price
    FROM l, (SELECT unnest([CAST(0.25 AS DOUBLE), 0.5, 0.75]) AS q) GROUP BY q
    """,
)
def price_quantiles(t):
    return quantile_table(t.listings("sold_price"), [0.25, 0.5, 0.75])


@query(
    "price_sketch_quantiles",
    "AGG4",
    """
    WITH l AS {listings}, g AS (SELECT department, count(*) AS n FROM l WHERE sold_price IS NOT NULL GROUP BY 1)
    SELECT department, q AS quantile, n, true AS is_near FROM g, (SELECT unnest([CAST(0.05 AS DOUBLE), 0.25, 0.5, 0.75, 0.95]) AS q)
    """,
)
def price_sketch_quantiles(t):
    """Sketches by department and number of photos, merged by department; every answer's rank is within one per cent."""
    rows, by = t.listings("department", "n_photos", "sold_price"), ["department"]
    sketches = K.merge_sketches(K.quantile_sketches(rows, [*by, "n_photos"], "sold_price", 0.005), by, 0.005)
    answers = K.sketch_quantiles(sketches, by, [0.05, 0.25, 0.5, 0.75, 0.95])
    near = K.rank_distance(rows, by, "sold_price", answers).select(*by, "quantile", (F.col("distance") <= 0.01).alias("is_near"))
    return near.join(sketches.select("department", "n"), by)


@query(
    "count_mean_by_photos",
    "AGG1",
    """WITH l AS {listings} SELECT n_photos, count(*) AS count, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean
       FROM l GROUP BY 1""",
)
def count_mean_by_photos(t):
    return A.count_mean(t.listings("n_photos", "sold_price"), "n_photos")


@query(
    "subcategory_bars",
    "AGG1 FLT1 SRT1",
    """WITH l AS {listings} SELECT subcategory, count(*) AS count, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean
       FROM l WHERE department = 'menswear' AND category = 'PROMO' GROUP BY 1 ORDER BY mean DESC""",
)
def subcategory_bars(t):
    rows = S.where_equal(
        t.listings("department", "category", "subcategory", "sold_price"), department="menswear", category="PROMO"
    )
    return A.count_mean(rows, "subcategory").orderBy(F.desc("mean"), "subcategory")


@query(
    "size_bars",
    "SRT2 AGG1 FLT1",
    """WITH l AS {listings}
       SELECT size, count(*) AS count, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean,
              CASE WHEN CAST(size AS INTEGER) <= 46 THEN CAST(size AS INTEGER) ELSE 90 END AS size_rank
       FROM l WHERE department = 'womenswear' GROUP BY 1 ORDER BY size_rank, size""",
)
def size_bars(t):
    rows = S.where_equal(t.listings("department", "size", "sold_price"), department="womenswear")
    return W.with_size_rank(A.count_mean(rows, "size")).orderBy("size_rank", "size")


@query(
    "condition_distribution",
    "AGG2 WIN5",
    """WITH l AS {listings}, g AS (SELECT condition, count(*) AS count FROM l GROUP BY 1)
       SELECT condition, count, CAST(count AS DOUBLE) / sum(count) OVER () AS percentage FROM g""",
)
def condition_distribution(t):
    return A.distribution(t.listings("condition"), "condition")


@query(
    "category_distribution_in_department",
    "AGG2 FLT1 WIN5",
    """WITH l AS {listings}, g AS (SELECT category, count(*) AS count FROM l WHERE department = 'menswear' GROUP BY 1)
       SELECT category, count, CAST(count AS DOUBLE) / sum(count) OVER () AS percentage FROM g""",
)
def category_distribution(t):
    return A.distribution(S.where_equal(t.listings("department", "category"), department="menswear"), "category")


@query(
    "feature_cardinality",
    "AGG3",
    "WITH l AS {listings} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_unique FROM l" for c in CATEGORICAL_COLUMNS),
)
def feature_cardinality(t):
    return A.cardinality(t.listings(*CATEGORICAL_COLUMNS), list(CATEGORICAL_COLUMNS))


@query(
    "selector_options",
    "AGG5",
    """WITH l AS {listings} SELECT DISTINCT 'department' AS feature, department AS value FROM l
       UNION ALL SELECT DISTINCT 'category', category FROM l""",
)
def selector_options(t):
    return A.unique_values(t.listings("department", "category"), ["department", "category"])


@query(
    "price_histogram",
    "AGG6",
    """WITH l AS {listings},
       r AS (SELECT min(sold_price) AS lo, max(sold_price) AS hi FROM l),
       s AS (SELECT min(step) AS step FROM (SELECT unnest([1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000]) AS step), r
             WHERE ceil(hi / step) - floor(lo / step) <= 400)
       SELECT floor(sold_price / step) * step AS bin, count(*) AS count FROM l, s GROUP BY 1""",
)
def price_histogram(t):
    return A.histogram(t.listings("sold_price"), "sold_price", 400)


@query(
    "mean_price_interval_by_photos",
    "AGG8",
    """WITH l AS {listings}
       SELECT n_photos, count(*) AS count, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean,
              round(avg(sold_price) - 1.96 * stddev_samp(sold_price) / sqrt(count(*)), 5) AS ci_low,
              round(avg(sold_price) + 1.96 * stddev_samp(sold_price) / sqrt(count(*)), 5) AS ci_high
       FROM l GROUP BY 1""",
)
def mean_price_interval(t):
    out = A.mean_ci(t.listings("n_photos", "sold_price"), "n_photos")
    return out.withColumns({c: F.round(c, 5) for c in ("ci_low", "ci_high")})


@query("bootstrap_price_interval_by_photos", "AGG8")
def bootstrap_price_interval(t):
    rows = t.listings("n_photos", "sold_price", "id", "parsing_date")
    return A.mean_ci_bootstrap(rows, "n_photos", F.concat_ws("|", "id", "parsing_date", "sold_price"), replicates=100)


@query(
    "price_trend_by_photos",
    "AGG9",
    """WITH l AS {listings},
       g AS (SELECT n_photos, CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean FROM l GROUP BY 1)
       SELECT round(regr_slope(mean, n_photos), 6) AS slope, round(regr_intercept(mean, n_photos), 4) AS intercept FROM g""",
)
def price_trend(t):
    line = A.trend(A.count_mean(t.listings("n_photos", "sold_price"), "n_photos"), "n_photos", "mean")
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


GRID = [500.0 * i for i in range(0, 41)]


@query(
    "price_density_by_department",
    "AGG11",
    """WITH l AS {listings}
       SELECT department, g AS sold_price,
              round(avg(exp(-0.5 * ((sold_price - g) / 1500.0) ^ 2)) / (1500.0 * sqrt(2 * pi())), 12) AS density
       FROM l, (SELECT unnest(range(0, 41)) * CAST(500 AS DOUBLE) AS g) GROUP BY 1, 2""",
)
def price_density(t):
    out = A.density(t.listings("department", "sold_price"), "sold_price", "department", GRID, 1500.0)
    return out.withColumn("density", F.round("density", 12))


@query(
    "price_density_by_split",
    "AGG11 PRJ3 SET2",
    """WITH l AS (SELECT CAST(round(o_totalprice) AS INTEGER) AS sold_price,
                 CASE WHEN o_orderkey % 5 < 3 THEN 'train' WHEN o_orderkey % 5 = 3 THEN 'eval' ELSE 'test' END AS dataset
                 FROM orders),
       b AS (SELECT dataset, 1.06 * least(stddev_samp(sold_price),
                    (quantile_cont(sold_price, 0.75) - quantile_cont(sold_price, 0.25)) / 1.34)
                    * pow(count(*), -0.2) AS bw FROM l GROUP BY 1)
       SELECT dataset, g AS sold_price, round(avg(exp(-0.5 * ((sold_price - g) / bw) ^ 2) / bw) / sqrt(2 * pi()), 12) AS density
       FROM l JOIN b USING (dataset), (SELECT unnest(range(0, 26)) * CAST(20000 AS DOUBLE) AS g) GROUP BY 1, 2""",
)
def price_density_by_split(t):
    rows = t.table("orders").select(F.round("o_totalprice").cast("int").alias("sold_price"), (F.col("o_orderkey") % 5).alias("k"))
    parts = W.union_same(
        S.tag(rows.where("k < 3"), "dataset", "train"),
        S.tag(rows.where("k = 3"), "dataset", "eval"),
        S.tag(rows.where("k = 4"), "dataset", "test"),
    )
    out = A.density(parts, "sold_price", "dataset", [20000.0 * i for i in range(26)])
    return out.withColumn("density", F.round("density", 12))


@query(
    "request_stats",
    "AGG14 SRC6",
    """WITH r AS {requests}
       SELECT count(*) AS total_requests, round(avg(response_time), 6) AS avg_response_time,
              100.0::DOUBLE * count(*) FILTER (WHERE status_code >= 400) / count(*) AS error_rate FROM r""",
)
def request_stats(t):
    return A.usage_stats(t.requests()).withColumn("avg_response_time", F.round("avg_response_time", 6))


@query(
    "request_stats_last_week",
    "AGG14",
    """WITH r AS {requests}
       SELECT count(*) AS total_requests, round(avg(response_time), 6) AS avg_response_time,
              100.0::DOUBLE * count(*) FILTER (WHERE status_code >= 400) / count(*) AS error_rate FROM r
       WHERE "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""",
)
def request_stats_last_week(t):
    out = A.usage_stats(t.requests(), 7, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    return out.withColumn("avg_response_time", F.round("avg_response_time", 6))


@query(
    "endpoint_usage",
    "AGG14",
    "WITH r AS {requests} SELECT request_path, count(*) AS requests FROM r GROUP BY 1",
)
def endpoint_usage(t):
    return A.endpoint_usage(t.requests())


@query(
    "model_inputs",
    "PRJ1",
    "WITH l AS {listings} SELECT * EXCLUDE (sold_price, id, parsing_date) FROM l",
)
def model_inputs(t):
    return S.features_target(t.listings())


@query(
    "target_round_trip",
    "PRJ7 PRJ8",
    """WITH l AS {listings}
       SELECT sold_price, round(ln(1 + sold_price), 9) AS log_price,
              CAST(round_even(exp(ln(1 + sold_price)) - 1, 0) AS INTEGER) AS price_back,
              round_even(sold_price / CAST(8 AS DOUBLE), 2) AS eighth
       FROM l""",
)
def target_round_trip(t):
    rows = t.listings("sold_price")
    logged = log_target(F.col("sold_price"))
    return rows.select(
        "sold_price",
        F.round(logged, 9).alias("log_price"),
        whole_price(unlog(logged)).alias("price_back"),
        F.bround(F.col("sold_price") / F.lit(8.0), 2).alias("eighth"),
    )


@query(
    "listing_display",
    "PRJ10",
    "WITH l AS {described} SELECT hashtags, id, designer, sold_price FROM l",
)
def listing_display(t):
    return S.display_listings(t.described("id", "parsing_date", "designer", "sold_price", "hashtags"))


@query(
    "hashtag_usage",
    "PRJ9 AGG1",
    """WITH d AS {described}
       SELECT CASE WHEN hashtags = 'missing' THEN 'no' ELSE 'yes' END AS hashtag_usage, count(*) AS count,
              CAST(sum(sold_price) AS DOUBLE) / count(*) AS mean FROM d GROUP BY 1""",
)
def hashtag_usage(t):
    rows = t.described("hashtags", "sold_price").withColumn("hashtag_usage", S.hashtag_usage(F.col("hashtags")))
    return A.count_mean(rows, "hashtag_usage")


@query(
    "hashtags_blanked_and_filled",
    "PRJ4",
    """WITH d AS {described}
       SELECT id, CASE WHEN hashtags = 'missing' THEN '' ELSE hashtags END AS hashtags FROM d""",
)
def hashtags_blanked(t):
    rows = t.described("id", "hashtags").withColumn("hashtags", F.nullif("hashtags", F.lit("missing")))
    return S.blank_placeholder(S.fill_missing(rows))


@query(
    "both_price_tails",
    "FLT2",
    """WITH l AS {listings},
       q AS (SELECT quantile_cont(sold_price, 0.25) AS lo, quantile_cont(sold_price, 0.75) AS hi FROM l)
       SELECT CASE WHEN sold_price > hi THEN 'top' ELSE 'bottom' END AS tail, count(*) AS count,
              min(sold_price) AS cheapest, max(sold_price) AS dearest
       FROM l, q WHERE sold_price > hi OR sold_price < lo GROUP BY 1""",
)
def both_price_tails(t):
    rows = t.listings("sold_price")
    q = quantiles(rows, [0.25, 0.75])
    return (
        S.price_tails(rows, q[0.25], q[0.75])
        .groupBy("tail")
        .agg(F.count("*").alias("count"), F.min("sold_price").alias("cheapest"), F.max("sold_price").alias("dearest"))
    )


@query(
    "distinct_listings",
    "SET1",
    """WITH l AS {listings} SELECT DISTINCT id, parsing_date, sold_price, designer, condition FROM l""",
)
def distinct_listings(t):
    return W.drop_exact_duplicates(t.listings("id", "parsing_date", "sold_price", "designer", "condition"))


@query(
    "first_listings",
    "LIM1 SRC4 SET1",
    "WITH d AS {described} SELECT id, item_name, sold_price FROM d ORDER BY id LIMIT 100",
)
def first_listings(t):
    rows = W.drop_exact_duplicates(t.described("id", "item_name", "sold_price"))
    return W.take_exact(rows, 100, ["id"])


@query(
    "capped_scan",
    "SRC4",
    "SELECT event_type, value FROM events ORDER BY event_id LIMIT 1000",
)
def capped_scan(t):
    return W.head(t.table("events"), 1000, ["event_id"], ["event_type", "value"])


@query(
    "recent_predictions",
    "WIN4",
    """SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency
       FROM events QUALIFY recency <= 10""",
)
def recent_predictions(t):
    rows = t.table("events").select("user_id", "event_id", "value", "ts")
    return W.recent_predictions(rows, "user_id", "ts", "event_id").drop("ts")


@query(
    "stacked_datasets",
    "SET2 PRJ3",
    """SELECT o_orderkey, 'train' AS dataset FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'eval' FROM orders WHERE o_orderstatus <> 'F'""",
)
def stacked_datasets(t):
    rows = t.table("orders")
    return W.union_same(
        S.tag(rows.where("o_orderstatus = 'F'").select("o_orderkey"), "dataset", "train"),
        S.tag(rows.where("o_orderstatus <> 'F'").select("o_orderkey"), "dataset", "eval"),
    )


@query(
    "price_metrics",
    "AGG15",
    """SELECT o_orderstatus, round(sqrt(avg(pow(ln(1 + o_totalprice) - ln(1 + p), 2))), 7) AS rmsle,
              round(sum(abs(o_totalprice - p)) / sum(o_totalprice), 7) AS wape
       FROM (SELECT *, 1000.0::DOUBLE * (1 + o_custkey % 300) AS p FROM orders) GROUP BY 1""",
)
def price_metrics(t):
    rows = t.table("orders").withColumn("p", F.lit(1000.0) * (1 + F.col("o_custkey") % 300))
    out = A.evaluate(rows, "o_totalprice", "p", ["o_orderstatus"])
    return out.withColumns({"rmsle": F.round("rmsle", 7), "wape": F.round("wape", 7)})


@query(
    "median_baseline_metrics",
    "AGG16 ML7",
    """SELECT quantile_cont(o_totalprice, 0.5) AS median,
              round((SELECT sum(abs(o_totalprice - m)) / sum(o_totalprice) FROM orders), 7) AS wape
       FROM orders, (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM orders) GROUP BY m"""
    .replace("FROM orders), 7)", "FROM orders o2), 7)"),
)
def median_baseline_metrics(t):
    rows = t.table("orders").select("o_totalprice")
    predicted = A.median_baseline(rows, rows, "o_totalprice")
    return predicted.agg(
        F.max("prediction").alias("median"),
        F.round(F.sum(F.abs(F.col("o_totalprice") - F.col("prediction"))) / F.sum("o_totalprice"), 7).alias("wape"),
    )
