"""Encoder, split and nearest-neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import encoders as E
from pricewright.operators import splits as P
from pricewright.operators.knn import approximate_nearest, candidate_pairs, knn_predict, nearest, recall, suggested_bucket
from pricewright.operators.text_features import vector_cells
from pricewright.plans.registry import query
from pricewright.session import materialize
from pricewright.vocab import CONDITION_RANK, SIZE_CHARTS, TEXT_COLUMNS

_CHARTS = ", ".join("[" + ", ".join(f"'{s}'" for s in chart) + "]" for chart in SIZE_CHARTS)


@query(
    "sizes_fixed",
    "ENC1",
    """WITH l AS {listings}
       SELECT category, CASE WHEN category = 'PROMO' THEN 'ONE SIZE' ELSE size END AS size, count(*) AS count FROM l GROUP BY ALL""",
)
def sizes_fixed(t):
    rows = t.listings("category", "size")
    fixed = E.fixed_size(F.col("size"), F.col("category"), accessories="PROMO")
    return rows.select("category", fixed.alias("size")).groupBy("category", "size").agg(F.count("*").alias("count"))


@query(
    "sizes_normalized",
    "ENC2",
    f"""WITH charts AS (SELECT unnest([{_CHARTS}]) AS chart),
       places AS (SELECT unnest(chart) AS size, generate_subscripts(chart, 1) - 1 AS i, len(chart) AS n FROM charts),
       m AS (SELECT size, CASE WHEN i = n - 1 THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / (n - 1)) END AS place FROM places)
       SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '1.0' ELSE coalesce(CAST(place AS VARCHAR), 'None') END AS size
       FROM part LEFT JOIN m ON m.size = CAST(p_size AS VARCHAR)""",
)
def sizes_normalized(t):
    size = E.fixed_size(F.col("p_size").cast("string"), F.col("p_type"), normalize=True, accessories="PROMO")
    return t.table("part").select("p_partkey", size.alias("size"))


@query(
    "photos_standardized",
    "ENC3",
    """WITH l AS {listings}, s AS (SELECT avg(n_photos) AS m, stddev_pop(n_photos) AS d FROM l)
       SELECT n_photos, round((n_photos - m) / d, 9) AS n_photos_scaled, count(*) AS count FROM l, s GROUP BY ALL""",
)
def photos_standardized(t):
    scaled = E.standardize(t.listings("n_photos"), ["n_photos"])
    return scaled.groupBy("n_photos", F.round("n_photos_scaled", 9).alias("n_photos_scaled")).agg(F.count("*").alias("count"))


@query(
    "one_hot_codes",
    "ENC4",
    """WITH d AS {described} SELECT id,
         """ + ", ".join(
        f"CASE WHEN category = '{c}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"category={c}\""
        for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    ) + " FROM d",
)
def one_hot_codes(t):
    rows = t.described("id", "category")
    return rows.select("id", *E.one_hot("category", E.labels_of(rows, "category")))


@query(
    "one_hot_cells",
    "ENC4 ENC9",
    """WITH o AS (SELECT o_orderkey, 'c' || o_custkey AS customer, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders),
       c AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS place FROM (SELECT DISTINCT customer FROM o)),
       k AS (SELECT day, row_number() OVER (ORDER BY day) - 2 AS place FROM (SELECT DISTINCT day FROM o))
       SELECT o_orderkey, 'customer' AS part, CAST(place - 1 AS INTEGER) AS index FROM o JOIN c USING (customer) WHERE place > 0
       UNION ALL SELECT o_orderkey, 'day', CAST(place + (SELECT count(*) FROM c) - 1 AS INTEGER)
       FROM o JOIN k USING (day) WHERE place >= 0""",
)
def one_hot_cells(t):
    """Two columns of many labels in one sparse vector, the first label of each left out."""
    rows = t.table("orders").select("o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("customer"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    model = E.OneHot(drop="first").fit(rows, ["customer", "day"])
    cells = vector_cells(model.transform(rows, "v"), "o_orderkey", "v")
    customers = len(model.labels["customer"]) - 1
    return cells.select("o_orderkey", F.when(F.col("index") < customers, "customer").otherwise("day").alias("part"), "index")


@query(
    "condition_ranks",
    "ENC5",
    "WITH l AS {listings} SELECT condition, CASE condition "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONDITION_RANK.items() if k != "Used")
    + " ELSE -1 END AS rank, count(*) AS count FROM l GROUP BY ALL",
)
def condition_ranks(t):
    """One known condition is left out of the mapping to show the unknown code."""
    ranks = {k: v for k, v in CONDITION_RANK.items() if k != "Used"}
    rows = t.listings("condition").withColumn("rank", E.ordinal(F.col("condition"), ranks))
    return rows.groupBy("condition", "rank").agg(F.count("*").alias("count"))


_ENCODED = "designer color subcategory".split()


def _mean_sql(value: str) -> str:
    joins = " ".join(
        f"JOIN (SELECT {c}, {value} AS {c}_enc FROM l, p GROUP BY {c}, prior) e_{c} USING ({c})" for c in _ENCODED
    )
    outs = ", ".join(f"{c}, round({c}_enc, 7) AS {c}_enc" for c in _ENCODED)
    return f"""WITH l AS {{listings}}, p AS (SELECT sum(sold_price)::DOUBLE / count(*) AS prior FROM l)
       SELECT {outs}, count(*) AS count FROM l {joins} GROUP BY ALL"""


def _mean_query(t, encoder):
    rows = t.listings("sold_price", *_ENCODED)
    out = encoder.fit(rows, _ENCODED, "sold_price").transform(rows)
    keys = [c for name in _ENCODED for c in (F.col(name), F.round(f"{name}_enc", 7).alias(f"{name}_enc"))]
    return out.groupBy(*keys).agg(F.count("*").alias("count"))


@query(
    "target_mean_codes",
    "ENC6 JOI1",
    _mean_sql("prior * (1 - 1 / (1 + exp(-(count(*) - 20) / 10.0))) + avg(sold_price) * (1 / (1 + exp(-(count(*) - 20) / 10.0)))"),
)
def target_mean_codes(t):
    return _mean_query(t, E.TargetMean())


@query("prior_mean_codes", "ENC7 JOI1", _mean_sql("(sum(sold_price) + 5 * prior) / (count(*) + 5)"))
def prior_mean_codes(t):
    return _mean_query(t, E.PriorMean(a=5))


@query(
    "unseen_category_codes",
    "JOI1 ENC6",
    """WITH tr AS (SELECT o_orderpriority AS c, round(o_totalprice)::BIGINT AS y FROM orders WHERE o_orderpriority < '3'),
       p AS (SELECT sum(y)::DOUBLE / count(*) AS prior FROM tr),
       e AS (SELECT c, (sum(y) + prior) / (count(*) + 1) AS v FROM tr, p GROUP BY c, prior)
       SELECT o_orderkey, round(coalesce(v, prior), 6) AS o_orderpriority_enc
       FROM orders LEFT JOIN e ON c = o_orderpriority, p""",
)
def unseen_category_codes(t):
    rows = t.table("orders").select("o_orderkey", "o_orderpriority", F.round("o_totalprice").cast("long").alias("y"))
    model = E.PriorMean().fit(rows.where("o_orderpriority < '3'"), ["o_orderpriority"], "y")
    out = model.transform(rows.select("o_orderkey", "o_orderpriority"))
    return out.select("o_orderkey", F.round("o_orderpriority_enc", 6).alias("o_orderpriority_enc"))


@query(
    "ordered_prior_codes",
    "ENC8",
    """WITH o AS (SELECT o_orderkey, o_orderpriority, round(o_totalprice)::BIGINT AS y FROM orders),
       p AS (SELECT sum(y)::DOUBLE / count(*) AS prior FROM o)
       SELECT o_orderkey, round((coalesce(sum(y) OVER w, 0) + prior) / (count(*) OVER w + 1), 6) AS o_orderpriority_enc
       FROM o, p WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def ordered_prior_codes(t):
    """Slices of a few thousand rows show the large-table path on the small scales."""
    rows = t.table("orders").select("o_orderkey", "o_orderpriority", F.round("o_totalprice").cast("long").alias("y"))
    out = E.ordered_prior_mean(rows, "o_orderpriority", "y", ["o_orderkey"], rows_per_slice=5000)
    return out.select("o_orderkey", F.round("o_orderpriority_enc", 6).alias("o_orderpriority_enc"))


@query(
    "unencoded_features",
    "ENC10 ENC1",
    """WITH d AS {described} SELECT n_photos, condition, department, category, color, designer, subcategory,
         CASE WHEN category = 'accessories' THEN 'ONE SIZE' ELSE size END AS size FROM d""",
)
def unencoded_features(t):
    columns = ["n_photos", "condition", "department", "category", "color", "designer", "subcategory", "size"]
    return E.FeaturePlan(no_encoding=True).passthrough(t.described(*columns))


_PLAN_COLUMNS = ("n_photos", "condition", "department", "category", "color", "designer", "subcategory", "size")


def _plan_sql() -> str:
    means = ("color", "designer", "size", "subcategory")
    value = ("prior * (1 - 1 / (1 + exp(-(count(*) - 20) / 10.0))) "
             "+ avg(sold_price) * (1 / (1 + exp(-(count(*) - 20) / 10.0)))")
    joins = " ".join(f"JOIN (SELECT {c}, {value} AS {c}_enc FROM d, s GROUP BY {c}, prior) e_{c} USING ({c})" for c in means)
    hot = [("department", v) for v in ("menswear", "womenswear")]
    hot += [("category", v) for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
    ones = ", ".join(f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS {c}_{v}" for c, v in hot)
    rank = "CASE condition " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONDITION_RANK.items()) + " END::DOUBLE AS condition_rank"
    outs = ", ".join(f"round({c}_enc, 7) AS {c}_enc" for c in means)
    return f"""WITH d AS {{described}},
       s AS (SELECT avg(n_photos) AS m, stddev_pop(n_photos) AS sd, sum(sold_price)::DOUBLE / count(*) AS prior FROM d)
       SELECT id, round((n_photos - m) / sd, 7) AS n_photos_scaled, {ones}, {rank}, {outs} FROM d {joins}, s"""


@query("planned_features", "ENC9 ENC3 ENC4 ENC5 ENC6", _plan_sql())
def planned_features(t):
    """Every feature of the default plan, by name."""
    rows = t.described("id", *_PLAN_COLUMNS, "sold_price")
    model = E.FeaturePlan().fit(rows, "sold_price")
    wide = model.encoded(rows, ["id"])
    return wide.select("id", *[F.round(f"`{n}`", 7).alias(n.replace("=", "_")) for n in model.names()])


@query("feature_vectors", "ENC9 ENC11")
def feature_vectors(t):
    rows = t.described("id", *_PLAN_COLUMNS, "sold_price")
    model = E.FeaturePlan().fit(rows, "sold_price")
    out = E.assemble(model.transform(rows), ["tab_features", "sold_price"])
    from pyspark.ml.functions import vector_to_array

    return out.select("id", vector_to_array("features").alias("features"))


_SHARE = "('0x' || substr(md5(o_orderkey || '#42'), 1, 8))::BIGINT / 4294967296.0"


@query(
    "hash_split",
    "ML1",
    f"""SELECT o_orderkey, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'eval' ELSE 'test' END AS part
       FROM (SELECT o_orderkey, {_SHARE} AS u FROM orders)""",
)
def hash_split(t):
    return t.table("orders").select("o_orderkey", P.split_label(F.col("o_orderkey"), (0.6, 0.2, 0.2)).alias("part"))


@query(
    "exact_split",
    "ML1",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5(o_orderkey || '#42'), 1, 13)) - 1 AS i,
                  count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, CASE WHEN i < floor(n * 0.6::DOUBLE) THEN 'train'
              WHEN i < floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'eval' ELSE 'test' END AS part FROM r""",
)
def exact_split(t):
    parts = P.split_exact(t.table("orders").select("o_orderkey"), "o_orderkey", exact_rows=5000)
    tagged = [p.withColumn("part", F.lit(name)) for name, p in zip(P.PARTS, parts)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "prepared_datasets",
    "ML2 SET1 STR-2 PRJ3",
    """WITH d AS {described},
       c AS (SELECT id, feature, coalesce(nullif(array_to_string({alnum_tokens}, ' '), ''), 'missing') AS cleaned FROM (
               SELECT id, 'item_name' AS feature, item_name AS txt FROM d UNION ALL SELECT id, 'description', description FROM d
               UNION ALL SELECT id, 'hashtags', hashtags FROM d)),
       w AS (SELECT id, max(cleaned) FILTER (WHERE feature = 'item_name') AS item_name,
                    max(cleaned) FILTER (WHERE feature = 'description') AS description,
                    max(cleaned) FILTER (WHERE feature = 'hashtags') AS hashtags FROM c GROUP BY 1)
       SELECT id, sold_price, md5(w.item_name || '|' || w.description || '|' || w.hashtags) AS text_md5,
              CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'eval' ELSE 'test' END AS dataset
       FROM (SELECT id, sold_price, ('0x' || substr(md5(id || '#42'), 1, 8))::BIGINT / 4294967296.0 AS u FROM d) JOIN w USING (id)""",
)
def prepared_datasets(t):
    rows, _ = P.write_datasets(t.described("id", "sold_price", *TEXT_COLUMNS), None)
    return rows.select("id", "sold_price", F.md5(F.concat_ws("|", *TEXT_COLUMNS)).alias("text_md5"), F.col("part").alias("dataset"))


@query(
    "first_prepared_datasets",
    "ML2 LIM1 SET1",
    f"""WITH d AS (SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 1000),
       p AS (SELECT *, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'eval' ELSE 'test' END AS part
             FROM (SELECT *, {_SHARE} AS u FROM d))
       SELECT o_orderkey, o_orderpriority, part, count(*) OVER (PARTITION BY part) AS part_rows FROM p""",
)
def first_prepared_datasets(t):
    """The first thousand orders, repeated rows dropped, with the sizes observed while the parts were written."""
    orders = t.table("orders").select("o_orderkey", "o_orderpriority")
    rows, sizes = P.write_datasets(orders.unionByName(orders), 1000, "o_orderkey", ())
    counted = F.coalesce(*[F.when(F.col("part") == p, n) for p, n in sizes.items()])
    return rows.withColumn("part_rows", counted.cast("long"))


_PAIRS_SQL = """n AS (SELECT q.vec_id AS query_id, t.vec_id, t.label,
              sqrt(list_sum(list_transform(range(1, 65),
                   lambda i: pow(q.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE, 2)))) AS distance
           FROM embeddings q, embeddings t WHERE q.vec_id % 5 = 0 AND t.vec_id % 5 <> 0
           QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY distance, t.vec_id) <= 5)"""


def _vectors(t):
    v = t.vectors()
    return (
        v.where("vec_id % 5 <> 0").select("vec_id", "label", F.col("embedding").alias("vector")),
        v.where("vec_id % 5 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")),
    )


@query(
    "nearest_vectors",
    "JOI7",
    f"WITH {_PAIRS_SQL} SELECT query_id, vec_id, round(distance, 9) AS distance FROM n",
)
def nearest_vectors(t):
    train, asked = _vectors(t)
    found = nearest(train, asked, 5, train_key="vec_id", block=100)
    return found.select("query_id", "vec_id", F.round("distance", 9).alias("distance"))


@query(
    "approximate_neighbours",
    "JOI7",
    f"""WITH {_PAIRS_SQL} SELECT count(*) AS wanted, true AS recall_reached, true AS fewer_pairs, round(max(distance), 9) AS farthest FROM n""",
)
def approximate_neighbours(t):
    """Random projections against the exact neighbours: recall of 0.9 at least, from fewer than all pairs."""
    train, asked = _vectors(t)
    exact = materialize(nearest(train, asked, 5, train_key="vec_id", block=100), "exact-neighbours")
    found = approximate_nearest(train, asked, 5, train_key="vec_id")
    bucket = suggested_bucket(train, 5, "vec_id")
    compared = candidate_pairs(train, asked, "vec_id", "query_id", "vector", bucket, 8, counted=True).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("compared"))
    every = train.agg(F.count("*").alias("rows")).crossJoin(asked.agg(F.count("*").alias("asked")))  # one row each
    measured = recall(found, exact, "query_id", "vec_id").crossJoin(compared).crossJoin(every)
    farthest = exact.agg(F.round(F.max("distance"), 9).alias("farthest"))
    return measured.crossJoin(farthest).select(
        "wanted", (F.col("recall") >= 0.9).alias("recall_reached"), (F.col("compared") < F.col("rows") * F.col("asked")).alias("fewer_pairs"), "farthest"
    )


@query(
    "knn_labels",
    "ML6 JOI7",
    f"WITH {_PAIRS_SQL} SELECT query_id, sum(label)::DOUBLE / count(*) AS prediction FROM n GROUP BY 1",
)
def knn_labels(t):
    train, asked = _vectors(t)
    return knn_predict(train, asked, "label", 5, train_key="vec_id")
