import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricewright.operators import encoders as E
from pricewright.operators import knn as KNN
from pricewright.operators import lookup as LOOKUP
from pricewright.operators import text_features as TF
from pricewright.operators.knn import knn_predict, nearest
from pricewright.operators.text_plan import TextPlan
from pricewright.plans.text import document_ngrams
from pricewright.plans.views import Tables
from pricewright.vocab import SIZE_CHARTS, size_positions


def width(df, column):
    return len(df.select(vector_to_array(column).alias("v")).first()["v"])


def test_default_plan_width(sample):
    model = E.FeaturePlan().fit(sample, "sold_price")
    assert width(model.transform(sample), "tab_features") == 1 + 7 + 1 + 4
    assert len(model.names()) == 13
    assert model.transform(sample).where("category = 'accessories'").first()["size"] == "L"


@pytest.mark.parametrize("kind", ["ohe", "oe", "catboost", "te"])
def test_size_goes_to_the_named_encoder(sample, kind):
    plan = E.FeaturePlan(**{f"{kind}_cols": ["size"]})
    assert plan.size_encoder() == kind
    plan.fit(sample, "sold_price").transform(sample).collect()


def test_plan_leaves_caller_lists_alone():
    mine = ["designer", "size"]
    E.FeaturePlan(catboost_cols=mine)
    assert mine == ["designer", "size"]


def test_scaler_without_centering(spark, sample):
    row = E.standardize(sample, ["n_photos"], with_mean=False).orderBy("n_photos").first()
    assert row["n_photos_scaled"] == pytest.approx(1 / np.std([1, 2, 3, 4, 5]))


def test_normalized_sizes(spark):
    sizes = [s for chart in SIZE_CHARTS for s in chart]
    assert len(sizes) == len(set(sizes)) == len(size_positions())
    rows = spark.createDataFrame([(s, "tops") for s in [*sizes, "10.5"]] + [("M", "accessories")], "size string, category string")
    got = {(r[0], r[1]): r[2] for r in rows.select("size", "category", E.fixed_size(F.col("size"), F.col("category"), True)).collect()}
    for chart in SIZE_CHARTS:
        for s, place in zip(chart, np.linspace(0, 1, len(chart))):
            assert got[(s, "tops")] == str(float(place))
    assert got[("10.5", "tops")] == "None"
    assert got[("M", "accessories")] == "1.0"


def test_mean_encoders(spark):
    rows = [("a", 10)] * 30 + [("b", 40)] * 2
    df = spark.createDataFrame(rows, "c string, y int")
    prior = (300 + 80) / 32
    asked = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    by = {r["c"]: r["c_enc"] for r in E.TargetMean().fit(df, ["c"], "y").transform(asked).collect()}
    w = 1 / (1 + math.exp(-(30 - 20) / 10))
    assert by["a"] == pytest.approx(prior * (1 - w) + 10 * w)
    assert by["z"] == by[None] == pytest.approx(prior)
    by = {r["c"]: r["c_enc"] for r in E.PriorMean(a=5).fit(df, ["c"], "y").transform(asked).collect()}
    assert by["b"] == pytest.approx((80 + 5 * prior) / 7)


def test_ordered_prior_mean_does_not_leak(spark):
    df = spark.range(400).select("id", F.lit("hot").alias("c"), (F.col("id") % 7).cast("int").alias("y"))
    prior = sum(i % 7 for i in range(400)) / 400
    for slices in (50, 10_000):
        got = E.ordered_prior_mean(df, "c", "y", ["id"], rows_per_slice=slices).collect()
        for r in got:
            before = [i % 7 for i in range(r["id"])]
            assert r["c_enc"] == pytest.approx((sum(before) + prior) / (len(before) + 1))


def test_vocabulary_and_vectors(spark):
    texts = ["red red shirt", "blue shirt x", "", "red hat blue hat"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["term"]: (r["tf"], r["df"]) for r in TF.vocabulary(df, "text", (1, 2)).collect()}
    grams = []
    for t in texts:
        tokens = [w for w in t.split() if len(w) > 1]
        grams.append(tokens + [" ".join(p) for p in zip(tokens, tokens[1:])])
    tf, dfreq = Counter(g for x in grams for g in x), Counter(g for x in grams for g in set(x))
    assert got == {g: (tf[g], dfreq[g]) for g in tf}
    model = TF.BagOfWords(ngram_range=(1, 2), max_features=3).fit(df, "text")
    terms = [r["term"] for r in model.terms.orderBy("index").collect()]
    assert terms == sorted(sorted(tf, key=lambda g: (-tf[g], g))[:3])
    cells = {(r["id"], r["term"]): r["value"] for r in TF.vector_cells(model.transform(df, "v"), "id", "v", model).collect()}
    assert cells == {(i, g): n for i, x in enumerate(grams) for g, n in Counter(x).items() if g in terms}


def test_one_hot_of_many_labels(spark):
    rows = [(i, f"v{i:06d}", "abc"[i % 3]) for i in range(100_000)] + [(-1, None, "a"), (-2, "v000007", None)]
    df = spark.createDataFrame(rows, "id int, many string, few string").repartition(8)
    model = E.OneHot().fit(df, ["many", "few"])
    assert len(model.names()) == 100_003
    out = model.transform(df, "v").select("id", F.unwrap_udt(F.col("v")).alias("v")).where("id in (-2, -1, 5, 99999)")
    got = {r["id"]: (r["v"]["size"], r["v"]["indices"], r["v"]["values"]) for r in out.collect()}
    assert got == {-1: (100_003, [100_000], [1.0]), -2: (100_003, [7], [1.0]), 5: (100_003, [5, 100_002], [1.0, 1.0]), 99_999: (100_003, [99_999, 100_000], [1.0, 1.0])}


def test_one_hot_labels_stay_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(E, "labels_of", lambda *a: pytest.fail("labels were collected"))
    df = spark.range(30_000).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("many"), F.when(F.col("id") > 0, "x").alias("few"))
    out = E.OneHot(drop="first").fit(df, ["many", "few"]).transform(df, "v")
    # neither the plan nor the metadata names the labels
    assert len(out.schema["v"].json()) < 1000 and "StringIndexer" not in out._jdf.queryExecution().toString()
    got = {r["id"]: list(r["v"].indices) for r in out.where("id in (0, 1, 29999)").collect()}
    assert got == {0: [], 1: [0], 29_999: [29_998]} and out.first()["v"].size == 29_999
    monkeypatch.setattr(E, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(LOOKUP, "BROADCAST_ROWS", 100)
    joined = E.OneHot(drop="first").fit(df, ["many", "few"]).transform(df, "v")
    assert "strategy=merge" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: list(r["v"].indices) for r in joined.where("id in (0, 1, 29999)").collect()} == got
    strict = E.OneHot("error").fit(df, ["many"]).transform(df.withColumn("many", F.lit("other")), "v")
    with pytest.raises(Exception, match="unseen value in many: other"):
        strict.collect()


def test_encoder_settings(spark, sample):
    plan = E.FeaturePlan(ohe_params={"drop": "first"}, oe_cols=["condition", "color"], oe_params={"handle_unknown": "return_nan"})
    model = plan.fit(sample, "sold_price")
    wide = model.encoded(sample, ["id"])
    vectors = {r["id"]: list(r["a"]) for r in model.transform(sample).select("id", vector_to_array("tab_features").alias("a")).collect()}
    names = wide.columns[1:]
    assert names == model.names() and {r["id"]: [r[n] for n in names] for r in wide.collect()} == vectors
    assert "department=menswear" not in names and "department=womenswear" in names
    unseen = sample.withColumn("color", F.lit("mauve"))
    assert all(math.isnan(r["color_rank"]) for r in model.encoded(unseen, ["id"]).collect())
    with pytest.raises(Exception, match="mauve"):
        E.FeaturePlan(oe_cols=["color"], oe_params={"handle_unknown": "error"}).fit(sample, "sold_price").transform(unseen).collect()
    with pytest.raises(Exception, match="(?i)unseen|invalid"):
        E.OneHot("error").fit(sample, ["color"]).transform(unseen, "v").collect()
    with pytest.raises(ValueError, match="one-hot settings"):
        E.FeaturePlan(ohe_params={"handle_unknown": "x"})
    with pytest.raises(ValueError, match="ordinal settings"):
        E.FeaturePlan(oe_params={"x": 1})


def test_vocabulary_past_the_old_limit(spark, monkeypatch):
    rows = [(i, " ".join(f"t{i * 20 + k:07d}" for k in range(20)) + " common common") for i in range(15_000)]
    rows += [(-1, None), (-2, ""), (-3, rows[5][1]), (-4, "x " * 200 + "L" * 500)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(8)
    monkeypatch.setattr(TF, "HOT_TERMS", 100)
    model = TF.BagOfWords("tfidf").fit(df, "text")
    assert model.size == 15_000 * 20 + 2 > 1 << 18
    out = model.transform(df, "v").withColumn("raw", F.unwrap_udt(F.col("v")))
    got = {r["id"]: (r["raw"]["size"], r["raw"]["indices"], r["raw"]["values"]) for r in out.where("id < 2").select("id", "raw").collect()}
    assert got[-1] == got[-2] == (model.size, [], [])
    n = len(rows)
    rare, often = math.log((1 + n) / 2) + 1, math.log((1 + n) / (1 + 15_001)) + 1
    assert got[0][1] == [0, *range(2, 22)]  # the long term of the last row comes second
    norm = math.sqrt(20 * rare**2 + 4 * often**2)
    assert got[0][2] == pytest.approx([2 * often / norm] + [rare / norm] * 20)
    assert out.count() == len(rows) and out.where("size(raw.indices) = 21").count() == 15_001


def test_tfidf_forms_agree(spark):
    texts = ["aa bb aa cc", "bb cc dd", "aa", "dd dd ee", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    model = TF.BagOfWords("tfidf").fit(df, "text")
    vector = {(r["id"], r["term"]): r["value"] for r in TF.vector_cells(model.transform(df, "v"), "id", "v", model).collect()}
    long = {(r["id"], r["term"]): r["weight"] for r in TF.tfidf_long(df, "id", "text").collect()}
    assert vector.keys() == long.keys()
    for key in long:
        assert vector[key] == pytest.approx(long[key])
    idf = {w: math.log(6 / (1 + n)) + 1 for w, n in {"bb": 2, "cc": 2, "dd": 2}.items()}
    assert long[(1, "bb")] == pytest.approx(idf["bb"] / math.sqrt(sum(x * x for x in idf.values())))


def test_ngrams_are_counted_after_their_shuffle(spark, tmp_path):
    texts = ["red red shirt", "blue shirt blue shirt", None, "red hat blue hat", ""]
    df = spark.createDataFrame([(i, x, float(i)) for i, x in enumerate(texts)], "doc_id long, text string, sold_price double")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    counted = document_ngrams(Tables(spark, str(tmp_path)))
    forms = (counted, TF.vocabulary(df, "text", (1, 2)), TF.ngram_counts(df, ["text"], 1.0, 2.0))
    for out in forms:
        below = out._jdf.queryExecution().sparkPlan().toString().split("REPARTITION_BY_COL")
        assert len(below) == 2 and "Aggregate" not in below[1]
    grams = Counter()
    for words in (x.split() for x in texts if x):
        grams.update((n, " ".join(words[i : i + n])) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    assert {(r["ngram"], r["value"]): r["count"] for r in counted.collect()} == grams


def test_short_vocabularies_are_looked_up_beside_the_row(spark):
    texts = ["aa bb aa cc", "Bb cc dd", None, "", "dd dd ee", "aa bb aa cc", "zz x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    for kind, size in (("count", (1, 1)), ("tfidf", (1, 3)), ("tfidf", (2, 2))):
        model = TF.BagOfWords(kind, size, min_df=2).fit(df, "text")
        out = model.transform(df, "v")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        got, joined = ({r["id"]: r["v"] for r in rows.collect()} for rows in (out, model._joined(df, "v")))
        assert len(got) == len(texts) and got == joined
        assert all(list(got[i].indices) == list(joined[i].indices) and list(got[i].values) == list(joined[i].values) for i in got)
        assert got[2].size == model.size and not len(got[2].indices) and len(got[0].indices) > 0


def test_subspace_iteration_matches_dense_decomposition(spark, monkeypatch):
    rng = np.random.default_rng(0)
    strength = np.array([9.0, 6.0, 4.0, 2.0] + [0.3] * 36)
    data = rng.standard_normal((300, 40)) * strength + 1.0
    data[rng.random(data.shape) < 0.3] = 0
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(x) for x in r[np.flatnonzero(r)]]) for i, r in enumerate(data)]
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, Vectors.sparse(40, j, x)) for i, j, x in rows], ["id", "v"]).repartition(5)
    centred = data - data.mean(axis=0)
    expected = np.linalg.svd(centred, full_matrices=False)[2][:3].T
    for limit in (10, 1000):
        monkeypatch.setattr(TF, "DENSE_COVARIANCE", limit)
        monkeypatch.setattr(TF, "BLOCK_ROWS", 16)
        model = TF.Reduce(3).fit(df, "v")
        overlap = np.abs(np.sum(model.components * expected, axis=0))
        assert overlap == pytest.approx(np.ones(3), abs=1e-3)
        got = np.array([r["a"] for r in model.transform(df, "v", "pc").orderBy("id").select(vector_to_array("pc").alias("a")).collect()])
        assert got == pytest.approx(centred @ model.components, abs=1e-8)


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, 5 * 3 + 2),
        ({"use_embeddings": False, "use_sentiment": False, "use_missing_hashtags": False}, 3 * 3),
        ({"use_stats": False, "use_sentiment": False, "use_missing_hashtags": False}, 2 * 3),
        ({"use_stats": False, "use_embeddings": False, "use_missing_hashtags": False}, 1),
        ({"use_stats": False, "use_embeddings": False, "use_sentiment": False}, 1),
        ({"text_cols": ["description"], "use_sentiment": False, "use_missing_hashtags": False}, 5),
        ({"vectorizer_class": "tfidf"}, 5 * 3 + 2),
    ],
)
def test_text_plan_width(sample, options, expected):
    plan = TextPlan(**{"reducer_params": {"n_components": 2}, **options})
    assert width(plan.fit(sample).transform(sample), "text_features") == expected


def test_text_plan_rejects_unknown_parts():
    with pytest.raises(ValueError, match="no vectorizer 'invalid'"):
        TextPlan(vectorizer_class="invalid")
    with pytest.raises(ValueError, match="no reducer 'invalid'"):
        TextPlan(reducer_class="invalid")


def test_sentiment(spark):
    def score(text):
        return spark.range(1).select(TF.sentiment(F.lit(text).cast("string"), {"good": 2.0, "bad": -2.0}).alias("s")).first()["s"]

    def compound(x):
        return x / math.sqrt(x * x + 15)

    assert score("missing") == score(None) == score("plain words") == 0.0
    assert score("a good shirt") == pytest.approx(compound(2.0))
    assert score("not a good shirt") == pytest.approx(compound(-0.74 * 2.0))
    assert score("not one two three good") == pytest.approx(compound(2.0))
    assert score("very good, very bad") == pytest.approx(compound(2.293 - 2.293 + 0.95 * 0 - 0.9 * 0.293), abs=1e-9)


@pytest.mark.parametrize("block", [7, 4096])
def test_nearest_matches_brute_force(spark, block):
    """A third of the training rows are copies of one vector."""
    rng = np.random.default_rng(5)
    points = np.round(rng.standard_normal((240, 6)), 3)
    points[::3] = points[0]
    asked = np.vstack([np.round(rng.standard_normal((30, 6)), 3), points[:1], points[:1] + 50])
    train = spark.createDataFrame([(i, p.tolist(), float(i)) for i, p in enumerate(points)], "id int, vector array<double>, y double")
    query = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(asked)], "query_id int, vector array<double>")
    got = {}
    for r in nearest(train.repartition(4), query.repartition(3), 4, block=block).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["id"]))
    expected = {}
    for i, q in enumerate(asked):
        gap = points - q
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        expected[i] = sorted(zip(d.tolist(), range(len(points))))[:4]
    assert {q: [t for _, t in sorted(v)] for q, v in got.items()} == {q: [t for _, t in v] for q, v in expected.items()}
    predicted = {r["query_id"]: r["prediction"] for r in knn_predict(train, query, "y", 4, block=block).collect()}
    assert predicted == pytest.approx({q: np.mean([t for _, t in v]) for q, v in expected.items()})


@pytest.mark.parametrize("rows", [16, 8192])
def test_nearest_compares_slices_that_no_cell_prunes(spark, monkeypatch, rows):
    """Rows go to tasks by slices, however small the block of one product is; great and tiny values keep their order."""
    monkeypatch.setattr(KNN, "SLICE_ROWS", rows)
    rng = np.random.default_rng(8)
    points = rng.standard_normal((300, 8))
    points[:3] *= 1e100
    points[3:9] = points[3] + np.arange(6)[:, None] * 1e-9
    train = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, vector array<double>")
    query = train.where("id < 40").withColumnRenamed("id", "query_id")
    sent = []
    compare = KNN._Slices.compare
    monkeypatch.setattr(KNN._Slices, "compare", lambda self, listed, *rest: sent.append((self.number, listed.count())) or compare(self, listed, *rest))
    got = {}
    for r in nearest(train, query, 5, block=2).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    for i, q in enumerate(points[:40]):
        d = np.sqrt(((points - q) ** 2).sum(1))
        assert got[i] == sorted(range(300), key=lambda t: (d[t], t))[:5]
    assert sent[0][0] <= 2 * (300 // rows + 1) + 8 and sent[0][1] <= 40 * sent[0][0]
    pairs = [KNN.candidate_pairs(train, query, "id", "query_id", "vector", 1.0, 4, counted=c) for c in (False, True)]
    assert pairs[0].count() == pairs[0].distinct().count() == pairs[1].agg(F.sum("pairs")).first()[0]
    twice = KNN.candidate_pairs(train.unionByName(train), query.unionByName(query), "id", "query_id", "vector", 1.0, 4)
    assert twice.count() == pairs[0].count()


def test_nearest_with_fewer_rows_than_k(spark):
    train = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id int, vector array<double>")
    query = spark.createDataFrame([(9, [0.2])], "query_id int, vector array<double>")
    assert [r["id"] for r in nearest(train, query, 5).orderBy("rank").collect()] == [1, 2]


def test_approximate_neighbours_of_clusters(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 16)) * 10
    points = centres[rng.integers(0, 60, 3000)] + rng.standard_normal((3000, 16)) * 0.3
    points = np.vstack((points, np.full((1, 16), 500.0)))  # far from all: fewer than k rows in its buckets
    train = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id int, vector array<double>")
    asked = train.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    bucket = KNN.suggested_bucket(train, 5)
    assert 0.2 < bucket < 1
    exact, found = nearest(train, asked, 5), KNN.approximate_nearest(train, asked, 5)
    measured = KNN.recall(found, exact, "query_id", "id").first()
    assert measured["wanted"] == 5 * asked.count() and measured["recall"] >= 0.9
    assert found.groupBy("query_id").count().where("count <> 5").isEmpty()
    assert found.where("query_id = 3000").count() == 5
    compared = KNN.candidate_pairs(train, asked, "id", "query_id", "vector", bucket, 8).count()
    assert compared < 0.2 * 3001 * asked.count()
    wrong = found.join(train.withColumnRenamed("vector", "v"), "id").join(asked, "query_id")
    gap = F.sqrt(F.aggregate(F.zip_with("v", "vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y))
    assert wrong.where(F.abs(gap - F.col("distance")) > 1e-9).isEmpty()


def test_encoders_without_values(spark):
    empty = spark.createDataFrame([], "id int, c string, y double, x double")
    assert E.ordered_prior_mean(empty, "c", "y", ["id"]).count() == 0
    assert E.standard_parameters(empty, ["x"]) == {"x": (0.0, 1.0)}
    null = spark.createDataFrame([(1, "a", None, None), (2, "a", None, None)], empty.schema)
    assert all(math.isnan(r["c_enc"]) for r in E.ordered_prior_mean(null, "c", "y", ["id"]).collect())
    assert E.standardize(null, ["x"]).where("x_scaled is not null").isEmpty()
