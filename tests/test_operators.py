import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.operators import aggregates as A
from pricewright.operators import reshape as R
from pricewright.operators import windows as W
from pricewright.operators.quantiles import order_statistics, quantiles


@pytest.mark.parametrize("exact_rows", [10, 200, 10_000])
def test_quantiles_by_narrowing(spark, exact_rows):
    """A third of the rows share one value and the tail is long."""
    rng = random.Random(1)
    values = [42.0] * 1000 + [rng.random() * 10 for _ in range(1000)] + [10 ** rng.uniform(0, 6) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "sold_price double").repartition(4)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantiles(df, qs, exact_rows=exact_rows)
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


@pytest.mark.parametrize("exact_rows", [5, 10_000])
def test_quantiles_with_infinite_values_and_nan(spark, exact_rows):
    inf, nan = float("inf"), float("nan")
    values = [-inf] * 3 + [float(i) for i in range(14)] + [inf] * 2 + [nan] * 2 + [None]
    df = spark.createDataFrame([(v,) for v in values], "sold_price double").repartition(3)
    got = quantiles(df, [0.0, 0.25, 0.5, 0.9, 1.0], exact_rows=exact_rows)
    assert [got[q] for q in (0.0, 0.25, 0.5, 0.9)] == [-inf, 2.0, 7.0, inf] and math.isnan(got[1.0])


def test_quantiles_of_nothing_and_of_absent_column(spark):
    empty = spark.createDataFrame([], "sold_price int")
    assert quantiles(empty, [0.5]) == {0.5: None}
    with pytest.raises(KeyError):
        quantiles(empty, [0.5], "price")


def test_order_statistics_of_two_hot_values(spark):
    df = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 500 + [(1.5,)], "v double")
    got = order_statistics(df, [499, 500, 501, 1000], exact_rows=5)
    assert [got[r] for r in (499, 500, 501, 1000)] == [1.0, 1.5, 2.0, 2.0]


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_is_the_same_for_any_slicing(spark, inclusive):
    rng = random.Random(3)
    groups = ["hot"] * 6 + ["a", "b", None]
    rows = [(i, rng.choice(groups), rng.randint(0, 40), rng.choice([None, *range(100)])) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, g string, at int, x int").repartition(5)
    values = {"s": ("sum", F.col("x")), "n": ("count", F.col("x")), "lo": ("min", F.col("x")), "hi": ("max", F.col("x"))}
    plain = W.running(df, ["g"], ["at", "k"], values, inclusive)
    sliced = W.running(df, ["g"], ["at", "k"], values, inclusive, rows_per_slice=100)
    assert sorted(map(tuple, plain.select(sorted(plain.columns)).collect()), key=str) == sorted(
        map(tuple, sliced.select(sorted(plain.columns)).collect()), key=str
    )
    one = sorted((r for r in rows if r[1] == "hot"), key=lambda r: (r[2], r[0]))
    seen, expected = [], {}
    for r in one:
        upto = seen + [r] if inclusive else seen
        known = [x[3] for x in upto if x[3] is not None]
        expected[r[0]] = (sum(known) if known else None, len(known))
        seen.append(r)
    got = {r["k"]: (r["s"], r["n"]) for r in sliced.where("g = 'hot'").collect()}
    assert got == expected


def test_running_with_a_hot_leading_value(spark):
    """Half of the hot group shares one date: slices are cut along all order columns."""
    rows = [(i, "hot" if i % 3 else "b", 7 if i % 2 else i % 50, 1) for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, g string, at int, x int").repartition(5)
    got = W.running(df, ["g"], ["at", "k"], {"n": ("sum", F.col("x"))}, rows_per_slice=60)
    for group in ("hot", "b"):
        ordered = got.where(F.col("g") == group).orderBy("at", "k").collect()
        assert [r["n"] for r in ordered] == list(range(1, len(ordered) + 1))


def test_running_over_text_order(spark):
    df = spark.range(300).select(F.format_string("%05d", "id").alias("k"), F.lit("g").alias("g"))
    got = W.running(df, ["g"], ["k"], {"n": ("count", F.lit(1))}, rows_per_slice=50).orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, 301))


def test_top_k_breaks_ties_by_key(spark):
    groups = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "f string, count int")
    assert [r["f"] for r in W.top_k(groups, "f", 3).orderBy("rank").collect()] == ["c", "a", "b"]


def test_take_exact_refuses_short_tables(spark):
    assert W.take_exact(spark.range(10), 4, ["id"]).count() == 4
    with pytest.raises(ValueError):
        W.take_exact(spark.range(3), 4, ["id"])


@pytest.mark.parametrize("low, high, bins, step", [(0, 100, 20, 5), (1, 99999, 400, 500), (-1, 1, 20, 0.1), (3, 3, 10, 1)])
def test_nice_step(low, high, bins, step):
    assert A.nice_step(low, high, bins) == pytest.approx(step)


def test_nest_columns(spark):
    flat = spark.range(1).select(*[F.lit(i).alias(n) for i, n in enumerate(["a", "b.c.d", "b.c.e", "b.f"])])
    row = R.nest_columns(flat).first()
    assert row.asDict(recursive=True) == {"a": 0, "b": {"c": {"d": 1, "e": 2}, "f": 3}}
    with pytest.raises(ValueError):
        R.nest_columns(flat.withColumnRenamed("a", "b"))
    with pytest.raises(ValueError):
        R.nest_columns(flat.withColumnRenamed("a", "b.c"))


def test_nest_config():
    run = {"encoder.size.kind": "ordinal", "seed": 7, "encoder.size.offset": 1, "encoder.colour": None, "split": [0.6, 0.2]}
    assert R.nest_config(run) == {"encoder": {"size": {"kind": "ordinal", "offset": 1}, "colour": None}, "seed": 7, "split": [0.6, 0.2]}
    assert R.nest_config({}) == {}
    for one, two in (("encoder", "encoder.size"), ("encoder.size", "encoder.size.kind"), ("x.y.z", "x")):
        for names in ((one, two), (two, one)):
            with pytest.raises(ValueError, match="both a value and a group"):
                R.nest_config(dict.fromkeys(names, 1))


def test_explode_list_keeps_empty_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, v array<string>")
    assert sorted(map(tuple, R.explode_list(df, "v").collect()), key=str) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_evaluate_matches_numpy_and_refuses_negatives(spark):
    y, p = np.array([100.0, 200.0, 50.0]), np.array([110.0, 150.0, 80.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    got = A.evaluate(df, "y", "p").first()
    assert got["rmsle"] == pytest.approx(np.sqrt(np.mean((np.log1p(y) - np.log1p(p)) ** 2)))
    assert got["wape"] == pytest.approx(np.abs(y - p).sum() / y.sum())
    with pytest.raises(Exception, match="non-negative"):
        A.evaluate(df.withColumn("p", F.lit(-1.0)), "y", "p").collect()


def test_trend_poly2_recovers_a_parabola(spark):
    df = spark.createDataFrame([(float(x), 3 + 2 * x - 0.5 * x * x) for x in range(-5, 6)], "x double, y double")
    assert tuple(A.trend_poly2(df, "x", "y").first()) == pytest.approx((3, 2, -0.5))
    assert A.trend_poly2(df.where("x = 1"), "x", "y").first()["c0"] is None


def test_usage_stats_of_empty_log(spark):
    empty = spark.createDataFrame([], "timestamp timestamp, response_time double, status_code int")
    assert A.usage_stats(empty).count() == 0


def test_bootstrap_interval_contains_the_mean(spark):
    df = spark.range(600).select((F.col("id") % 2).alias("g"), (F.col("id") % 50).cast("int").alias("sold_price"), "id")
    for r in A.mean_ci_bootstrap(df, "g", F.col("id"), replicates=30).collect():
        assert r["ci_low"] < r["mean"] < r["ci_high"]
        half = 1.96 * math.sqrt(50**2 / 12) / math.sqrt(300)
        assert (r["ci_high"] - r["ci_low"]) / 2 == pytest.approx(half, rel=0.5)


def test_density_integrates_to_one(spark):
    df = spark.range(200).select(F.lit("x").alias("d"), (F.col("id") % 100).cast("double").alias("v"))
    rows = A.density(df, "v", "d", [float(g) for g in range(-100, 201, 2)]).collect()
    assert sum(r["density"] for r in rows) * 2 == pytest.approx(1, abs=0.01)


def test_group_bandwidths_match_the_rule_per_group(spark):
    rng = random.Random(5)
    rows = [(g, float(rng.randint(0, 40))) for g in ("a", "b", None) for _ in range(57)] + [("one", 7.0), ("zero", 0.0), ("flat", 3.0), ("flat", 3.0)]
    rows += [(f"g{k}", float(k + j)) for k in range(60) for j in range(3)]
    df = spark.createDataFrame(rows, "g string, v double")
    counted = df.groupBy("g", F.col("v").alias("__v")).agg(F.count("*").alias("__n"))
    found = {r["g"]: r["__h"] for r in A.group_bandwidths(counted, "g").collect()}
    assert len(found) == 66
    for group in (None, "a", "b", "one", "zero", "flat", "g7"):
        assert found[group] == pytest.approx(A.rule_of_thumb_bandwidth(df.where(F.col("g").eqNullSafe(F.lit(group))), "v"))
    dense = A.density(df, "v", "g", [0.0, 10.0])
    assert dense.count() == 132 and dense.where("density is null").count() == 0
