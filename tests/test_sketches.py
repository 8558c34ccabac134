import math

import pytest
from pyspark.sql import functions as F

from pricewright.operators.sketches import merge_sketches, quantile_sketches, rank_distance, sketch_quantiles, sketch_rank, sketch_size

QS = [0.0, 0.1, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def prices(spark):
    """Two hundred thousand rows; a third of them share one key, a fifth one price."""
    k = F.col("id")
    return spark.range(0, 200_000, 1, 8).select(
        F.when(k % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (k % 5).cast("string"))).alias("g"),
        (k % 4).alias("day"),
        F.when(k % 5 == 0, 100.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("price"),
    )


def test_size_follows_the_error():
    assert sketch_size(0.01) < sketch_size(0.001) <= 65_535 and sketch_size(0.9) == 8
    with pytest.raises(ValueError, match="exact"):
        sketch_size(1e-6)
    with pytest.raises(ValueError, match="between 0 and 1"):
        sketch_size(0)


@pytest.mark.parametrize("merged", [False, True])
def test_ranks_stay_within_the_error(prices, merged):
    error = 0.01
    sketches = merge_sketches(quantile_sketches(prices, ["g", "day"], "price", error), ["g"], error) if merged else quantile_sketches(prices, ["g"], "price", error)
    got = rank_distance(prices, ["g"], "price", sketch_quantiles(sketches, ["g"], QS)).collect()
    assert len(got) == 6 * len(QS)
    # the error holds with 99 per cent confidence; twice as much is never seen in practice
    assert max(r["distance"] for r in got) <= 2 * error
    assert sum(r["distance"] <= error for r in got) >= 0.95 * len(got)
    truth = {r["g"]: (r["n"], r["lo"], r["hi"]) for r in prices.groupBy("g").agg(F.count("*").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi")).collect()}
    assert {r["g"]: r["n"] for r in sketches.collect()} == {g: t[0] for g, t in truth.items()}
    for r in got:  # the ends are exact
        if r["quantile"] in (0.0, 1.0):
            assert r["value"] == truth[r["g"]][1 if r["quantile"] == 0 else 2]


def test_nulls_nans_infinities_ties_and_empty_tables(spark):
    rows = [("a", None), ("a", float("nan")), ("b", 5.0), ("b", 5.0), ("b", 5.0), (None, 1.0), ("c", float("inf")), ("c", 1.0), ("c", float("-inf"))]
    df = spark.createDataFrame(rows, "g string, price double").withColumn("n", F.lit("clash")).withColumn("sketch", F.lit("clash"))
    sketches = quantile_sketches(df, ["g"], "price")
    found = {(r["g"], r["quantile"]): r["value"] for r in sketch_quantiles(sketches, ["g"], [0.0, 0.5, 1.0]).collect()}
    assert {g for g, _ in found} == {"b", None, "c"}
    assert found[("b", 0.5)] == 5.0 and found[(None, 1.0)] == 1.0
    assert found[("c", 0.0)] == -math.inf and found[("c", 1.0)] == math.inf
    assert {r["g"]: r["s"] for r in sketches.select("g", sketch_rank(F.lit(1.0)).alias("s")).collect()}["b"] == 0.0
    assert quantile_sketches(df.limit(0), ["g"], "price").count() == 0
    assert merge_sketches(sketches, []).first()["n"] == 7
    with pytest.raises(ValueError, match="between 0 and 1"):
        sketch_quantiles(sketches, ["g"], [1.5])
