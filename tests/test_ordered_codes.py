"""Ordered codes against a plain loop over the rows."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pricewright.operators.ordered_codes import OrderedTargetEncoder, ordered_codes

SCHEMA = "id string, shade string, key int, price double"
# a hot category, missing categories and targets, repeated and null ids
ROWS = [
    (None if i % 17 == 0 else str(i % 70), None if i % 11 == 0 else ("red" if i % 3 else f"s{i % 5}"), i % 4, None if i % 13 == 0 else float(i % 29))
    for i in range(200)
]


def place(key, permutation):
    return None if key is None else hashlib.md5(f"{key}#{42 + permutation}".encode()).hexdigest()[:13]


def by_loop(permutations=3, a=2.0):
    known = [r[3] for r in ROWS if r[3] is not None]
    prior, out = sum(known) / len(known), {}
    for column, at in (("shade", 1), ("key", 2)):
        for p in range(permutations):
            for key, category in {(r[0], str(r[at])) for r in ROWS if r[at] is not None}:
                mine = place(key, p)
                earlier = [
                    r[3] for r in ROWS
                    if r[at] is not None and str(r[at]) == category and r[0] != key and r[3] is not None
                    and mine is not None and (r[0] is None or place(r[0], p) < mine)
                ]
                out[key, column, category, p] = (sum(earlier) + a * prior) / (len(earlier) + a)
    return out


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 60])
def test_codes_equal_a_loop(spark, rows_per_slice):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = ordered_codes(df, ["shade", "key"], "price", "id", 3, 2.0, rows_per_slice=rows_per_slice).collect()
    expected = by_loop()
    assert len(got) == len(expected)
    for r in got:
        assert r["code"] == pytest.approx(expected[r["key"], r["feature"], r["category"], r["permutation"]])


def test_training_rows_keep_their_number_and_new_rows_take_all_targets(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    model = OrderedTargetEncoder(["shade"], permutations=3, a=2.0).fit(df, "price", "id")
    coded = model.training(df).collect()
    assert len(coded) == len(ROWS)
    loop = by_loop()
    for r in coded:
        if r["shade"] is None:
            assert r["shade_enc"] == pytest.approx(model.prior)
        else:
            assert r["shade_enc"] == pytest.approx(sum(loop[r["id"], "shade", r["shade"], p] for p in range(3)) / 3)
    new = {r["shade"]: r["shade_enc"] for r in model.transform(spark.createDataFrame([("red",), ("unseen",), (None,)], "shade string")).collect()}
    reds = [r[3] for r in ROWS if r[1] == "red" and r[3] is not None]
    assert new["red"] == pytest.approx((sum(reds) + 2 * model.prior) / (len(reds) + 2))
    assert new["unseen"] == new[None] == pytest.approx(model.prior)


def test_tables_without_rows_or_targets(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert ordered_codes(df.where("false"), ["shade"], "price", "id").collect() == []
    blank = df.withColumn("price", F.lit(None).cast("double"))
    assert all(math.isnan(r["code"]) for r in ordered_codes(blank, ["shade"], "price", "id").collect())
    with pytest.raises(ValueError):
        OrderedTargetEncoder(["shade"], permutations=0)


def test_rows_of_many_passes_lie_on_all_cores(spark, tmp_path):
    from pricewright.operators.partitioning import spread_evenly

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    cores = spark.sparkContext.defaultParallelism
    for passed, rounds in ((1000, 1), (-(-1000 // (2 * cores)), 2)):
        even = spread_evenly(rows, passed)
        sizes = [len(part) for part in even.rdd.glom().collect()]
        assert len(sizes) == cores * rounds and max(sizes) <= passed and min(sizes) > 0
        assert sorted(r["id"] for r in even.collect()) == list(range(1000))
