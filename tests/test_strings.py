import datetime

import pytest
from pyspark.sql import functions as F

from pricewright.functions import numeric, strings


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, size",
    [
        ("Women's / ONE SIZE", "ONE SIZE"),
        ("Women's / XXS / US 00 / IT 34", "XXS"),
        ("Women's / 3XL / US 20-22", "3XL"),
        ("Men's / US 28 / EU 44", "28"),
        ("Men's / US 10.5 / EU 43-44", "10.5"),
        ("Men's / 52S, 36R, 44L", "52S"),
        ("Men's / US M / EU 48-50", "M"),
        ("Random Text", "Random Text"),
    ],
)
def test_extract_size(spark, text, size):
    assert one(spark, strings.extract_size(F.lit(text))) == size


def test_extract_size_keeps_null(spark):
    assert one(spark, strings.extract_size(F.lit(None).cast("string"))) is None


def test_link_helpers(spark):
    assert one(spark, strings.listing_id(F.lit("https://x.example/listings/4711-shirt-2"))) == "4711"
    assert one(spark, strings.slug(F.lit("/designers/acme/tops"))) == "tops"
    assert one(spark, strings.strip_prefix(F.lit("Color Red"), "Color ")) == "Red"
    assert one(spark, strings.strip_prefix(F.lit("Red Color "), "Color ")) == "Red Color "
    assert one(spark, strings.designer_slug(F.lit("  Rick  Owens "))) == "rick-owens"
    assert one(spark, strings.first_token(F.lit("a.webp 480w, b.webp 960w"))) == "a.webp"


def test_client_ip(spark):
    host = F.lit("9.9.9.9")
    assert one(spark, strings.client_ip(F.lit("1.2.3.4, 5.6.7.8"), host)) == "1.2.3.4"
    assert one(spark, strings.client_ip(F.lit(None).cast("string"), host)) == "9.9.9.9"
    assert one(spark, strings.client_ip(F.lit(""), host)) == "9.9.9.9"


def test_error_detail_skips_absent_parts(spark):
    none = F.lit(None)
    assert one(spark, strings.error_detail(F.lit("HTTPError"), F.lit(404), none.cast("string"))) == (
        "Error type: HTTPError | Status code: 404"
    )
    assert one(spark, strings.error_detail(F.lit("IndexError"), none.cast("int"), F.lit("no"))) == (
        "Error type: IndexError | Message: no"
    )


def test_prediction_id(spark):
    at = F.lit(datetime.datetime(2024, 2, 3, 4, 5, 6))
    assert one(spark, strings.prediction_id(at)) == "pred_20240203_040506"


@pytest.mark.parametrize("price, whole", [(100.5, 100), (99.99, 100), (0.01, 0), (9999.99, 10000), (101.5, 102)])
def test_whole_price_rounds_half_to_even(spark, price, whole):
    assert one(spark, numeric.whole_price(F.lit(price))) == whole


def test_log_round_trip(spark):
    assert one(spark, numeric.unlog(numeric.log_target(F.lit(250)))) == pytest.approx(250)
