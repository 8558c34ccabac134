import pytest
from pyspark.sql import functions as F

from pricewright.operators import quality as Q
from pricewright.operators.lookup import pair_strict
from pricewright.schemas import ERROR_CAUSE

PAGE = f"""<html><body>
<a href="/designers/rick-owens">x</a><a href="/designers/rick-owens/menswear">x</a>
<a href="/designers/rick-owens/footwear">x</a><a class="q" href="/designers/rick-owens/boots">x</a>
<h1 class="{Q.TITLE_CLASS}">Boots &amp; <b>laces</b></h1>
<p class="{Q.DETAIL_CLASS}">Size Men's / US 9</p><p class="{Q.DETAIL_CLASS}">Color Black</p>
<p class="{Q.DETAIL_CLASS}">Condition Gently Used</p>
<p class="{Q.PARAGRAPH_CLASS}">First
line</p><p class="{Q.PARAGRAPH_CLASS}">second</p>
<a href="/shop?hashtag=rick">#rick</a><a href="/shop?hashtag=boots">#boots</a>
<button class="{Q.PHOTO_CLASS}"></button><button class="{Q.PHOTO_CLASS}"></button><button class="{Q.PHOTO_CLASS}"></button>
<span class="Money SoldPrice_x">$250</span></body></html>"""
NO_TAGS = PAGE.replace("/shop?hashtag=", "/shop?other=")
NO_PRICE = PAGE.replace("SoldPrice", "Other")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [("https://x.example/listings/1-a", PAGE), ("https://x.example/listings/2-b", NO_TAGS),
            ("https://x.example/listings/3-c", NO_PRICE)]
    return spark.createDataFrame(rows, "url string, html string")


def test_listing_extraction(pages):
    got = {r["id"]: r for r in Q.extract_listings(pages).collect()}
    full = got["1"].asDict()
    expected = dict(
        designer="rick-owens", department="menswear", category="footwear", subcategory="boots", n_photos=3,
        item_name="Boots & laces", size="Men's / US 9", color="Black", condition="Gently Used",
        description="First\nline second", hashtags="rick boots", sold_price=250, listing_error=None,
    )
    assert {k: full[k] for k in expected} == expected
    assert got["2"]["hashtags"] is None and got["2"]["listing_error"] is None
    assert "sold_price" in got["3"]["listing_error"]["message"]


def test_unsold_listing_needs_no_price(pages):
    rows = Q.extract_listings(pages, sold=False)
    assert "sold_price" not in rows.columns
    assert rows.where(F.col("listing_error").isNotNull()).count() == 0


def test_entities_of_every_kind(spark):
    cases = {
        "<i>caf&eacute;</i> &amp; x": "café & x", "&amp;lt;&#38;lt;": "&lt;&lt;", "&#x1F600;&#128512;&#65;": "😀😀A",
        "&#0;&#xD800;&#1114112;": "\ufffd\ufffd\ufffd", "a & b &nothing; &#; &": "a & b &nothing; &#; &", "": "", "&apos;&quot;&nbsp;.": "'\" .",
    }
    got = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string").select("t", "want", Q.strip_markup(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in got] == [r["want"] for r in got]
    assert spark.range(1).select(Q.strip_markup(F.lit(None).cast("string")).alias("x")).first()["x"] is None


def test_route_errors_conserves_rows(spark):
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("id"),
        F.current_date().alias("parsing_date"),
        F.when(F.col("id") % 2 == 0, F.struct(F.lit("A").alias("error"), F.lit(500).alias("status_code"),
               F.lit(None).cast("string").alias("message")).cast(ERROR_CAUSE)).alias("listing_error"),
        F.when(F.col("id") % 3 == 0, F.struct(F.lit("B").alias("error"), F.lit(None).cast("int").alias("status_code"),
               F.lit("m").alias("message")).cast(ERROR_CAUSE)).alias("image_error"),
    )
    ok, errors = Q.route_errors(rows)
    assert ok.count() == 10
    assert errors.count() == 15 + 10
    assert ok.count() + errors.select("id").distinct().count() == 30
    assert errors.where("id = '0'").count() == 2


BASE = dict(
    department="menswear", category="tops", subcategory="polos", condition="New", size="M", designer="acme", color="red",
    n_photos=5, item_name="shirt", description="a shirt", hashtags="a b",
)


@pytest.mark.parametrize(
    "change, violations",
    [
        ({}, []),
        ({"hashtags": None}, []),
        ({"n_photos": 0}, ["n_photos"]),
        ({"n_photos": 26}, ["n_photos"]),
        ({"item_name": ""}, ["item_name"]),
        ({"item_name": "x" * 61}, ["item_name"]),
        ({"designer": ""}, ["designer"]),
        ({"color": None}, ["color"]),
        ({"condition": "Broken", "size": "99"}, ["condition", "size"]),
        ({"hashtags": " ".join("abcdefghijk")}, ["hashtags"]),
        ({"subcategory": "gowns"}, []),
    ],
)
def test_validation(spark, change, violations):
    schema = ", ".join(f"{k} {'int' if k == 'n_photos' else 'string'}" for k in BASE)
    row = spark.createDataFrame([tuple({**BASE, **change}.values())], schema)
    assert Q.validate(row).first()["violations"] == violations


def test_dependent_options(spark):
    row = spark.createDataFrame([tuple({**BASE, "subcategory": "gowns", "size": "4XL"}.values())],
                                ", ".join(f"{k} {'int' if k == 'n_photos' else 'string'}" for k in BASE))
    assert Q.validate(row, dependent=True).first()["violations"] == ["subcategory", "size"]


def test_pair_strict(spark):
    left = spark.range(5).withColumn("a", F.lit(1))
    assert pair_strict(left, spark.range(5).withColumn("b", F.lit(2)), "id").count() == 5
    with pytest.raises(Exception, match="no partner"):
        pair_strict(left, spark.range(4).withColumn("b", F.lit(2)), "id").collect()
