import pytest
from pyspark.sql import functions as F

from pricewright.functions import text as X
from pricewright.functions.constants import constant_lookup


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("The quick brown fox jumps over the lazy dog.", "quick brown fox jump lazy dog"),
        ("", "missing"),
        (None, "missing"),
        ("  \t ", "missing"),
        ("a123 4567 !@#$%", "a123 4567"),
        ("Running faster than the wind", "running faster wind"),
        ("t-shirt, dress: boxes & ladies", "dress box lady"),
        ("the children's dog's feet", "child dog foot"),
        ("size 10,5 costs 1:2 end", "size cost end"),
    ],
)
def test_clean_text(spark, text, cleaned):
    assert one(spark, X.clean_text(F.lit(text).cast("string"))) == cleaned


def test_clean_text_options(spark):
    assert one(spark, X.clean_text(F.lit(""), "no_data")) == "no_data"
    assert one(spark, X.clean_text(F.lit("a1 shirts 22"), keep="alpha")) == "shirt"
    assert one(spark, X.clean_text(F.lit("red shirts"), stop_words=("red",), lemmas={"shirts": "top"})) == "top"
    with pytest.raises(ValueError):
        X.clean_text(F.lit("x"), keep="other")


def test_whole_text_is_cleaned(spark):
    words = " ".join(f"word{i}" for i in range(20_000))
    assert one(spark, X.clean_text(F.lit(words))) == words


def test_text_stats(spark):
    assert one(spark, X.text_stats(F.lit("red cotton shirt"))).asDict() == {
        "avg_word_length": 16 / 3, "length": 16, "num_words": 3,
    }
    assert one(spark, X.text_stats(F.lit("missing"))).asDict() == {"avg_word_length": 0.0, "length": 0, "num_words": 0}
    assert one(spark, X.text_stats(F.lit("   ")))["avg_word_length"] == 0.0


def test_text_stats_eda(spark):
    got = one(spark, X.text_stats_eda(F.lit(" red  cotton ")))
    assert (got["char_count"], got["word_count"], got["avg_word_length"]) == (13, 2, 4.5)
    assert one(spark, X.text_stats_eda(F.lit("")))["avg_word_length"] == 0.0


@pytest.mark.parametrize("n, expected", [(1, ["a", "b", "c"]), (2, ["a b", "b c"]), (3, ["a b c"]), (4, [])])
def test_ngrams(spark, n, expected):
    assert one(spark, X.ngrams(F.array(*map(F.lit, "abc")), n)) == expected


def test_vector_tokens_need_two_characters(spark):
    assert one(spark, X.vector_tokens(F.lit("A re-d T_x été 7 42"))) == ["re", "t_x", "été", "42"]


def test_constant_lookup(spark):
    table = {f"k{i}": float(i) for i in range(3000)}
    rows = spark.range(3001).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    got = rows.select("id", constant_lookup(F.col("k"), table, "double").alias("v")).collect()
    assert all(r["v"] == (r["id"] if r["id"] < 3000 else None) for r in got)
