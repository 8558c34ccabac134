"""Dictionaries as tables give what the constant forms give."""

from pyspark.sql import functions as F

from pricewright.functions import text as X
from pricewright.operators import dictionaries as D
from pricewright.operators import text_features as TF
from pricewright.vocab import VALENCES, values_table

TEXTS = [
    "not a very good shirt, really GOOD!", "good bad good", "best not worst very very bad", None, "", "missing", "nothing here",
    "never the worst", "good " * 3000 + "not good", "good bad good", "the children's knives and berries", "x" * 40_000,
]


def table(spark, texts=TEXTS):
    return spark.createDataFrame([(i % 9 if i % 5 else None, x, i, "kept") for i, x in enumerate(texts)], "id int, text string, at int, term string")


def test_sentiment_equals_the_constant_form(spark):
    df = table(spark)
    lexicon = values_table(spark, list(VALENCES.items()), ["term", "valence"])
    got = D.sentiment_with_tables(df, "text", lexicon)
    assert got.columns == [*df.columns, "sentiment"]
    one = {r["at"]: r for r in got.collect()}
    two = {r["at"]: r for r in TF.lexicon_sentiment(df, "text", VALENCES).collect()}
    assert sorted(one) == sorted(two) == list(range(len(TEXTS)))
    for at, row in two.items():
        assert one[at]["id"] == row["id"] and one[at]["text"] == row["text"]
        assert abs(one[at]["sentiment"] - row["sentiment"]) < 1e-9
    assert one[0]["sentiment"] != 0 and one[3]["sentiment"] == one[5]["sentiment"] == 0


def test_cleaning_equals_the_constant_form(spark):
    df = table(spark)
    lemmas = {"knives": "blade", "shirt": "top", "missing": "gone"}
    stops = ("not", "good")
    got = D.clean_with_tables(
        df, "text", "cleaned", values_table(spark, [(w,) for w in stops], ["term"]), values_table(spark, list(lemmas.items()), ["term", "lemma"])
    )
    expected = df.withColumn("cleaned", X.clean_text(F.col("text"), stop_words=stops, lemmas=lemmas))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    built_in = D.clean_with_tables(df, "text", "text", keep="alpha")
    same = df.withColumn("text", X.clean_text(F.col("text"), keep="alpha"))
    assert sorted((r["at"], r["text"]) for r in built_in.collect()) == sorted((r["at"], r["text"]) for r in same.collect())


def test_a_million_entries(spark):
    big = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("term"), (F.col("id") % 7 - 3).cast("double").alias("valence"))
    df = spark.range(50).select("id", F.concat_ws(" ", F.lit("the"), F.concat(F.lit("w"), F.col("id") * 19_999), F.lit("end")).alias("text"))
    scored = D.sentiment_with_tables(df, "text", big).collect()
    for r in scored:
        v = r["id"] * 19_999 % 7 - 3
        assert abs(r["sentiment"] - v / (v * v + 15) ** 0.5) < 1e-12
    lemmas = big.select("term", F.concat(F.lit("x"), "term").alias("lemma"))
    cleaned = {r["id"]: r["c"] for r in D.clean_with_tables(df, "text", "c", lemmas=lemmas).collect()}
    assert cleaned == {i: f"xw{i * 19_999} end" for i in range(50)}


def test_empty_tables(spark):
    lexicon = values_table(spark, [("good", 1.0)], ["term", "valence"])
    empty = table(spark).where("false")
    assert D.sentiment_with_tables(empty, "text", lexicon).collect() == []
    assert D.clean_with_tables(empty, "text", "c").collect() == []
    assert D.sentiment_with_tables(table(spark), "text", lexicon.where("false")).agg(F.sum("sentiment")).first()[0] == 0.0


def test_repeated_and_null_entries(spark):
    df = spark.createDataFrame([("a good day",)], "text string")
    twice = spark.createDataFrame([("good", 1.0), ("good", 2.0), (None, 9.0), ("day", None)], "term string, valence double")
    assert abs(D.sentiment_with_tables(df, "text", twice).first()["sentiment"] - 2 / 19**0.5) < 1e-12


def test_words_carry_a_short_number_and_not_the_digest(spark):
    """The digest of a text, which no codec shortens, stands beside one word of it."""
    df = spark.createDataFrame([(1, "good bad good " * 500), (2, "good bad good " * 500), (3, "worst"), (4, ""), (5, None)], "id int, text string")
    cells = D.word_rows(df, "text", X.tokenize(F.col("text")))
    assert cells.count() == 1501 and cells.where("__digest is not null").count() == 2
    assert cells.select("__number").distinct().count() == 2
    assert cells.where("at = 0").select("__number", "__digest").distinct().count() == 2
