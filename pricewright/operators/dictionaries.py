"""Cleaning and sentiment with dictionaries of any size, held as tables.

The constant forms (``functions.text``, ``text_features.sentiment``) carry a short
dictionary inside the expression. Here the words of every distinct text become
rows, meet the dictionary by a join and return to their text by its number, so
neither the driver nor a task holds the dictionary. The most frequent words, which
would be the hot keys of that join, go by a broadcast of bounded size.

Null and empty texts have no words; repeated texts are worked out once and every
row gets the result; other columns pass unchanged. A term that a dictionary lists
more than once takes its greatest value; null terms and null values are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.functions.text import REJECT, normalize, singular, tokenize, words
from pricewright.operators.text_features import HOT_BYTES, HOT_TERMS, join_terms
from pricewright.session import materialize
from pricewright.vocab import BOOSTERS, NEGATIONS, PLACEHOLDER, STOP_WORDS, values_table

DIGEST, NUMBER = "__digest", "__number"
#: Share of a booster one, two and three words before the valence.
SHARES = (1.0, 0.95, 0.9)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256))


def word_rows(df: DataFrame, text: str, tokens: Column) -> DataFrame:
    """(number, digest, at, term) of the words of each distinct text, as a written table.

    Words carry the short number of their text; the digest stands beside the first word only.
    """
    texts = df.select(_digest(text).alias(DIGEST), F.col(f"`{text}`"))
    once = texts.groupBy(DIGEST).agg(F.first(f"`{text}`").alias(text))
    numbered = once.select(DIGEST, F.monotonically_increasing_id().alias(NUMBER), tokens.alias("t"))
    rows = numbered.select(NUMBER, DIGEST, F.posexplode("t").alias("at", "term"))
    return materialize(rows.withColumn(DIGEST, F.when(F.col("at") == 0, F.col(DIGEST))), "words")


def look_up(cells: DataFrame, dictionary: DataFrame) -> DataFrame:
    """All cells with the columns of the dictionary, null where it lacks the term.

    ``dictionary`` has one row per term. A term outside the broadcast holds less
    than one cell in HOT_TERMS, or is longer than HOT_BYTES.
    """
    counted = cells.groupBy("term").agg(F.count("*").alias("__n"))
    known = materialize(counted.join(dictionary, "term", "left"), "known-words")
    values = [c for c in dictionary.columns if c != "term"]
    texts = ["term", *[f.name for f in dictionary.schema if f.dataType.typeName() == "string" and f.name != "term"]]
    short = known.where(F.octet_length(F.concat_ws("", *texts)) <= HOT_BYTES)
    hot = materialize(short.orderBy(F.desc("__n"), "term").limit(HOT_TERMS).drop("__n"), "hot-words")
    names = F.broadcast(hot.select("term"))
    rare = known.join(names, "term", "left_anti").drop("__n")
    columns = [*cells.columns, *values]
    found = cells.join(F.broadcast(hot), "term").select(*columns)
    return found.unionByName(cells.join(names, "term", "left_anti").join(rare, "term").select(*columns))


def _back(df: DataFrame, text: str, cells: DataFrame, table: DataFrame, value: Column, output: str) -> DataFrame:
    """The rows of ``df`` with a value made from the table's columns for the number of their text."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != output]
    table = cells.where(F.col("at") == 0).select(DIGEST, NUMBER).join(table, NUMBER).drop(NUMBER)
    return df.withColumn(DIGEST, _digest(text)).join(table, DIGEST, "left").select(*kept, value.alias(output))


def clean_with_tables(
    df: DataFrame,
    text: str,
    output: str,
    stop_words: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    keep: str = "alnum",
    placeholder: str = PLACEHOLDER,
) -> DataFrame:
    """``clean_text`` with a stop list (term) and a lemma table (term, lemma) of any size.

    Without a stop list the built-in one is taken; words that the lemma table
    lacks follow the plural rules.
    """
    if keep not in REJECT:
        raise ValueError(f"keep must be one of {sorted(REJECT)}, not {keep!r}")
    spark = df.sparkSession
    stops = values_table(spark, [(w,) for w in STOP_WORDS], ["term"]) if stop_words is None else stop_words
    entries = stops.select("term", F.lit(True).alias("stop"), F.lit(None).cast("string").alias("lemma"))
    if lemmas is not None:
        entries = entries.unionByName(lemmas.select("term", F.lit(None).cast("boolean").alias("stop"), F.col("lemma").cast("string")))
    dictionary = entries.groupBy("term").agg(F.max("stop").alias("stop"), F.max("lemma").alias("lemma"))
    cells = word_rows(df, text, words(F.regexp_replace(normalize(F.col(f"`{text}`")), REJECT[keep], " ")))
    # the rules come after the join, once for each kept word
    rules = singular(F.col("term"), None if lemmas is None else {})
    kept = look_up(cells.drop(DIGEST), dictionary).where(F.col("stop").isNull()).select(NUMBER, "at", F.coalesce("lemma", rules).alias("word"))
    listed = kept.groupBy(NUMBER).agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("listed"))
    joined = listed.select(NUMBER, F.array_join(F.col("listed.word"), " ").alias("__cleaned"))
    return _back(df, text, cells, joined, F.coalesce(F.nullif("__cleaned", F.lit("")), F.lit(placeholder)), output)


def _rules(spark, given: DataFrame | None, default: dict, name: str, kind: str) -> DataFrame:
    table = values_table(spark, list(default.items()), ["term", name]) if given is None else given
    return table.select("term", F.col(name).cast(kind))


def sentiment_with_tables(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    negations: DataFrame | None = None,
    boosters: DataFrame | None = None,
    output: str = "sentiment",
    placeholder: str = PLACEHOLDER,
) -> DataFrame:
    """``lexicon_sentiment`` with tables: lexicon (term, valence), negations (term), boosters (term, push).

    Only words that a table lists move on to the windows over their text, which
    look back at the last three listed words and at how far away they stand.
    """
    spark = df.sparkSession
    turning = None if negations is None else negations.select("term", F.lit(True).alias("turns"))
    columns = {
        "valence": ("double", lexicon.select("term", F.col("valence").cast("double"))),
        "push": ("double", _rules(spark, boosters, BOOSTERS, "push", "double")),
        "turns": ("boolean", _rules(spark, turning, {n: True for n in NEGATIONS}, "turns", "boolean")),
    }
    entries = None
    for name, (_, table) in columns.items():
        empty = [F.lit(None).cast(kind).alias(c) for c, (kind, _) in columns.items() if c != name]
        wide = table.select("term", name, *empty).where(F.col(name).isNotNull())
        entries = wide if entries is None else entries.unionByName(wide)
    dictionary = entries.groupBy("term").agg(*[F.max(c).alias(c) for c in columns])
    cells = word_rows(df, text, tokenize(F.col(f"`{text}`")))
    counted = cells.groupBy("term").agg(F.count("*").alias("df"))
    listed = join_terms(cells.drop(DIGEST), materialize(dictionary.join(counted, "term"), "listed-words"))

    in_order = Window.partitionBy(NUMBER).orderBy("at")
    push, turned = F.lit(0.0), F.lit(False)
    before = [f"__before_{k}" for k in range(1, len(SHARES) + 1)]
    listed = listed.withColumns({c: F.lag(F.struct("at", "push", "turns"), k).over(in_order) for k, c in enumerate(before, 1)})
    for c in before:
        away = F.col("at") - F.col(f"{c}.at")
        share = F.get(F.array(*map(F.lit, SHARES)), away - 1)
        push = push + F.coalesce(F.col(f"{c}.push") * share, F.lit(0.0))
        turned = turned | F.coalesce(F.col(f"{c}.turns") & (away <= len(SHARES)), F.lit(False))
    v = F.col("valence")
    value = (v + F.when(v < 0, -push).otherwise(push)) * F.when(turned, F.lit(-0.74)).otherwise(F.lit(1.0))
    sums = listed.where(v.isNotNull()).groupBy(NUMBER).agg(F.sum(value).alias("__sum"))
    s = F.coalesce("__sum", F.lit(0.0))
    is_blank = F.coalesce(F.col(f"`{text}`") == placeholder, F.lit(True))
    return _back(df, text, cells, sums, F.when(is_blank, F.lit(0.0)).otherwise(s / F.sqrt(s * s + F.lit(15.0))), output)
