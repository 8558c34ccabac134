"""Text queries: cleaning, statistics, n-grams, token overlap, vectors, sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions import text as X
from pricewright.operators import aggregates as A
from pricewright.operators import dictionaries as D
from pricewright.operators import lookup as L
from pricewright.operators import reshape as R
from pricewright.operators import select as S
from pricewright.operators import text_features as TF
from pricewright.operators.quantiles import quantiles
from pricewright.operators.term_blocks import counted_terms, sampled_bounds
from pricewright.plans.registry import query
from pricewright.session import materialize
from pricewright.vocab import TEXT_COLUMNS

COLUMNS = list(TEXT_COLUMNS)


@query(
    "cleaned_text",
    "STR-2",
    """SELECT id, coalesce(nullif(array_to_string({alnum_tokens}, ' '), ''), 'missing') AS cleaned
       FROM (SELECT id, description AS txt FROM {described})""",
)
def cleaned_text(t):
    return t.described("id", "description").select("id", X.clean_text(F.col("description")).alias("cleaned"))


@query(
    "cleaned_text_alpha",
    "STR-3",
    """SELECT id, coalesce(nullif(array_to_string({alpha_tokens}, ' '), ''), 'missing') AS cleaned
       FROM (SELECT id, hashtags || ' ' || description AS txt FROM {described})""",
)
def cleaned_text_alpha(t):
    both = F.concat_ws(" ", "hashtags", "description")
    return t.described("id", "hashtags", "description").select("id", X.clean_text(both, keep="alpha").alias("cleaned"))


_WORDS = r"list_filter(regexp_split_to_array(txt, '\s+'), lambda w: w <> '')"


@query(
    "model_text_stats",
    "STR-4 STR-7",
    rf"""SELECT id, feature, CASE WHEN txt = 'missing' THEN 0.0::DOUBLE
                   ELSE length(txt)::DOUBLE / len({_WORDS}) END AS avg_word_length,
              CASE WHEN txt = 'missing' THEN 0 ELSE length(txt) END AS length,
              CASE WHEN txt = 'missing' THEN 0 ELSE len({_WORDS}) END AS num_words,
              CASE WHEN txt = 'missing' THEN 1 ELSE 0 END AS is_missing
       FROM (SELECT id, 'hashtags' AS feature, hashtags AS txt FROM {{described}}
             UNION ALL SELECT id, 'description', description FROM {{described}})""".replace("{{", "{").replace("}}", "}"),
)
def model_text_stats(t):
    long = t.described("id", "hashtags", "description").unpivot(["id"], ["hashtags", "description"], "feature", "txt")
    return long.select("id", "feature", X.text_stats(F.col("txt")).alias("s"), X.is_missing(F.col("txt")).alias("is_missing")).select(
        "id", "feature", "s.*", "is_missing"
    )


@query(
    "exploration_text_stats",
    "STR-5 RSH1 FLT3 PRJ4",
    rf"""WITH d AS {{described}}, w AS (
           SELECT feature AS text_feature, sold_price, length(txt) AS char_count, len({_WORDS}) AS word_count,
                  CASE WHEN len({_WORDS}) = 0 THEN 0.0::DOUBLE
                       ELSE list_sum(list_transform({_WORDS}, lambda w: length(w)))::DOUBLE / len({_WORDS}) END AS awl
           FROM (SELECT 'hashtags' AS feature, sold_price, replace(hashtags, 'missing', '') AS txt FROM d
                 UNION ALL SELECT 'description', sold_price, description FROM d
                 UNION ALL SELECT 'item_name', sold_price, item_name FROM d))
       SELECT text_feature, sold_price, 'char_count' AS stat, char_count::DOUBLE AS value FROM w WHERE char_count <> 0
       UNION ALL SELECT text_feature, sold_price, 'word_count', word_count FROM w WHERE word_count <> 0
       UNION ALL SELECT text_feature, sold_price, 'avg_word_length', awl FROM w WHERE awl <> 0""",
)
def exploration_text_stats(t):
    rows = S.blank_placeholder(t.described("sold_price", *COLUMNS))
    return S.drop_empty_values(R.text_stats_long(rows, COLUMNS))


@query(
    "price_by_word_count",
    "AGG1 FLT3 AGG9",
    rf"""WITH g AS (SELECT len({_WORDS}) AS value, count(*) AS count, sum(sold_price)::DOUBLE / count(*) AS mean
                  FROM (SELECT sold_price, description AS txt FROM {{described}}) GROUP BY 1)
       SELECT count(*) AS points, round(regr_slope(mean, value), 9) AS slope, round(regr_intercept(mean, value), 6) AS intercept
       FROM g WHERE value <> 0""",
)
def price_by_word_count(t):
    stats = R.text_stats_long(t.described("sold_price", "description"), ["description"])
    points = A.count_mean(S.drop_empty_values(S.where_equal(stats, stat="word_count")), "value")
    line = points.agg(
        F.count("*").alias("points"),
        F.regr_slope("mean", "value").alias("slope"),
        F.regr_intercept("mean", "value").alias("intercept"),
    )
    return line.withColumns({"slope": F.round("slope", 9), "intercept": F.round("intercept", 6)})


@query(
    "document_ngrams",
    "STR-6 RSH3",
    """WITH d AS (SELECT doc_id, {alpha_tokens} AS t FROM (SELECT doc_id, text AS txt FROM documents))
       SELECT n AS ngram, value, count(*) AS count FROM (
         SELECT 1 AS n, unnest(t) AS value FROM d
         UNION ALL SELECT 2, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM d
         UNION ALL SELECT 3, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM d)
       GROUP BY ALL""",
)
def document_ngrams(t):
    def values(docs):
        tokens = docs.select(X.clean_tokens(F.col("text"), "alpha").alias("t"))
        kinds = F.explode(
            F.array(*[F.struct(F.lit(n).alias("ngram"), X.ngrams(F.col("t"), n).alias("v")) for n in (1, 2, 3)])
        )
        long = R.explode_list(tokens.select(kinds.alias("k")).select("k.ngram", "k.v"), "v").where(F.col("value").isNotNull())
        # the key in one column: the digit, then the value
        return long.select(F.concat(F.col("ngram").cast("string"), "value").alias("term"))

    docs = t.documents()
    counted = counted_terms(values(docs), sampled_bounds(docs, F.col("text"), values))
    return counted.select(F.substring("term", 1, 1).cast("int").alias("ngram"), F.expr("substring(term, 2)").alias("value"), F.col("tf").alias("count"))


_NGRAMS_SQL = """
  WITH d AS {described},
  q AS (SELECT quantile_cont(sold_price, 0.25) AS lo, quantile_cont(sold_price, 0.75) AS hi FROM d),
  x AS (SELECT text_feature, sold_price, {alpha_tokens} AS t FROM (
          SELECT 'item_name' AS text_feature, sold_price, item_name AS txt FROM d
          UNION ALL SELECT 'description', sold_price, description FROM d
          UNION ALL SELECT 'hashtags', sold_price, replace(hashtags, 'missing', '') FROM d)),
  g AS (SELECT text_feature, sold_price, 'unigrams' AS ngram, unnest(t) AS value FROM x
        UNION ALL SELECT text_feature, sold_price, 'bigrams', unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM x
        UNION ALL SELECT text_feature, sold_price, 'trigrams',
               unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM x),
  c AS (SELECT text_feature, ngram, CASE WHEN sold_price > hi THEN 'top' ELSE 'bottom' END AS tail, value,
               count(*) AS count, sum(sold_price)::DOUBLE / count(*) AS mean
        FROM g, q WHERE value <> 'missing' AND (sold_price > hi OR sold_price < lo) GROUP BY ALL)
"""


def _ngram_counts(t):
    rows = S.blank_placeholder(t.described("sold_price", *COLUMNS))
    q = quantiles(t.described("sold_price"), [0.25, 0.75])
    return TF.ngram_counts(rows, COLUMNS, q[0.25], q[0.75])


@query(
    "tail_ngram_counts",
    "AGG12 FLT3",
    _NGRAMS_SQL + "SELECT text_feature, ngram, tail, count, count(*) AS values, round(sum(mean), 6) AS means FROM c GROUP BY ALL",
)
def tail_ngram_counts(t):
    counts = _ngram_counts(t)
    return counts.groupBy("text_feature", "ngram", "tail", "count").agg(
        F.count("*").alias("values"), F.round(F.sum("mean"), 6).alias("means")
    )


@query(
    "top_tail_ngrams",
    "AGG12 WIN1 STR-3",
    _NGRAMS_SQL
    + """SELECT *, row_number() OVER (PARTITION BY text_feature, ngram, tail ORDER BY count DESC, value) AS rank
         FROM c QUALIFY rank <= 10""",
)
def top_tail_ngrams(t):
    return TF.top_ngrams(_ngram_counts(t))


@query(
    "token_overlap",
    "JOI5",
    """WITH d AS {described},
       x AS (SELECT DISTINCT feature, unnest({alpha_tokens}) AS token FROM (
               SELECT 'item_name' AS feature, item_name AS txt FROM d UNION ALL SELECT 'description', description FROM d
               UNION ALL SELECT 'hashtags', hashtags FROM d))
       SELECT a.feature AS feature1, b.feature AS feature2, count(*) AS intersection_count
       FROM x a JOIN x b USING (token) GROUP BY ALL""",
)
def token_overlap(t):
    tokens = t.described(*COLUMNS).select(*[X.clean_tokens(F.col(c), "alpha").alias(c) for c in COLUMNS])
    return L.token_overlap(tokens, COLUMNS)


_TERMS = "{vector_tokens}"
_TRIGRAMS = "list_transform(range(1, len(v) - 1), lambda i: v[i] || ' ' || v[i + 1] || ' ' || v[i + 2])"
_BIGRAMS = "list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1])"


@query(
    "bag_of_words_cells",
    "ENC12",
    f"""WITH v AS (SELECT doc_id, {_TERMS} AS v FROM (SELECT doc_id, text AS txt FROM documents)),
       c AS (SELECT doc_id, term, count(*) AS tf FROM
              (SELECT doc_id, unnest(list_concat(v, {_BIGRAMS})) AS term FROM v) GROUP BY ALL),
       k AS (SELECT term FROM c GROUP BY 1 HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 500)
       SELECT doc_id, term, tf::DOUBLE AS value FROM c JOIN k USING (term)""",
)
def bag_of_words_cells(t):
    docs = t.documents().select("doc_id", "text")
    model = TF.BagOfWords("count", (1, 2), min_df=2, max_features=500).fit(docs, "text")
    return TF.vector_cells(model.transform(docs, "v"), "doc_id", "v", model)


@query(
    "all_ngram_cells",
    "ENC12",
    f"""WITH v AS (SELECT doc_id, {_TERMS} AS v FROM (SELECT doc_id, text AS txt FROM documents)),
       c AS (SELECT doc_id, term, count(*) AS tf FROM
              (SELECT doc_id, unnest(list_concat(v, {_BIGRAMS}, {_TRIGRAMS})) AS term FROM v) GROUP BY ALL),
       k AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS place FROM (SELECT DISTINCT term FROM c))
       SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS occurrences,
              CAST(sum(place) AS BIGINT) AS places FROM c JOIN k USING (term) GROUP BY 1""",
)
def all_ngram_cells(t):
    """Every term of one to three words of all documents, in vectors over the whole vocabulary."""
    docs = t.documents().select("doc_id", "text")
    model = TF.BagOfWords("count", (1, 3)).fit(docs, "text")
    cells = TF.vector_cells(model.transform(docs, "v"), "doc_id", "v")
    return cells.groupBy("doc_id").agg(
        F.count("*").alias("terms"), F.sum(F.col("value").cast("bigint")).alias("occurrences"), F.sum(F.col("index").cast("bigint")).alias("places")
    )


@query(
    "vocabulary_counts",
    "ENC12",
    f"""WITH v AS (SELECT doc_id, {_TERMS} AS v FROM (SELECT doc_id, text AS txt FROM documents))
       SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df
       FROM (SELECT doc_id, unnest(list_concat(v, {_BIGRAMS})) AS term FROM v) GROUP BY 1 HAVING df >= 2""",
)
def vocabulary_counts(t):
    return TF.vocabulary(t.documents(), "text", (1, 2), min_df=2)


_TFIDF_SQL = f"""WITH v AS (SELECT doc_id, {_TERMS} AS v FROM (SELECT doc_id, text AS txt FROM documents)),
       c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(v) AS term FROM v) GROUP BY ALL),
       k AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1 AS idf, sum(tf) AS total
             FROM c GROUP BY 1 HAVING count(*) >= 2 %s),
       w AS (SELECT doc_id, term, tf, tf * idf AS w FROM c JOIN k USING (term))
       SELECT doc_id, term, %s, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 8) AS %s FROM w"""


@query("tfidf_cells", "ENC13", _TFIDF_SQL % ("", "tf", "weight"))
def tfidf_cells(t):
    return TF.tfidf_long(t.documents(), "doc_id", "text", min_df=2).withColumn("weight", F.round("weight", 8))


@query("tfidf_vector_cells", "ENC13", (_TFIDF_SQL % ("ORDER BY total DESC, term LIMIT 1000", "1 AS one", "value")))
def tfidf_vector_cells(t):
    docs = t.documents().select("doc_id", "text")
    model = TF.BagOfWords("tfidf", min_df=2, max_features=1000).fit(docs, "text")
    out = TF.vector_cells(model.transform(docs, "v"), "doc_id", "v", model)
    return out.select("doc_id", "term", F.lit(1).alias("one"), F.round("value", 8).alias("value"))


# A lexicon in the made-up language of the documents.
LEXICON = {"only": -0.4, "rest": 1.1, "thing": 0.5, "ring": 1.6, "best": 3.2, "rent": -1.3, "ones": 0.7, "hand": 0.9,
           "thin": -0.8, "mal": -2.0, "bien": 1.9, "la": 0.2, "der": -0.1}
TURNERS = ("not", "no", "pas", "nicht", "on")
PUSHERS = {"very": 0.293, "the": 0.293, "of": -0.293, "de": 0.293}


def _case(table: dict) -> str:
    return "CASE token " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in table.items()) + " END"


_SENTIMENT_SQL = """tok AS (SELECT id, generate_subscripts(t, 1) AS i, unnest(t) AS token FROM (
         SELECT id, {all_tokens} AS t FROM (SELECT doc_id AS id, text AS txt FROM documents))),
       m AS (SELECT *, %s AS val, coalesce(%s, 0) AS push, coalesce(token IN (%s), false) AS turn FROM tok),
       s AS (SELECT id, val, lag(push, 1, 0) OVER w + 0.95 * lag(push, 2, 0) OVER w + 0.9 * lag(push, 3, 0) OVER w AS p,
                    lag(turn, 1, false) OVER w OR lag(turn, 2, false) OVER w OR lag(turn, 3, false) OVER w AS t
             FROM m WINDOW w AS (PARTITION BY id ORDER BY i)),
       z AS (SELECT id, sum(coalesce((val + CASE WHEN val < 0 THEN -p ELSE p END) * CASE WHEN t THEN -0.74 ELSE 1 END, 0)) AS x
             FROM s GROUP BY 1),
       f AS (SELECT doc_id AS id, round(coalesce(x, 0) / sqrt(coalesce(x, 0) ^ 2 + 15), 8) AS sentiment
             FROM documents LEFT JOIN z ON doc_id = id)
""" % (_case(LEXICON), _case(PUSHERS), ", ".join(f"'{x}'" for x in TURNERS))


def _sentiment(t):
    docs = t.documents().select(F.col("doc_id").alias("id"), "text")
    scored = TF.lexicon_sentiment(docs, "text", LEXICON, negations=TURNERS, boosters=PUSHERS)
    return scored.select("id", F.round("sentiment", 8).alias("sentiment"))


@query("description_sentiment", "ENC15", "WITH " + _SENTIMENT_SQL + " SELECT * FROM f")
def description_sentiment(t):
    return _sentiment(t)


# Dictionaries that hold every word of the documents; a word's entry follows from its MD5.
def _digit(word, at: int, digits: int):
    return F.conv(F.substring(F.md5(word), at, digits), 16, 10).cast("int")


def _every_word(t, tokens):
    return materialize(t.documents().select(F.explode(tokens).alias("term")).distinct(), "every-word")


_TABLE_SENTIMENT_SQL = """WITH tok AS (SELECT id, generate_subscripts(t, 1) AS i, unnest(t) AS token FROM (
         SELECT doc_id AS id, {all_tokens} AS t FROM (SELECT doc_id, text AS txt FROM documents))),
       h AS (SELECT id, i, ('0x' || substr(md5(token), 1, 3))::INTEGER AS a, ('0x' || substr(md5(token), 4, 2))::INTEGER AS b FROM tok),
       m AS (SELECT id, i, CASE WHEN a % 3 = 0 THEN (a % 41 - 20) / 8.0::DOUBLE END AS val,
                    CASE WHEN b % 7 = 0 THEN (b % 5 - 2) / 8.0::DOUBLE ELSE 0 END AS push, b % 11 = 0 AS turn FROM h),
       s AS (SELECT id, val, lag(push, 1, 0) OVER w + 0.95 * lag(push, 2, 0) OVER w + 0.9 * lag(push, 3, 0) OVER w AS p,
                    lag(turn, 1, false) OVER w OR lag(turn, 2, false) OVER w OR lag(turn, 3, false) OVER w AS t
             FROM m WINDOW w AS (PARTITION BY id ORDER BY i)),
       z AS (SELECT id, sum(coalesce((val + CASE WHEN val < 0 THEN -p ELSE p END) * CASE WHEN t THEN -0.74 ELSE 1 END, 0)) AS x
             FROM s GROUP BY 1)
       SELECT doc_id, round(coalesce(x, 0) / sqrt(coalesce(x, 0) ^ 2 + 15), 8) AS sentiment
       FROM documents LEFT JOIN z ON doc_id = id"""


@query("table_sentiment", "ENC15", _TABLE_SENTIMENT_SQL)
def table_sentiment(t):
    """Lexicon, negations and boosters as tables that grow with the documents."""
    term = F.col("term")
    every = _every_word(t, X.tokenize(F.col("text")))
    a, b = _digit(term, 1, 3), _digit(term, 4, 2)
    lexicon = every.where(a % 3 == 0).select("term", ((a % 41 - 20) / 8.0).alias("valence"))
    boosters = every.where(b % 7 == 0).select("term", ((b % 5 - 2) / 8.0).alias("push"))
    docs = t.documents().select("doc_id", "text")
    scored = D.sentiment_with_tables(docs, "text", lexicon, every.where(b % 11 == 0), boosters)
    return scored.select("doc_id", F.round("sentiment", 8).alias("sentiment"))


@query(
    "table_cleaned_text",
    "STR-2",
    """WITH d AS (SELECT doc_id, {alnum_words} AS ws FROM (SELECT doc_id, text AS txt FROM documents)),
       c AS (SELECT doc_id, list_transform(list_filter(ws, lambda w: ('0x' || substr(md5(w), 1, 2))::INTEGER % 7 <> 0),
               lambda w: CASE WHEN ('0x' || substr(md5(w), 3, 2))::INTEGER % 5 = 0 THEN substr(md5(w), 1, 6) ELSE {singular} END) AS ws FROM d)
       SELECT doc_id, md5(coalesce(nullif(array_to_string(ws, ' '), ''), 'missing')) AS cleaned_md5, len(ws) AS n_words FROM c""",
)
def table_cleaned_text(t):
    """Stop list and lemmas as tables that grow with the documents."""
    term = F.col("term")
    every = _every_word(t, X.tokenize(F.col("text")))
    stops = every.where(_digit(term, 1, 2) % 7 == 0)
    lemmas = every.where(_digit(term, 3, 2) % 5 == 0).select("term", F.substring(F.md5(term), 1, 6).alias("lemma"))
    docs = t.documents().select("doc_id", "text")
    cleaned = D.clean_with_tables(docs, "text", "cleaned", stops, lemmas)
    n_words = F.when(F.col("cleaned") == "missing", 0).otherwise(F.size(X.words(F.col("cleaned"))))
    return cleaned.select("doc_id", F.md5("cleaned").alias("cleaned_md5"), n_words.cast("long").alias("n_words"))


def _priced_sentiment(t):
    prices = t.described("id", "sold_price").withColumn("id", F.col("id").cast("long"))
    return _sentiment(t).join(prices, "id")


@query(
    "price_by_sentiment_bin",
    "AGG7 AGG6 ENC15",
    "WITH " + _SENTIMENT_SQL + """, r AS (SELECT min(sentiment) AS lo, max(sentiment) AS hi FROM f),
       k AS (SELECT max(n) AS n FROM (SELECT unnest([1, 2, 5, 10, 20, 50, 100]) AS n), r WHERE ceil(hi * n) - floor(lo * n) <= 20)
       SELECT floor(sentiment * n) / n AS bin, count(*) AS count, sum(round(p_retailprice))::DOUBLE / count(*) AS mean
       FROM f JOIN part ON id = p_partkey, k GROUP BY 1""",
)
def price_by_sentiment_bin(t):
    return A.binned_mean(_priced_sentiment(t), "sentiment", max_bins=20)


@query(
    "price_sentiment_curve",
    "AGG10",
    "WITH " + _SENTIMENT_SQL + """, b AS (SELECT floor(sentiment * 10) / 10 AS x, round(p_retailprice) AS y FROM f JOIN part ON id = p_partkey),
       sums AS (SELECT count(*)::DOUBLE AS n, sum(x) AS x1, sum(x * x) AS x2, sum(x ^ 3) AS x3, sum(x ^ 4) AS x4, sum(y) AS y,
                    sum(x * y) AS xy, sum(x * x * y) AS x2y FROM b),
       d AS (SELECT *, n * (x2 * x4 - x3 * x3) - x1 * (x1 * x4 - x2 * x3) + x2 * (x1 * x3 - x2 * x2) AS det FROM sums)
       SELECT round((y * (x2 * x4 - x3 * x3) - x1 * (xy * x4 - x3 * x2y) + x2 * (xy * x3 - x2 * x2y)) / det, 4) AS c0,
              round((n * (xy * x4 - x3 * x2y) - y * (x1 * x4 - x2 * x3) + x2 * (x1 * x2y - xy * x2)) / det, 4) AS c1,
              round((n * (x2 * x2y - xy * x3) - x1 * (x1 * x2y - xy * x2) + y * (x1 * x3 - x2 * x2)) / det, 4) AS c2 FROM d""",
)
def price_sentiment_curve(t):
    rows = _priced_sentiment(t).withColumn("x", A.bin_start(F.col("sentiment"), 0.1))
    out = A.trend_poly2(rows, "x", "sold_price")
    return out.select(*[F.round(c, 4).alias(c) for c in ("c0", "c1", "c2")])
