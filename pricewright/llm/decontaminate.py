"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark item becomes windows of ``WINDOW`` consecutive words (an item of
fewer words is one window), every window the set of its ``SHINGLE``-word
shingles. One pass over the documents finds the places of benchmark shingles,
with the few words around each. Their counts order the shingles by rarity. A
document that holds a whole window holds each of its shingles, so the necessary
prefix is one shingle per window: the rarest. Only places of prefix shingles are
joined with the items that have them; the position in item and document bounds
where a window can lie, and the words around the shared shingle are compared one
by one, which confirms or refutes every window that contains it.

The benchmark's shingles are broadcast in blocks of at most ``BLOCK_ROWS`` hashes;
the documents are read once per block, one block for any usual benchmark.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.llm.tables import column, materialize, text_or_empty, unique_name

WINDOW = 13
SHINGLE = 5
#: Hashes broadcast at once: 24 bytes each.
BLOCK_ROWS = 2_000_000
#: Stands for the document itself among its shingles.
DOCUMENT = 0

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Words of a text, A-Z lower-cased and nothing else."""
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered, NO_WORD), "")


def _shingles(hashes: Column, k: int) -> Column:
    """Hashes of every k consecutive word hashes, in order; null where fewer follow."""
    whole = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, k)]))
    return F.slice(whole, 1, F.greatest(F.lit(0), F.size(hashes) - (k - 1)))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def row_key(identity: Column, text: Column) -> Column:
    """128 bits of (id, text): rows with one key have one result."""
    named = F.concat(F.coalesce(identity.cast("string"), F.lit("none")), F.lit(":"), text)
    return F.substring(F.unhex(F.sha2(named, 256)), 1, 16)


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item, words, length of a window, shingle size. Items without words have no window."""
    items = benchmark.select(
        F.coalesce(column(benchmark, item_col).cast("string"), F.lit("")).alias("item"), word_list(text_or_empty(benchmark, text_col)).alias("item_words")
    )
    return items.where(F.size("item_words") > 0).distinct().withColumn("wide", F.least(F.size("item_words"), F.lit(WINDOW))).withColumn(
        "k", F.least(F.col("wide"), F.lit(SHINGLE))
    )


def item_shingles(items: DataFrame) -> DataFrame:
    """Every shingle of every item: n (the item), hash, k, at, item, item_words, wide."""
    numbered = items.withColumn("n", F.monotonically_increasing_id()).withColumn("hashes", _word_hashes(F.col("item_words")))
    of_size = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("hashes"), k)) for k in range(1, SHINGLE + 1)])
    return numbered.select("n", "k", "item", "item_words", "wide", F.posexplode(of_size).alias("at", "hash"))


def shingle_places(docs: DataFrame, shingles: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Places of the benchmark's shingles, and one row (hash ``DOCUMENT``, k 0) per document.

    key, doc_id, n_words, k, hash, pos, around (the words that a window over the
    place can hold), skipped (words of the document before them).
    """
    sizes = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most SHINGLE numbers
    text = text_or_empty(docs, text_col)
    base = docs.select(
        column(docs, id_col).cast("bigint").alias("doc_id"), row_key(column(docs, id_col), text).alias("key"), word_list(text).alias("words")
    ).select("*", _word_hashes(F.col("words")).alias("hashes"))
    near = WINDOW - 1
    skipped = F.greatest(F.lit(0), F.col("pos") - near)
    places = None

    def add(stream: DataFrame, wanted: DataFrame) -> None:
        nonlocal places
        found = stream.join(F.broadcast(wanted), ["hash", "k"]).select(
            "key", "doc_id", F.size("words").cast("bigint").alias("n_words"), "k", "hash", "pos",
            F.when(F.col("k") > 0, F.slice("words", skipped + 1, 2 * near + SHINGLE)).alias("around"), skipped.alias("skipped"),
        )
        places = found if places is None else places.unionByName(found)

    distinct = shingles.select("hash", "k").distinct()
    self_row = docs.sparkSession.range(1).select(F.lit(DOCUMENT).cast("bigint").alias("hash"), F.lit(0).alias("k"))
    blocks = -(-distinct.count() // BLOCK_ROWS) or 1
    for b in range(blocks):
        part = distinct if blocks == 1 else distinct.where(F.pmod("hash", F.lit(blocks)) == b)
        for k in sizes or [SHINGLE]:
            with_document = b == 0 and k == (sizes or [SHINGLE])[0]
            listed = _shingles(F.col("hashes"), k)
            if with_document:  # in front, so shingle positions are one less
                listed = F.concat(F.array(F.lit(DOCUMENT).cast("bigint")), listed)
            stream = base.select("doc_id", "key", "words", listed.alias("listed"))
            stream = stream.select("doc_id", "key", "words", F.posexplode_outer("listed").alias("place", "hash")).where("hash is not null")
            pos = F.col("place") - int(with_document)
            size = F.when(F.col("place") < int(with_document), 0).otherwise(k)
            stream = stream.select("doc_id", "key", "words", pos.alias("pos"), "hash", size.alias("k"))
            one = part.where(F.col("k") == k)
            add(stream, one.unionByName(self_row) if with_document else one)
    return places


def prefix_shingles(shingles: DataFrame, places: DataFrame) -> DataFrame:
    """The rarest shingle of every window that can occur: hash, k, at, item, item_words, wide."""
    seen = places.where("k > 0").groupBy("hash", "k").agg(F.count("*").alias("seen"))
    counted = shingles.join(seen, ["hash", "k"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    first = F.greatest(F.lit(0), F.col("at") - (F.col("wide") - F.col("k")))
    last = F.least(F.col("at"), F.size("item_words") - F.col("wide"))
    starts = counted.select("n", "hash", "k", "at", "seen", F.explode(F.sequence(first, last)).alias("start"))
    rarest = F.row_number().over(Window.partitionBy("n", "start").orderBy("seen", "hash", "at"))
    chosen = starts.withColumn("turn", rarest).where("turn = 1 and seen > 0").select("n", "at").distinct()
    return shingles.join(chosen, ["n", "at"]).drop("n")


def _run(doc_word, item_word, most: Column) -> Column:
    """How many of the next ``most`` words agree."""
    first_miss = F.array_position(F.transform(F.sequence(F.lit(1), most), lambda j: doc_word(j) != item_word(j)), True)
    return F.when(most <= 0, F.lit(0)).otherwise(F.when(first_miss == 0, most).otherwise(first_miss - 1)).cast("int")


def window_hits(places: DataFrame, prefix: DataFrame) -> DataFrame:
    """Runs of document words that windows of an item cover: key, item, begin, end."""
    joined = places.where("k > 0").join(prefix, ["hash", "k"]).withColumn("p", F.col("pos") - F.col("skipped"))
    w, v, p, t, k = (F.col(c) for c in ("around", "item_words", "p", "at", "k"))
    spare = F.col("wide") - k
    left = _run(lambda j: F.get(w, p - j), lambda j: F.get(v, t - j), F.least(p, t, spare))
    right = _run(lambda j: F.get(w, p + k - 1 + j), lambda j: F.get(v, t + k - 1 + j), F.least(F.size(w) - p - k, F.size(v) - t - k, spare))
    same = F.slice(w, p + 1, k) == F.slice(v, t + 1, k)
    runs = joined.where(same).select("key", "item", "wide", "k", "pos", left.alias("left"), right.alias("right"))
    return runs.where("left + k + right >= wide").selectExpr("key", "item", "pos - left as begin", "pos + k + right as end")


def _judged(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    shingles = materialize(item_shingles(benchmark_items(benchmark, item_col, item_text_col)), "item-shingles")
    places = materialize(shingle_places(docs, shingles, id_col, text_col), "shingle-places")
    hits = window_hits(places, materialize(prefix_shingles(shingles, places), "prefix-shingles"))
    # runs of one document: combined on the map side, bounded by its words
    spans = hits.groupBy("key", "begin").agg(F.max("end").alias("end")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    names = hits.select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], acc["upto"]))).cast("bigint").alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    found = spans.select("key", covered.alias("n_hit")).join(
        names.select("key", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", ",").alias("listed")), "key"
    )
    rows = places.where("k = 0").select("key", "doc_id", "n_words")
    none = F.lit(0).cast("bigint")
    out = rows.join(found, "key", "left").select(
        "key",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit when a window of any item occurs over it. A document
    is contaminated when 20 * n_hit >= n_words and n_hit > 0. Null and empty
    texts have no words; items without words have no window; a null item id
    counts as an empty one; item rows with one id are one item. Rows repeat as in
    the input, also with null ids. No documents give no rows, no items give rows
    without hits. Further columns are ignored.
    """
    return _judged(docs, benchmark, id_col, text_col, item_col, item_text_col).drop("key")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not contaminated."""
    judged = _judged(docs, benchmark, id_col, text_col, "item_id", "text")
    gone, key = unique_name(docs, "contaminated_key"), unique_name(docs, "row_key")
    marked = judged.where("contaminated").select(F.col("key").alias(gone)).distinct()
    keyed = docs.withColumn(key, row_key(column(docs, id_col), text_or_empty(docs, text_col)))
    return keyed.join(marked, F.col(key) == F.col(gone), "left_anti").select(*[column(keyed, c) for c in docs.columns])
