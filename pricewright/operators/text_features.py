"""Vocabularies, bag of words, TF-IDF, dimension reduction and lexicon sentiment."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pricewright.functions.constants import constant_lookup, in_constant
from pricewright.functions.let import let, spread
from pricewright.functions.text import ngrams, tokenize, vector_tokens
from pricewright.operators.lookup import lookup_join
from pricewright.operators.partitioning import keys_together
from pricewright.operators.reshape import ngrams_long
from pricewright.operators.select import price_tails
from pricewright.operators.term_blocks import (
    bucket_number, chunk_terms, counted_ngrams, found_terms, sampled_bounds, text_blocks, text_size, token_ngrams, unpacked_numbers,
    vocabulary_blocks,
)
from pricewright.operators.windows import number_rows, top_k_per_group
from pricewright.session import COMPACT, fresh_path, materialize, shuffles_removed
from pricewright.vocab import BOOSTERS, NEGATIONS, PLACEHOLDER

# Most frequent terms, of bounded length, that every task holds; all others are joined by a shuffle.
HOT_TERMS = 1 << 14
HOT_BYTES = 128
# Widest matrix whose covariance is solved in one place by the built-in PCA.
DENSE_COVARIANCE = 1024
BLOCK_ROWS = 2048
# Texts whose terms are looked up together: their bytes and rows.
CHUNK_BYTES = 1 << 21
CHUNK_ROWS = 1 << 14


def term_array(text: Column, ngram_range: tuple[int, int] = (1, 1)) -> Column:
    low, high = ngram_range
    return let(vector_tokens(text), lambda t: F.concat(*[ngrams(t, n) for n in range(low, high + 1)]))


def term_counts(text: Column, ngram_range: tuple[int, int] = (1, 1)) -> Column:
    """Distinct terms of a text with their counts, in order of the term; counted inside the row."""

    def runs(ordered: Column) -> Column:
        heads = F.transform(ordered, lambda t, i: F.when(F.coalesce(F.get(ordered, i - 1) != t, F.lit(True)), i))
        return let(
            F.filter(heads, lambda i: i.isNotNull()),
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(ordered, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(ordered)) - i).cast("bigint").alias("tf")
                ),
            ),
        )

    return let(F.sort_array(term_array(F.coalesce(text, F.lit("")), ngram_range)), runs)


def doc_terms(df: DataFrame, key: str, text: str, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """Long bag of words (key, term, tf), one row per distinct term of a row; nothing is shuffled."""
    return spread(df, [key], term_counts(F.col(text), ngram_range), "e").select(key, "e.term", "e.tf")


def vocabulary(
    df: DataFrame, text: str, ngram_range: tuple[int, int] = (1, 1), min_df: int = 1, max_features: int | None = None
) -> DataFrame:
    """Terms with corpus frequency and document frequency.

    The first occurrence in a text is flagged on the sorted term array, so both
    counts come from one aggregate keyed by term alone. N-grams, which mostly
    occur once, are shuffled in blocks. ``max_features`` keeps the most frequent
    terms, equal ones in alphabetical order.
    """
    if ngram_range[1] > 1:
        counted = _counted_in_order(df, text, ngram_range, min_df).select("term", "tf", "df")
    else:
        counted = _counted_words(df, text, ngram_range).where(F.col("df") >= min_df)
    if max_features is not None:
        counted = counted.orderBy(F.desc("tf"), "term").limit(max_features)
    return counted


def _counted_words(df: DataFrame, text: str, ngram_range: tuple[int, int]) -> DataFrame:
    def flag_first(ordered: Column) -> Column:
        return F.transform(
            ordered,
            lambda t, i: F.struct(t.alias("term"), F.coalesce(F.get(ordered, i - 1) != t, F.lit(True)).alias("first")),
        )

    flagged = spread(df, [], let(F.sort_array(term_array(F.col(text), ngram_range)), flag_first), "e")
    return flagged.select("e.term", "e.first").groupBy("term").agg(F.count("*").alias("tf"), F.count_if("first").alias("df"))


def _counted_in_order(df: DataFrame, text: str, ngram_range: tuple[int, int], min_df: int) -> DataFrame:
    """Terms as (bucket, place, term, tf, df), numbered in order within ranges of terms."""

    def terms(texts: DataFrame) -> DataFrame:
        return spread(texts, [], term_array(F.col(text), ngram_range), "term")

    bounds = sampled_bounds(df, F.col(text), terms)
    return counted_ngrams(df.select(vector_tokens(F.col(text)).alias("tokens")), *ngram_range, bounds, min_df)


def smooth_idf(df: Column, documents: Column | int) -> Column:
    n = documents if isinstance(documents, Column) else F.lit(documents)
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + F.lit(1.0)


def tfidf_long(
    df: DataFrame,
    key: str,
    text: str,
    ngram_range: tuple[int, int] = (1, 1),
    min_df: int = 1,
    max_features: int | None = None,
) -> DataFrame:
    """Long TF-IDF (key, term, tf, weight) with L2-normalised rows, for vocabularies of any size."""
    rows = materialize(df.select(key, term_counts(F.col(text), ngram_range).alias("entries")), "document-terms")
    cells = rows.select(key, F.explode("entries").alias("e")).select(key, "e.term", "e.tf")
    counted = cells.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    if max_features is not None:
        counted = counted.orderBy(F.desc("total"), "term").limit(max_features)
    documents = rows.count()
    weights = materialize(counted.select("term", "df", smooth_idf(F.col("df"), documents).alias("idf")), "term-weights")
    weighted = join_terms(cells, weights).withColumn("w", F.col("tf") * F.col("idf"))
    # the cells of one text are few enough to stand in one window
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "tf", (F.col("w") / norm).alias("weight"))


def join_terms(cells: DataFrame, terms: DataFrame) -> DataFrame:
    """Cells whose term is in the table (term, df, ...), with the table's other columns.

    The most frequent terms, which would be the hot keys of a join, are sent to
    every task: their number and length are bounded. The rest is a shuffle join.
    ``cells`` are read twice, so they should come from a written table.
    """
    short = terms.where(F.octet_length("term") <= HOT_BYTES)
    hot = materialize(short.orderBy(F.desc("df"), "term").limit(HOT_TERMS), "hot-terms")
    names = [c for c in terms.columns if c not in ("term", "df")]
    marked = F.broadcast(hot.drop("df"))
    found = cells.join(marked, "term")
    rest = cells.join(F.broadcast(hot.select("term")), "term", "left_anti")
    rare = terms.join(F.broadcast(hot.select("term")), "term", "left_anti").drop("df")
    columns = [*cells.columns, *names]
    return found.select(*columns).unionByName(rest.join(rare, "term").select(*columns))


def ngram_counts(
    df: DataFrame, columns: list[str], low: float, high: float, price: str = "sold_price", keep: str = "alpha"
) -> DataFrame:
    """N-gram counts and mean price in both price tails, per text feature and n-gram kind."""
    tails = price_tails(df.select(*columns, price), low, high, price)
    occurrences = ngrams_long(tails, columns, price, keep, ("tail",)).where(F.col("value") != PLACEHOLDER)
    keys = ["text_feature", "ngram", "tail", "value"]
    return keys_together(occurrences, *keys).groupBy(*keys).agg(
        F.count("*").alias("count"), F.avg(price).alias("mean")
    )


def top_ngrams(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k_per_group(counts, ["text_feature", "ngram", "tail"], "value", k)


def sentiment(
    text: Column,
    lexicon: dict[str, float],
    negations=NEGATIONS,
    boosters: dict[str, float] | None = None,
    placeholder: str = PLACEHOLDER,
) -> Column:
    """Lexicon sentiment in [-1, 1]; text that is absent or a placeholder scores 0.

    A valence is strengthened or weakened by a booster among the three words
    before it (less with distance) and turned by -0.74 after a negation. The
    words of a text are scored inside its row; nothing is exploded or shuffled.
    """
    boosters = BOOSTERS if boosters is None else boosters

    def score(words: Column) -> Column:
        def valence_of(word: Column, i: Column) -> Column:
            before = [F.when(i >= d, F.get(words, i - d)) for d in (1, 2, 3)]
            push, turned = F.lit(0.0), F.lit(False)
            for other, share in zip(before, (1.0, 0.95, 0.9)):
                push = push + F.coalesce(constant_lookup(other, boosters, "double"), F.lit(0.0)) * F.lit(share)
                turned = turned | in_constant(other, negations)
            return let(
                constant_lookup(word, lexicon, "double"),
                lambda v: F.when(v.isNull(), 0.0).otherwise(
                    (v + F.when(v < 0, -push).otherwise(push)) * F.when(turned, F.lit(-0.74)).otherwise(F.lit(1.0))
                ),
            )

        return F.aggregate(F.transform(words, valence_of), F.lit(0.0), lambda acc, x: acc + x)

    compound = let(let(tokenize(text), score), lambda s: s / F.sqrt(s * s + F.lit(15.0)))
    return F.when(text.isNull() | (text == placeholder), F.lit(0.0)).otherwise(compound)


def lexicon_sentiment(df: DataFrame, text: str, lexicon: dict[str, float], output: str = "sentiment", **rules) -> DataFrame:
    return df.withColumn(output, sentiment(F.col(text), lexicon, **rules))


class BagOfWords:
    """Count or TF-IDF vectors over a vocabulary learned from a text column."""

    def __init__(
        self,
        weighting: str = "count",
        ngram_range: tuple[int, int] = (1, 1),
        min_df: int = 1,
        max_features: int | None = None,
    ):
        if weighting not in ("count", "tfidf"):
            raise ValueError(f"no vectorizer {weighting!r}: choose 'count' or 'tfidf'")
        self.weighting = weighting
        self.ngram_range = tuple(ngram_range)
        self.min_df = min_df
        self.max_features = max_features

    def fit(self, df: DataFrame, text: str) -> "BagOfWordsModel":
        documents = df.count() if self.weighting == "tfidf" else None
        idf = smooth_idf(F.col("df"), documents) if documents is not None else F.lit(None).cast("double")
        columns = ["term", F.col("index").cast("int").alias("index"), "df", idf.alias("idf")]
        if self.ngram_range[1] > 1 and self.max_features is None:
            # counted in ranges of terms: their sizes are all that is missing for an index
            stored = materialize(_counted_in_order(df, text, self.ngram_range, self.min_df).drop("tf"), "vocabulary", compact=True)
            before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
            sizes = stored.groupBy("bucket").agg(F.count("*").alias("__rows"))
            shift = materialize(sizes.select("bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift")), "shifts")
            numbered = stored.join(F.broadcast(shift), "bucket").withColumn("index", F.col("place") + F.col("__shift"))
            terms = numbered.select(*columns)
        else:
            counted = vocabulary(df, text, self.ngram_range, self.min_df, self.max_features)
            terms = materialize(number_rows(counted.select("term", "df"), ["term"], "index").select(*columns), "vocabulary")
        size = terms.count()
        if not size:
            raise ValueError(f"column {text!r} holds no term that occurs often enough")
        return BagOfWordsModel(text, self.ngram_range, terms, size, self.weighting)


class BagOfWordsModel:
    """A vocabulary as a written table (term, index, df, idf), of any size; indices follow the order of the terms."""

    def __init__(self, text: str, ngram_range: tuple[int, int], terms: DataFrame, size: int, weighting: str):
        self.text, self.ngram_range, self.terms, self.size, self.weighting = text, tuple(ngram_range), terms, size, weighting

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        """Sparse vectors of a text column. A null text counts as empty; texts without a known term get the zero vector.

        A vocabulary that every task can hold is looked up beside the row, and nothing is shuffled.
        """
        long_terms = F.octet_length("term") > HOT_BYTES
        if self.size <= HOT_TERMS and self.terms.where(long_terms).isEmpty():
            return self._looked_up(df, output)
        return self._joined(df, output)

    def _looked_up(self, df: DataFrame, output: str) -> DataFrame:
        """Each row's terms are counted in Arrow batches against the whole vocabulary, a bounded number of short terms."""
        known = self.terms.orderBy("index").select("term", "idf").collect()
        idf = np.array([r["idf"] for r in known]) if self.weighting == "tfidf" else None
        shared = df.sparkSession.sparkContext.broadcast(([r["term"] for r in known], idf))

        low, high = self.ngram_range

        @F.arrow_udf(VectorUDT())
        def vectors(texts: pa.Array) -> pa.Array:
            terms, idf = shared.value
            n, size, tokens = len(texts), len(terms), texts.flatten()
            lookup = pc.SetLookupOptions(value_set=pa.array(terms, pa.string()))
            text_of = np.repeat(np.arange(n), texts.value_lengths().to_numpy())
            cells = [np.empty(0, dtype=np.int64)]
            for width in range(low, high + 1):
                starts = np.flatnonzero(text_of[: max(0, len(tokens) - width + 1)] == text_of[width - 1 :])
                grams = pc.binary_join_element_wise(*[tokens.take(pa.array(starts + k)) for k in range(width)], " ")
                found = pc.index_in(grams, options=lookup).fill_null(-1).to_numpy()
                cells.append((text_of[starts] * size + found)[found >= 0])
            cells, counts = np.unique(np.concatenate(cells), return_counts=True)
            row_of, index = np.divmod(cells, size)
            return _sparse_rows(n, size, row_of, index, counts, None if idf is None else idf[index])

        tokens = vector_tokens(F.coalesce(F.col(self.text).cast("string"), F.lit("")))
        kept = [F.col(f"`{c}`") for c in df.columns if c != output]
        # not deterministic: readers of a part of the vector must not make it again
        return df.select(*kept, vectors.asNondeterministic()(tokens).alias(output))

    def _joined(self, df: DataFrame, output: str) -> DataFrame:
        """Vectors over a vocabulary of any size.

        The rows are written once. Chunks of them send their distinct terms, in blocks, to the ranges of
        the vocabulary, and the indices return to the chunks, which count their rows' terms again.
        """
        (low, high), size, weighted = self.ngram_range, self.size, self.weighting == "tfidf"
        # fields of a vector pass as they are
        plain = [F.unwrap_udt(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.UserDefinedType) else F.col(f"`{f.name}`") for f in df.schema]
        text = F.coalesce(F.col(f"`{self.text}`").cast("string"), F.lit(""))
        rows = materialize(df.select(*plain, F.monotonically_increasing_id().alias("__row")), "text-rows", compact=True)
        count, text_bytes = text_size(rows, text)
        chunks = max(1, text_bytes // CHUNK_BYTES, count // CHUNK_ROWS)
        own = F.octet_length(text) > CHUNK_BYTES
        number = F.when(own, -1 - F.col("__row")).otherwise(F.pmod(F.xxhash64("__row"), F.lit(chunks)))
        # texts are shuffled and sorted, not their tokens
        dealt = keys_together(rows.withColumn("chunk", number), "chunk").sortWithinPartitions("chunk", "__row")

        def terms(texts: DataFrame) -> DataFrame:
            return spread(texts, [], term_array(text, self.ngram_range), "term")

        step = -(-size // bucket_number(df.sparkSession, text_bytes, size))
        known = self.terms.where((F.col("index") % step == 0) & (F.col("index") > 0)).select(F.col("term").cast("binary")).collect()
        bounds = sorted({*sampled_bounds(rows, text, terms, (count, text_bytes)), *(bytes(r[0]) for r in known)})
        asked = text_blocks(dealt.select("chunk", vector_tokens(text).alias("tokens")), low, high, bounds)
        places = materialize(found_terms(asked, vocabulary_blocks(self.terms, bounds)), "text-places")

        names = [c for c in df.columns if c != output]
        stored = T.StructType([f for f in rows.schema if f.name in names]).add(output, VectorUDT().sqlType())
        shape = to_arrow_schema(stored)

        def vectors(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return shape.empty_table()
            distinct, place, row_of = chunk_terms(left.column("__tokens"), low, high)
            found = sorted(right.to_pylist(), key=lambda r: r["bucket"])
            index = np.concatenate([np.empty(0, np.int64), *(np.cumsum(unpacked_numbers(r["steps"], r["size"])) for r in found)])
            idf = np.concatenate([np.empty(0), *(unpacked_numbers(r["idf"], r["size"], np.float64) for r in found)])
            cells, counts = np.unique(row_of * max(1, len(distinct)) + place, return_counts=True)
            row_of, place = np.divmod(cells, max(1, len(distinct)))
            is_known = index[place] >= 0
            row_of, place, counts = row_of[is_known], place[is_known], counts[is_known]
            cells = _sparse_rows(len(left), size, row_of, index[place], counts, idf[place] if weighted else None)
            return pa.table([*(left.column(c) for c in names), cells], [*names, output]).cast(shape)

        told = dealt.select(*[F.col(f"`{c}`") for c in names], "chunk", vector_tokens(text).alias("__tokens"))
        made = told.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInArrow(vectors, stored)
        path = fresh_path(df.sparkSession, "text-vectors")
        with shuffles_removed(df.sparkSession):
            made.write.options(**COMPACT).parquet(path)
        schema = T.StructType([f for f in df.schema if f.name in names]).add(output, VectorUDT())
        return df.sparkSession.read.schema(schema).parquet(path)

    def described(self) -> dict:
        """All but the table, in a form that JSON holds."""
        return {"text": self.text, "ngram_range": list(self.ngram_range), "size": self.size, "weighting": self.weighting}

    @staticmethod
    def of(terms: DataFrame, data: dict) -> "BagOfWordsModel":
        return BagOfWordsModel(data["text"], tuple(data["ngram_range"]), terms, data["size"], data["weighting"])


def _sparse_rows(n: int, size: int, row_of: np.ndarray, index: np.ndarray, counts: np.ndarray, idf: np.ndarray | None) -> pa.Array:
    """The fields of ``n`` sparse vectors from cells in order of row and index; weighted ones have length 1."""
    values = counts.astype(float)
    if idf is not None:
        values *= idf
        values /= np.sqrt(np.bincount(row_of, values * values, n))[row_of]
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row_of, minlength=n)))), pa.int32())
    fields = {
        "type": pa.array(np.zeros(n), pa.int8()),
        "size": pa.array(np.full(n, size), pa.int32()),
        "indices": pa.ListArray.from_arrays(ends, pa.array(index, pa.int32())),
        "values": pa.ListArray.from_arrays(ends, pa.array(values)),
    }
    return pa.StructArray.from_arrays(list(fields.values()), list(fields))


def vector_cells(df: DataFrame, key: str, column: str, model: BagOfWordsModel | None = None) -> DataFrame:
    """Non-zero cells of sparse vectors as rows (key, index, value), or with a model (key, term, value)."""
    raw = F.unwrap_udt(F.col(column))
    cells = df.select(key, F.explode(F.arrays_zip(raw["indices"].alias("index"), raw["values"].alias("value"))).alias("c"))
    cells = cells.select(key, F.col("c").getField("index").alias("index"), F.col("c").getField("value").alias("value"))
    if model is None:
        return cells
    return lookup_join(cells, model.terms.select("index", "term"), "index", rows=model.size).select(key, "term", "value")


def _csr(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = batch["indices"].map(len).to_numpy()
    row_of = np.repeat(np.arange(len(batch)), sizes)
    columns = np.concatenate([*batch["indices"].to_numpy(), np.empty(0, dtype=np.int64)]).astype(np.int64)
    values = np.concatenate([*batch["values"].to_numpy(), np.empty(0)]).astype(float)
    return row_of, columns, values


def _gram_times(sparse: DataFrame, basis: np.ndarray) -> np.ndarray:
    """(A'A) basis for the sparse rows A, one pass over the data.

    Every task multiplies its own rows and emits its share in blocks of basis
    rows; the blocks are added in two rounds, so no task adds up more than about
    the square root of all shares.
    """
    width, rank = basis.shape
    shared = sparse.sparkSession.sparkContext.broadcast(basis)

    def multiply(batches):
        total = np.zeros((width, rank))
        some = False
        for batch in batches:
            if len(batch) == 0:
                continue
            some = True
            row_of, columns, values = _csr(batch)
            # one basis column at a time: no array of cells x rank is held
            for j in range(rank):
                product = np.bincount(row_of, values * shared.value[columns, j], len(batch))
                total[:, j] += np.bincount(columns, values * product[row_of], width)
        if some:
            # the task number keeps the shares in place when a task is run again
            salt = TaskContext.get().partitionId()
            for block, start in enumerate(range(0, width, BLOCK_ROWS)):
                yield pd.DataFrame(
                    {"block": [block], "salt": [salt], "data": [total[start : start + BLOCK_ROWS].tobytes()]}
                )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d) for d in group["data"])
        return pd.DataFrame(
            {"block": [group["block"].iloc[0]], "salt": [group["salt"].iloc[0]], "data": [total.tobytes()]}
        )

    schema = "block int, salt long, data binary"
    partial = sparse.mapInPandas(multiply, schema)
    fan = max(1, int(sparse.rdd.getNumPartitions() ** 0.5))
    first = partial.withColumn("salt", F.col("salt") % fan).groupBy("block", "salt").applyInPandas(add, schema)
    blocks = first.withColumn("salt", F.lit(0).cast("long")).groupBy("block", "salt").applyInPandas(add, schema).collect()
    shared.unpersist()
    out = np.zeros((width, rank))
    for row in blocks:
        part = np.frombuffer(row["data"]).reshape(-1, rank)
        out[row["block"] * BLOCK_ROWS : row["block"] * BLOCK_ROWS + len(part)] = part
    return out


def principal_components(
    df: DataFrame, column: str, k: int, passes: int = 6, oversample: int = 10, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, column means) of centred sparse vectors.

    Narrow matrices use the built-in PCA. Wide ones use subspace iteration: each
    pass multiplies the covariance with a thin basis, centring included, so
    neither the covariance nor the data is ever held in one place. The vectors are
    kept between the passes.
    """
    df = df.select(column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _components(df, column, k, passes, oversample, seed)
    finally:
        df.unpersist()


def _components(
    df: DataFrame, column: str, k: int, passes: int, oversample: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    first = df.select(F.unwrap_udt(F.col(column))["size"].alias("w"), F.size(vector_to_array(column)).alias("n")).first()
    width = first["w"] or first["n"]
    rows, mean = df.agg(F.count("*"), Summarizer.mean(F.col(column))).first()
    mean = mean.toArray()
    k = min(k, width, max(1, rows - 1))
    if width <= DENSE_COVARIANCE:
        model = PCA(k=k, inputCol=column, outputCol="__pc").fit(df)
        return model.pc.toArray(), mean
    raw = F.unwrap_udt(F.col(column))
    sparse = df.select(raw["indices"].alias("indices"), raw["values"].alias("values"))
    rank = min(width, k + oversample)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, rank)))[0]

    def covariance_times(b: np.ndarray) -> np.ndarray:
        return (_gram_times(sparse, b) - rows * np.outer(mean, mean @ b)) / max(1, rows - 1)

    for _ in range(passes):
        basis = np.linalg.qr(covariance_times(basis))[0]
    small = basis.T @ covariance_times(basis)
    values, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    return basis @ turned[:, order], mean


class Reduce:
    """Principal components of a vector column."""

    def __init__(self, k: int = 100, method: str = "pca"):
        if method != "pca":
            raise ValueError(f"no reducer {method!r}: choose 'pca'")
        self.k = k

    def fit(self, df: DataFrame, column: str) -> "ReduceModel":
        components, mean = principal_components(df, column, self.k)
        # a component is defined up to its sign; make its largest entry positive
        largest = np.abs(components).argmax(axis=0)
        components = components * np.sign(components[largest, np.arange(components.shape[1])])
        return ReduceModel(components, mean @ components)


class ReduceModel:
    def __init__(self, components: np.ndarray, offset: np.ndarray):
        self.components, self.offset = components, offset

    @property
    def k(self) -> int:
        return self.components.shape[1]

    def transform(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Project rows and subtract the projected mean, so the result is centred."""
        raw = F.unwrap_udt(F.col(column))
        shared = df.sparkSession.sparkContext.broadcast((self.components, self.offset))

        @F.pandas_udf("array<double>")
        def project(indices: pd.Series, values: pd.Series) -> pd.Series:
            components, offset = shared.value
            batch = pd.DataFrame({"indices": indices, "values": values})
            row_of, columns, weights = _csr(batch)
            # one component at a time: no array of cells x components is held
            parts = [np.bincount(row_of, weights * c[columns], len(batch)) for c in components.T]
            return pd.Series(list(np.column_stack(parts) - offset))

        # a dense vector stores no indices: every position is present
        indices = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.size(raw["values"]) - 1))
        return df.withColumn(output, array_to_vector(project(indices, raw["values"])))

    def table(self) -> DataFrame:
        """One row per vocabulary index with its weights, and the projected mean as the row after the last."""
        rows = [(i, [float(x) for x in r]) for i, r in enumerate(np.vstack((self.components, self.offset)))]
        return SparkSession.active().createDataFrame(rows, "index int, weights array<double>")

    @staticmethod
    def of(table: DataFrame) -> "ReduceModel":
        rows = np.array([r["weights"] for r in table.orderBy("index").collect()])
        return ReduceModel(rows[:-1], rows[-1])
