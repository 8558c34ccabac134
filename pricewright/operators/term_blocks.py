"""Terms on their way through a shuffle: sorted blocks, cut at common bounds and compressed.

N-grams of a corpus mostly occur once, so a row for each of them fills a shuffle, whatever is
summed before it. A block holds the distinct terms of some megabytes of text in byte order, each
written without the start that it shares with the term before. A bucket is a range of terms; its
blocks meet in one task, and there are as many buckets as the text needs for that to stay small.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pricewright.operators.partitioning import keys_together
from pricewright.session import shuffles_removed

# Text of a bucket, and terms of a vocabulary in it.
BUCKET_BYTES = 1 << 21
BUCKET_TERMS = 1 << 18
# Term occurrences that a map task sums before it writes blocks, and their bytes.
BLOCK_TERMS = 3 << 19
BLOCK_BYTES = 1 << 25
# Texts that are asked for bounds, and the bounds' terms of a bucket; bytes of a bound.
BOUND_TEXTS = 32
BOUND_TERMS = 32
BOUND_BYTES = 64
# Longest start that a term leaves to the one before.
SHARED = 255

_BLOCK = "bucket int, size int, shared binary, rest binary, text binary"


def plain_terms(terms: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The terms as one array of bytes, from its first byte on."""
    terms = terms.cast(pa.large_binary())
    chunks = terms.chunks if isinstance(terms, pa.ChunkedArray) else [terms]
    return pa.concat_arrays([*chunks, pa.array([], pa.large_binary())])


def _bytes_of(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of terms."""
    _, offsets, data = terms.buffers()
    ends = np.frombuffer(offsets, np.int64)[terms.offset : terms.offset + len(terms) + 1] if len(terms) else np.zeros(1, np.int64)
    return ends, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def ranked(terms: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms in byte order, and the place of each given term among them."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _shared(ends: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Bytes that each term has in common with the one before, from the first on."""
    lengths = np.diff(ends)
    shared = np.zeros(len(lengths), np.int64)
    open_ = np.arange(1, len(lengths))
    for k in range(SHARED):
        open_ = open_[(lengths[open_] > k) & (lengths[open_ - 1] > k)]
        open_ = open_[data[ends[open_] + k] == data[ends[open_ - 1] + k]]
        if not len(open_):
            break
        shared[open_] = k + 1
    return shared


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def packed_numbers(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, their first bytes first: most of the others are alike."""
    return _packed(values.view(np.uint8).reshape(-1, 8).T)


def unpacked_numbers(packed: bytes, size: int, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * size, "zstd"), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(size)


def blocks(terms: pa.Array, numbers: dict[str, np.ndarray], bounds: list[bytes]) -> pa.RecordBatch:
    """Distinct terms in byte order with numbers of theirs, as one row for each bucket that has some."""
    ends, data = _bytes_of(terms)
    cuts = [0, *(bisect_left(range(len(terms)), b, key=lambda i: terms[i].as_py()) for b in bounds), len(terms)]
    found = [b for b in range(len(cuts) - 1) if cuts[b] < cuts[b + 1]]
    shared = _shared(ends, data)
    shared[[cuts[b] for b in found]] = 0
    rest = np.diff(ends) - shared
    text = data[_ranges(ends[:-1] + shared, rest)]
    at = np.concatenate(([0], np.cumsum(rest)))
    rows: dict[str, list] = {c: [] for c in ("bucket", "size", "shared", "rest", "text", *numbers)}
    for b in found:
        low, high = cuts[b], cuts[b + 1]
        rows["bucket"].append(b)
        rows["size"].append(high - low)
        rows["shared"].append(_packed(shared[low:high].astype(np.uint8)))
        rows["rest"].append(_packed(rest[low:high].astype(np.uint32)))
        rows["text"].append(_packed(text[at[low] : at[high]]))
        for c, values in numbers.items():
            rows[c].append(packed_numbers(values[low:high]))
    kinds = [pa.int32() if c in ("bucket", "size") else pa.binary() for c in rows]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))


def block_terms(row: dict) -> pa.Array:
    """The terms of one block."""
    size = row["size"]
    shared = np.frombuffer(pa.decompress(row["shared"], size, "zstd"), np.uint8).astype(np.int64)
    rest = np.frombuffer(pa.decompress(row["rest"], 4 * size, "zstd"), np.uint32).astype(np.int64)
    lengths = shared + rest
    ends = np.concatenate(([0], np.cumsum(lengths)))
    data = np.empty(ends[-1], np.uint8)
    data[_ranges(ends[:-1] + shared, rest)] = np.frombuffer(pa.decompress(row["text"], int(rest.sum()), "zstd"), np.uint8)
    open_ = np.arange(size)
    for k in range(int(shared.max(initial=0))):
        # a byte left out is that of the last term before that wrote one there
        open_ = open_[lengths[open_] > k]
        wrote = np.maximum.accumulate(np.where(shared[open_] <= k, np.arange(len(open_)), 0))
        left = shared[open_] > k
        data[ends[open_[left]] + k] = data[ends[open_[wrote[left]]] + k]
    return pa.Array.from_buffers(pa.large_binary(), size, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def bucket_number(spark, text_bytes: int, terms: int = 0) -> int:
    return max(spark.sparkContext.defaultParallelism, text_bytes // BUCKET_BYTES, terms // BUCKET_TERMS)


def text_size(texts: DataFrame, text: Column) -> tuple[int, int]:
    """Rows and bytes of a text column."""
    with shuffles_removed(texts.sparkSession):
        rows, size = texts.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return rows, size or 0


def sampled_bounds(texts: DataFrame, text: Column, terms: Callable[[DataFrame], DataFrame], size: tuple[int, int] | None = None) -> list[bytes]:
    """Bounds that cut the terms of all texts into buckets of about equal size.

    ``terms`` makes rows (term, ...) of texts. Bounds are taken from a sample, as a range sort does; they
    decide where terms are counted, not what is counted. ``size`` is that of ``text_size``, if known.
    """
    rows, text_bytes = size or text_size(texts, text)
    buckets = bucket_number(texts.sparkSession, text_bytes)
    share = min(1.0, BOUND_TEXTS * buckets / max(1, rows))
    # about a term for every ten bytes of text and n-gram width
    kept = min(1.0, BOUND_TERMS * buckets / max(1.0, share * text_bytes / 4))
    asked = terms(texts.sample(share, seed=7)).select(F.col("term").cast("binary").alias("term")).sample(kept, seed=7)
    with shuffles_removed(texts.sparkSession):
        found = sorted(bytes(r["term"])[:BOUND_BYTES] for r in asked.collect())
    return sorted({found[len(found) * i // buckets] for i in range(1, buckets)}) if found else []


def _slices(tokens: pa.Array, most: int) -> Iterator[pa.Array]:
    """Rows of token lists in runs of about ``most`` tokens."""
    ends = np.cumsum(tokens.value_lengths().fill_null(0).to_numpy())
    low = 0
    while low < len(tokens):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right")))
        yield tokens.slice(low, high - low)
        low = high


def token_ngrams(tokens: pa.Array, low: int, high: int) -> tuple[pa.Array, np.ndarray]:
    """All n-grams of rows of tokens as terms, and the row of each."""
    rows = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy())
    words = tokens.flatten().cast(pa.large_binary())
    terms, row_of = [pa.array([], pa.large_binary())], [np.empty(0, np.int64)]
    for width in range(low, high + 1):
        starts = np.flatnonzero(rows[: max(0, len(rows) - width + 1)] == rows[width - 1 :])
        parts = [words.take(pa.array(starts + k)) for k in range(width)]
        terms.append(pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())))
        row_of.append(rows[starts])
    return pa.concat_arrays(terms), np.concatenate(row_of)


def counted_ngrams(rows: DataFrame, low: int, high: int, bounds: list[bytes], min_df: int = 1) -> DataFrame:
    """Distinct n-grams of rows (tokens): (bucket, place, term, tf, df), numbered in order within their bucket."""

    def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, dict[str, np.ndarray]]]:
        for batch in batches:
            for tokens in _slices(batch.column(0), BLOCK_TERMS // (high - low + 1)):
                found, row_of = token_ngrams(tokens, low, high)
                terms, place = ranked(found)
                cells = np.unique(row_of * max(1, len(terms)) + place)
                tf = np.bincount(place, minlength=len(terms))
                yield terms, {"tf": tf, "df": np.bincount(cells % max(1, len(terms)), minlength=len(terms))}

    return _added(rows, taken, ("tf", "df"), bounds, min_df, True)


def counted_terms(rows: DataFrame, bounds: list[bytes]) -> DataFrame:
    """Distinct terms of rows (term) and how often they occur: (term, tf)."""

    def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, dict[str, np.ndarray]]]:
        def summed():
            terms, place = ranked(pa.concat_arrays(held))
            return terms, {"tf": np.bincount(place, minlength=len(terms))}

        held: list[pa.Array] = []
        for batch in batches:
            held.append(plain_terms(batch.column(0)))
            if sum(map(len, held)) >= BLOCK_TERMS or sum(x.nbytes for x in held) >= BLOCK_BYTES:
                yield summed()
                held = []
        if held:
            yield summed()

    binary = rows.select(F.col("term").cast("binary").alias("term"))
    return _added(binary, taken, ("tf",), bounds, 1, False).select("term", "tf")


def _added(rows: DataFrame, taken: Callable, names: tuple[str, ...], bounds: list[bytes], min_df: int, ordered: bool) -> DataFrame:
    """Sums of the numbers of each term over the blocks that the map tasks take from their rows."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for terms, numbers in taken(batches):
            if len(terms):
                yield blocks(terms, {c: n.astype(np.int64) for c, n in numbers.items()}, bounds)

    def add(table: pa.Table) -> pa.Table:
        found = [block_terms(r) for b in table.select(["size", "shared", "rest", "text"]).to_batches(64) for r in b.to_pylist()]
        sizes = [len(f) for f in found]
        coded = pa.concat_arrays(found).dictionary_encode()
        del found
        terms, at = coded.dictionary, coded.indices.to_numpy()
        sums = {}
        for c in names:
            parts = [unpacked_numbers(p.as_py(), n) for p, n in zip(table.column(c), sizes)]
            # sums of whole numbers far below 2^53 are exact
            sums[c] = np.bincount(at, np.concatenate(parts), len(terms)).astype(np.int64)
        kept = np.flatnonzero(sums["df"] >= min_df) if min_df > 1 else np.arange(len(terms))
        if ordered:
            kept = kept[pc.sort_indices(terms.take(pa.array(kept))).to_numpy()]
            terms = terms.take(pa.array(kept))
        out = {
            "bucket": pa.array(np.full(len(kept), table.column("bucket")[0].as_py()), pa.int32()),
            "place": pa.array(np.arange(len(kept)), pa.int32()),
            "term": terms.cast(pa.binary()),
        }
        return pa.table(out | {c: pa.array(n[kept]) for c, n in sums.items()})

    written = rows.mapInArrow(write, ", ".join([_BLOCK, *(f"{c} binary" for c in names)]))
    schema = ", ".join(["bucket int, place int, term binary", *(f"{c} long" for c in names)])
    out = keys_together(written, "bucket").groupBy("bucket").applyInArrow(add, schema)
    return out.withColumn("term", F.col("term").cast("string"))


def vocabulary_blocks(terms: DataFrame, bounds: list[bytes]) -> DataFrame:
    """A vocabulary (term, index, idf) as blocks with the numbers ``index`` and ``idf``."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= BUCKET_TERMS or sum(x.nbytes for x in held) >= BLOCK_BYTES:
                yield block(held)
                held = []
        if any(x.num_rows for x in held):
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        names = plain_terms(table.column("term"))
        order = pc.sort_indices(names)
        numbers = {c: table.column(c).take(order).to_numpy() for c in ("index", "idf")}
        return blocks(names.take(order), numbers, bounds)

    rows = terms.select(F.col("term").cast("binary").alias("term"), F.col("index").cast("long").alias("index"), F.coalesce("idf", F.lit(1.0)).alias("idf"))
    return rows.mapInArrow(write, f"{_BLOCK}, index binary, idf binary")


def text_blocks(chunks: DataFrame, low: int, high: int, bounds: list[bytes]) -> DataFrame:
    """The distinct n-grams of each chunk of rows (chunk, tokens), as blocks with their ``chunk``."""

    def write(table: pa.Table) -> pa.Table:
        terms, _ = chunk_terms(table.column("tokens"), low, high)[:2]
        out = pa.Table.from_batches([blocks(terms, {}, bounds)])
        return out.append_column("chunk", pa.array(np.full(len(out), table.column("chunk")[0].as_py()), pa.int64()))

    return chunks.groupBy("chunk").applyInArrow(write, f"{_BLOCK}, chunk long")


def chunk_terms(tokens: pa.ChunkedArray, low: int, high: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct n-grams of a chunk in order, the place of every occurrence among them, and its row."""
    lists = pa.concat_arrays(tokens.chunks) if tokens.num_chunks else pa.array([], pa.list_(pa.string()))
    found, row_of = token_ngrams(lists, low, high)
    return *ranked(found), row_of


def found_terms(asked: DataFrame, known: DataFrame) -> DataFrame:
    """For each block of a chunk the steps between the indices (-1: unknown) of its terms, and their weights."""

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        terms = [block_terms(r) for r in rows]
        sizes = [len(t) for t in terms]
        index, idf = np.full(sum(sizes), -1, np.int64), np.ones(sum(sizes))
        entries = right.to_pylist()
        if rows and entries:
            lookup = pc.SetLookupOptions(value_set=pa.concat_arrays([block_terms(r) for r in entries]))
            at = pc.index_in(pa.concat_arrays(terms), options=lookup).fill_null(-1).to_numpy()
            for out, c, kind in ((index, "index", np.int64), (idf, "idf", np.float64)):
                values = np.concatenate([unpacked_numbers(r[c], r["size"], kind) for r in entries])
                out[at >= 0] = values[at[at >= 0]]
        cuts = np.cumsum([0, *sizes])
        pairs = list(zip(cuts, cuts[1:]))
        out = {
            "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "size": pa.array(sizes, pa.int32()),
            "steps": pa.array([packed_numbers(np.diff(index[a:b], prepend=0)) for a, b in pairs], pa.binary()),
            "idf": pa.array([packed_numbers(idf[a:b]) for a, b in pairs], pa.binary()),
        }
        return pa.table(out)

    schema = "chunk long, bucket int, size int, steps binary, idf binary"
    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(find, schema)
