"""Token ids as a table of independently coded blocks, in order of document id.

A table is a folder of Parquet files, one shard each, with a row per block:
``shard``, ``block``, ``payload`` (see ``range_coder``) and ``parts``, the pieces
of documents in the block. Shards and blocks in order hold the ids in ascending
document order. Spark writes and commits the files, so a lost executor repeats
its shards only, and any store that Spark reaches will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricewright.llm.ragged import SpanBook, chunks, text_bytes
from pricewright.llm.range_coder import decode_blocks, encode_blocks
from pricewright.llm.tables import column, text_or_empty
from pricewright.llm.token_counts import byte_symbols, gather_spans, pretokens

BLOCK_IDS = 4096
#: Blocks coded side by side in a task, half as many more at the end.
LANES = 1536
#: Pre-tokens a worker remembers between batches; beyond it the most used half, at most, stays.
REMEMBERED = 1 << 19
END = 0
#: The character of the vocabulary for each byte.
SYMBOLS = dict(enumerate(byte_symbols()))

PARTS = "array<struct<doc_id:bigint,row:bigint,begin:bigint,count:bigint,after:bigint>>"
BLOCKS = f"shard int, block int, payload binary, parts {PARTS}"
PART_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "row", "begin", "count", "after")]))


def distinct_spans(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The byte strings that begin at ``starts``, each up to the next, told apart by Arrow."""
    wide = len(data) > np.iinfo(np.int32).max
    edges = np.append(starts, len(data)).astype(np.int64 if wide else np.int32)
    kind = pa.large_binary() if wide else pa.binary()
    return pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()


class Encoder:
    """Ids of texts by the library's model; a pre-token is encoded once as long as it is remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.bits = max(9, int(self.library.get_vocab_size()).bit_length())
        self.book = SpanBook(REMEMBERED)
        #: Where the ids of a pre-token lie in the store, and how many there are.
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)
        #: Batches that had the pre-token.
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pre-tokens that came again, the most used ones, up to half of the memory."""
        keys = list(self.book)
        order = np.argsort(-self.uses, kind="stable")
        order = order[self.uses[order] > 1][: self.book.most // 2]
        n_bytes = np.cumsum([len(keys[k]) for k in order.tolist()])
        kept = order[: np.searchsorted(n_bytes, self.book.most_bytes // 2, side="right")]
        self.book = SpanBook(REMEMBERED)
        self.book.numbers([keys[k] for k in kept.tolist()])
        self.book.take_fresh()
        self.sizes = self.sizes[kept]
        self.store, self.begins = gather_spans(self.store, self.begins[kept], self.sizes)
        # what was used long ago gives way
        self.uses = self.uses[kept] // 2

    def _learn(self, new: list[bytes]) -> None:
        sizes = [len(k) for k in new]
        symbols = b"".join(new).decode("latin-1").translate(SYMBOLS)
        ends = list(accumulate(sizes))
        found = [[t.id for t in self.model.tokenize(symbols[e - n : e])] for e, n in zip(ends, sizes)]
        counts = np.array([len(f) for f in found], np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        begins = len(self.store) + np.cumsum(counts) - counts
        self.store = np.concatenate((self.store, flat))
        self.begins, self.sizes = np.concatenate((self.begins, begins)), np.concatenate((self.sizes, counts))
        self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and the number of each."""
        special = [any(s in t for s in self.specials) for t in texts]
        plain = ["" if x else t for t, x in zip(texts, special)]
        data, starts, owner = pretokens(plain)
        counts = np.zeros(len(texts), np.int64)
        ids = np.zeros(0, np.int32)
        if len(starts):
            if self.book.full():
                self._forget()
            spans = distinct_spans(data, starts)
            numbers = self.book.numbers(spans.dictionary.to_numpy(zero_copy_only=False).tolist())
            if self.book.fresh:
                self._learn(self.book.take_fresh())
            self.uses[numbers] += 1
            each = numbers[spans.indices.to_numpy()]
            sizes = self.sizes[each]
            ids, _ = gather_spans(self.store, self.begins[each], sizes)
            counts = np.bincount(owner, sizes, len(texts)).astype(np.int64)
        if any(special):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(special).tolist():
                parts[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
                counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, counts


def side_by_side(n: int) -> list[tuple[int, int]]:
    """Runs of about ``LANES`` of ``n`` blocks, of one size; a few blocks more cost no run of their own."""
    runs = max(1, round(n / LANES)) if n else 0
    edges = [n * k // runs for k in range(runs + 1)] if runs else []
    return list(zip(edges, edges[1:]))


@lru_cache(2)
def worker_encoder(path: str) -> Encoder:
    return Encoder(path)


def token_blocks(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end: int = END) -> DataFrame:
    """Coded blocks of the ids of all texts, each text followed by ``end``."""
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = named.repartitionByRange(parts, "id").sortWithinPartitions("id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        shard, block, row, total = TaskContext.get().partitionId(), 0, 0, 0
        waiting = np.zeros(0, np.int32)
        pieces: list[tuple] = []  # doc_id, row, begin, count: of the ids that wait

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, pieces, block
            n = -(-len(waiting) // BLOCK_IDS) if last else len(waiting) // BLOCK_IDS // LANES * LANES
            for a, b in side_by_side(n):
                edges = [min(len(waiting), k * BLOCK_IDS) for k in range(a, b + 1)]
                coded = encode_blocks([waiting[x:y] for x, y in zip(edges, edges[1:])], encoder.bits)
                lists = [split(x, y) for x, y in zip(edges, edges[1:])]
                numbers = np.arange(block, block + len(coded), dtype=np.int32)
                block += len(coded)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(coded), shard, np.int32)), pa.array(numbers), pa.array(coded, pa.binary()), pa.array(lists, PART_TYPE)], ["shard", "block", "payload", "parts"]
                )
            done = min(len(waiting), n * BLOCK_IDS)
            base = total - len(waiting)
            waiting = waiting[done:]
            pieces = [p for p in pieces if p[2] + p[3] > base + done]

        def split(x: int, y: int) -> list[dict]:
            nonlocal at
            base, found = total - len(waiting), []
            while at < len(pieces) and pieces[at][2] < base + y:
                doc, r, begin, count = pieces[at]
                a, b = max(begin, base + x), min(begin + count, base + y)
                if b > a:
                    found.append({"doc_id": doc, "row": r, "begin": a, "count": b - a, "after": begin + count - b})
                if begin + count > base + y:
                    break
                at += 1
            return found

        at = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            raw, docs_ = data.tobytes(), batch.column(0).to_pylist()
            for first, last, _, _ in chunks(data, offsets, 1 << 21):
                texts = [raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in range(first, last)]
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end)
                counts = counts + 1
                begins = total + np.cumsum(counts) - counts
                pieces += list(zip(docs_[first:last], range(row, row + last - first), begins.tolist(), counts.tolist()))
                row += last - first
                total += len(ids)
                waiting = np.concatenate((waiting, ids))
                # what is left at the end is then coded with as many others
                if len(waiting) >= (LANES + LANES // 2) * BLOCK_IDS:
                    yield from cut(False)
                    at = 0
        yield from cut(True)

    return ordered.mapInArrow(run, BLOCKS)


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Write the ids of every text in ascending id order (null ids first, ties by text)."""
    token_blocks(docs, tokenizer, id_col, text_col, end).write.parquet(path)


@lru_cache(64)
def _zero_bytes(power: int) -> tuple[tuple[int, ...], ...]:
    """Tables that move a CRC-32 past 2 ** power zero bytes, a byte of it at a time."""

    def by_bits(columns: list[int]) -> tuple[tuple[int, ...], ...]:
        return tuple(tuple(_xor(columns[8 * k + b] for b in range(8) if v >> b & 1) for v in range(256)) for k in range(4))

    if power == 0:
        columns = [1 << b for b in range(32)]
        for _ in range(8):  # one zero bit at a time
            columns = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in columns]
        return by_bits(columns)
    half = _zero_bytes(power - 1)
    return by_bits([_moved(half, _moved(half, 1 << b)) for b in range(32)])


def _xor(values) -> int:
    out = 0
    for v in values:
        out ^= v
    return out


def _moved(tables: tuple[tuple[int, ...], ...], crc: int) -> int:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def crc_before(crc: int, n_bytes: int) -> int:
    """What a CRC-32 adds, by exclusive or, to that of a string that has ``n_bytes`` more after it."""
    power = 0
    while n_bytes:
        if n_bytes & 1:
            crc = _moved(_zero_bytes(power), crc)
        n_bytes >>= 1
        power += 1
    return crc


def read_parts(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """shard, doc_id, row, begin, count, crc and, when asked, ids of each document part.

    ``crc`` is the part's share of the CRC-32 of the whole document's ids: shares
    join by exclusive or, in any order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in side_by_side(batch.num_rows):
                some = batch.slice(a, b - a)
                decoded = decode_blocks(some.column(1).to_pylist())
                out: list[list] = [[] for _ in range(7)]
                for shard, ids, parts in zip(some.column(0).to_pylist(), decoded, some.column(2).to_pylist()):
                    at = 0
                    for p in parts:
                        piece = ids[at : at + p["count"]]
                        at += p["count"]
                        crc = crc_before(zlib.crc32(piece.tobytes()), 4 * p["after"])
                        for column_, value in zip(out, (shard, p["doc_id"], p["row"], p["begin"], p["count"], crc, piece if with_ids else None)):
                            column_.append(value)
                kinds = [pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
                names = ["shard", "doc_id", "row", "begin", "count", "crc", "ids"]
                arrays = [pa.array([v.astype(np.int32) if v is not None and k == 6 else v for v in x], t) for k, (x, t) in enumerate(zip(out, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    stored = spark.read.schema(BLOCKS).parquet(path).select("shard", "payload", "parts")
    return stored.mapInArrow(run, "shard int, doc_id bigint, row bigint, begin bigint, count bigint, crc bigint, ids array<int>")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (with the end id) of every document, from the files."""
    found = _documents(spark, path, read_parts(spark, path, True), F.sort_array(F.collect_list(F.struct("begin", "ids"))).alias("listed"))
    return found.select("doc_id", "start", F.flatten(F.transform("listed", lambda p: p["ids"])).alias("ids"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, from the files.

    The documents' parts combine on the map side; shards get their offsets from
    one row each, taken from the stored parts without decoding again. Rows repeat as written, null ids stay null; texts without
    tokens have their end id; an empty table gives no rows.
    """
    return _documents(spark, path, read_parts(spark, path), F.bit_xor("crc").alias("ids_crc32")).select("doc_id", "start", "n_tokens", "ids_crc32")


def _documents(spark: SparkSession, path: str, parts: DataFrame, *more) -> DataFrame:
    whole = parts.groupBy("shard", "row", "doc_id").agg(F.min("begin").alias("begin"), F.sum("count").alias("n_tokens"), *more)
    # one row per shard; the payload is not read for it
    ends = F.array_max(F.transform("parts", lambda p: p["begin"] + p["count"]))
    sizes = spark.read.schema(BLOCKS).parquet(path).groupBy("shard").agg(F.max(ends).alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return whole.join(F.broadcast(offsets), "shard").withColumn("start", F.col("offset") + F.col("begin"))
