"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens by array operations on their code points. The
distinct pre-tokens of a batch are held as one ragged array of symbols; in each
round every pre-token merges its lowest-ranked pair, all at once, until no pair
has a rank. The surviving symbols are counted and summed per text.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewright.llm.ragged import SpanBook, chunks, span_strings, text_bytes
from pricewright.llm.tables import column, map_batches, text_or_empty

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
NO_RANK = np.iinfo(np.int64).max
#: Bytes from which a run merges on its own, with links; the counts are the same.
LONG_RUN = 512
#: Pre-tokens a worker remembers between batches; beyond it the memory starts anew.
REMEMBERED = 1 << 20
#: Contractions of the pre-tokenizer pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White_Space beyond those of the general category Z.
SPACES = (9, 10, 11, 12, 13, 0x85)


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
        elif kind == "Z":
            table[c] = SPACE
    table[list(SPACES)] = SPACE
    return table


def pretoken_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens begin, for texts laid end to end.

    Follows the pattern: contractions; letters, numbers or others with one
    optional blank in front; white space, of which the last character is left to
    what follows it.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = character_classes()[codes]
    first = np.zeros(n + 1, bool)  # begins a text; n ends the last
    first[text_starts] = True
    first[n] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= first[:n]
    space = kind == SPACE
    starts = change.copy()
    # the last white space of a run that another class follows: a blank joins it, others stand alone
    last_space = np.zeros(n, bool)
    last_space[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    starts |= last_space
    after = np.flatnonzero(last_space) + 1
    glued = after[codes[after - 1] == 32]
    starts[glued] = False
    # contractions: an apostrophe that begins a pre-token and is not glued to a blank
    quotes = np.flatnonzero((codes == 39) & starts)
    for mark in CONTRACTIONS:
        if not len(quotes):
            break
        length = len(mark)
        fits = quotes[quotes + length <= n]
        for k in range(1, length):
            fits = fits[(codes[fits + k] == ord(mark[k])) & ~first[fits + k]]
        ends = fits + length
        inside = np.concatenate([fits + k for k in range(1, length)]) if len(fits) else fits
        starts[inside] = False
        ends = ends[ends < n]
        # what follows begins anew, unless it is the glued rest of another pre-token
        starts[ends] = True
        quotes = np.setdiff1d(quotes, fits, assume_unique=True)
    return np.flatnonzero(starts)


class Merges:
    """Merge ranks of a byte-level BPE vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 20 | right
        self.left, self.right, self.made_by = left, right, made
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours, ``NO_RANK`` where it never merges."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NO_RANK)

    def count(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Symbols left of each byte run that begins at ``starts``.

        All short runs merge together, one rank of each a round. A round over a
        long run would touch all its symbols for a few merges; such runs merge
        on their own, each round touching the places of its rank only.
        """
        sizes = np.diff(np.append(starts, len(data)))
        counts, long = np.zeros(len(starts), np.int64), sizes > LONG_RUN
        for i in np.flatnonzero(long).tolist():
            counts[i] = self.count_long(data[starts[i] : starts[i] + sizes[i]])
        if long.any():
            data, starts = gather_spans(data, starts[~long], sizes[~long])
        if len(starts):
            counts[~long] = self.count_short(data, starts)
        return counts

    def count_long(self, data: np.ndarray) -> int:
        """Symbols left of one run: places are kept by rank, neighbours by links."""
        symbols, n = self.of_byte[data], len(data)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive, left = np.ones(n, bool), n
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def enter(places: np.ndarray) -> None:
            places = places[after[places] < n]
            rank = self.ranks(symbols[places], symbols[after[places]])
            places, rank = places[rank != NO_RANK], rank[rank != NO_RANK]
            by = np.argsort(rank, kind="stable")
            places, rank = places[by], rank[by]
            edges = np.flatnonzero(np.diff(rank)) + 1
            for r, some in zip(rank[np.concatenate(([0], edges))].tolist() if len(rank) else (), np.split(places, edges)):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(order, r)
                waiting[r].append(some)

        enter(np.arange(n - 1))
        while order:
            r = heapq.heappop(order)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[alive[places] & (symbols[places] == self.left[r]) & (after[places] < n)]
            places = places[symbols[after[places]] == self.right[r]]
            if not len(places):
                continue
            # of overlapping places, every second one
            heads = np.concatenate(([True], after[places[:-1]] != places[1:]))
            turn = np.arange(len(places))
            places = places[(turn - np.maximum.accumulate(np.where(heads, turn, 0))) % 2 == 0]
            gone = after[places]
            symbols[places], alive[gone], after[places] = self.made_by[r], False, after[gone]
            inner = places[after[places] < n]
            before[after[inner]] = inner
            left -= len(places)
            touched = np.concatenate((places, before[places]))
            enter(np.unique(touched[touched >= 0]))
        return left

    def count_short(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(starts), np.int64)
        symbols = self.of_byte[data]
        owner = np.zeros(len(data), np.int64)
        owner[starts[1:]] = 1
        owner = np.cumsum(owner)
        while len(symbols):
            same = owner[1:] == owner[:-1]
            keys = symbols[:-1] << 20 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = same & (self.keys[at] == keys)
            rank = np.where(known, self.rank[at], NO_RANK)
            heads = np.flatnonzero(np.concatenate(([True], ~same)))
            best = np.minimum.reduceat(np.append(rank, NO_RANK), heads)
            # the pair after a run's last symbol belongs to no run: it has no rank
            run = np.cumsum(np.concatenate(([0], (~same).astype(np.int64))))
            done = best == NO_RANK
            if done.any():
                sizes = np.diff(np.append(heads, len(symbols)))
                counts[owner[heads[done]]] = sizes[done]
                live = ~done[run]
                symbols, owner = symbols[live], owner[live]
                if not len(symbols):
                    break
                rank, run = np.append(rank, NO_RANK)[live][:-1], run[live]
                at = np.append(at, 0)[live][:-1]
                best_of = best[run[:-1]]
            else:
                best_of = best[run[:-1]]
            hit = (rank == best_of) & (rank != NO_RANK)
            hit = _alternate(hit)
            where = np.flatnonzero(hit)
            symbols[where] = self.made[at[where]]
            stay = np.ones(len(symbols), bool)
            stay[where + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return counts


def _alternate(hit: np.ndarray) -> np.ndarray:
    """Of overlapping hits (neighbours), keep the first, third, ... of each run."""
    doubled = hit[1:] & hit[:-1]
    if not doubled.any():
        return hit
    index = np.arange(len(hit))
    begins = hit.copy()
    begins[1:] &= ~hit[:-1]
    start = np.maximum.accumulate(np.where(begins, index, 0))
    return hit & ((index - start) % 2 == 0)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, extra = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in shown:
            shown[b] = chr(extra)
            extra += 1
    return [shown[b] for b in range(256)]


@lru_cache(2)
def merges(path: str) -> Merges:
    return Merges(path)


def split_specials(texts: list[str], specials: list[str]) -> tuple[list[str], list[int], list[int]]:
    """Texts cut at special strings: pieces, text index of each piece, specials found per text."""
    pieces, owner, found = [], [], []
    for i, text in enumerate(texts):
        parts, n = [text], 0
        for s in specials:
            if s in text:
                n += sum(p.count(s) for p in parts)
                parts = [q for p in parts for q in p.split(s)]
        pieces += parts
        owner += [i] * len(parts)
        found.append(n)
    return pieces, owner, found


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, byte start of each pre-token, text index of each pre-token."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    text_starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    starts = pretoken_starts(codes, text_starts[lengths > 0])
    width = 1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int64) + (codes > 0xFFFF)
    at = np.concatenate(([0], np.cumsum(width)))
    data = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    owner = np.searchsorted(text_starts + 0, starts, side="right") - 1
    return data, at[starts], owner


def gather_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the chosen spans laid end to end, and where each begins."""
    begins = np.concatenate(([0], np.cumsum(sizes)))
    index = np.arange(begins[-1]) + np.repeat(starts - begins[:-1], sizes)
    return data[index], begins[:-1]


class Counter:
    """Counts pre-tokens, remembering a bounded number of them by their bytes."""

    def __init__(self, path: str):
        self.merges = merges(path)
        self._forget()

    def _forget(self) -> None:
        self.book = SpanBook(REMEMBERED)
        self.count_of = np.zeros(0, np.int64)

    def counts(self, texts: list[str]) -> np.ndarray:
        pieces, owner, found = split_specials(texts, self.merges.specials)
        total = np.array(found, np.int64)
        data, starts, piece = pretokens(pieces)
        if len(starts):
            if self.book.full():
                self._forget()
            numbers = self.book.numbers(span_strings(data, starts))
            new = self.book.take_fresh()
            if new:
                sizes = np.array([len(k) for k in new], np.int64)
                counted = self.merges.count(np.frombuffer(b"".join(new), np.uint8), np.cumsum(sizes) - sizes)
                self.count_of = np.concatenate((self.count_of, counted))
            np.add.at(total, np.array(owner)[piece], self.count_of[numbers])
        return total


@lru_cache(2)
def worker_counter(path: str) -> Counter:
    return Counter(path)


def text_token_counts(column_: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text of an Arrow column."""
    data, offsets = text_bytes(column_)
    counter = worker_counter(path)
    tokens = np.zeros(len(offsets) - 1, np.int64)
    raw = data.tobytes()
    for a, b, _, _ in chunks(data, offsets, 1 << 20):
        texts = [raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in range(a, b)]
        tokens[a:b] = counter.counts(texts)
    return np.diff(offsets), tokens


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a byte-level BPE file, readable on every
    executor. Null and empty texts have no tokens; special strings inside texts
    are single tokens. Rows repeat as in the input and null ids stay null; an
    empty table gives no rows; further columns are ignored. Narrow: nothing is
    shuffled. A worker holds about 60 bytes per byte of its longest text, and at
    most ``REMEMBERED`` pre-token counts.
    """
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_bytes, n_tokens = text_token_counts(batch.column(1), tokenizer)
        arrays = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens"])

    rows = map_batches(named, counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
