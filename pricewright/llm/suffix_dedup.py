"""Repeated substrings: distributed prefix doubling over sampled positions, then exact bounds.

Every ``length``-byte string that starts at two places is found, and the bytes it
covers are removed. The steps:

1. Equal texts are one text; a text with copies is covered whole. Distinct texts
   are dealt by id once and kept on the executors' disks, so that later joins by
   text id move no text.
2. Positions are sampled by content: the leftmost smallest hash of 16 bytes in
   each window of ``SPREAD`` positions. Equal strings have equal samples, at most
   ``SPREAD`` bytes apart. The piece up to the next sample is a phrase.
3. Prefix doubling over samples: Spark sorts the phrases, then the pairs of ranks
   at offsets of 1, 2, 4, ... samples, and ranks anew. A sample whose pair is
   unique is dropped if what was compared lies in every string that the sample
   stands for; one whose comparison has passed that bound goes on.
4. Starts are settled exactly. The starts before a sample (at most ``SPREAD``) are
   cut into aligned cells of 128, 8 and 1. A cell is covered when the union of its
   strings occurs again, and settled as not covered when their common part does
   not; the others are cut further, with one partner of each kind that they may
   still match. Strings are compared by two independent 64-bit hashes.

Nothing is gathered per key: keys are counted with map-side combination and
joined back, and lists are collected per text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from pricewright.llm.ragged import ALL_VALUE, chunks, mixed, powers
from pricewright.llm.tables import column, map_batches, materialize, text_or_empty

LENGTH = 400
SPREAD = 128
GRAM = 16
LEVELS = 6
#: Widths of the cells of starts, from a sample's whole range to a single start.
CELLS = (128, 8, 1)

OTHER_VALUE = np.random.default_rng(20240302).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def text_rows(docs: DataFrame, id_col: str, text_col: str, salt: int) -> DataFrame:
    """doc_id, uid (64 bits of the salted digest), digest, n of every row."""
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = [t.encode() for t in batch.column(1).to_pylist()]
        digests = [hashlib.sha256(b).digest() for b in bodies]
        arrays = [batch.column(0), pa.array([text_uid(d, salt) for d in digests], pa.int64()), pa.array(digests, pa.binary()), pa.array([len(b) for b in bodies], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "uid", "digest", "n"])

    return map_batches(named, run, "doc_id bigint, uid bigint, digest binary, n bigint")


def text_uid(digest: bytes, salt: int) -> int:
    return int.from_bytes(hashlib.sha256(digest + salt.to_bytes(4, "little")).digest()[:8], "little", signed=True)


def distinct_texts(docs: DataFrame, text_col: str, length: int, salt: int) -> DataFrame:
    """uid and compressed bytes of the texts of ``length`` bytes or more, dealt by uid.

    Each task sends a text once, so that copies do not gather.
    """
    bodies = docs.select(text_or_empty(docs, text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            uids, packed = [], []
            for text in batch.column(0).to_pylist():
                body = text.encode()
                if len(body) >= length:
                    uid = text_uid(hashlib.sha256(body).digest(), salt)
                    if uid not in sent:
                        sent.add(uid)
                        uids.append(uid)
                        packed.append(pack.compress(body))
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(packed, pa.binary())], ["uid", "packed"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bodies.mapInArrow(run, "uid bigint, packed binary").repartition(parts, "uid").dropDuplicates(["uid"]).persist(StorageLevel.DISK_ONLY)


def unpacked(column_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    bodies = [unpack.decompress(x) for x in column_.to_pylist()]
    return np.frombuffer(b"".join(bodies), np.uint8), np.concatenate(([0], np.cumsum([len(b) for b in bodies], dtype=np.int64)))


def running_hash(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hash of any span [start, end) of the values, in constant time."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return lambda start, end: mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def samples(body: np.ndarray, offsets: np.ndarray, length: int, spread: int):
    """Sampled positions of texts laid end to end.

    Arrays: text index, position, number in its text, hash of its phrase, spans
    to the 1st, 2nd, 4th ... next sample (255: further), and the least and most
    bytes by which a start lies before the sample (255: no start).
    """
    h = ALL_VALUE[body]
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    bits = np.uint64(max(1, int(len(body)).bit_length()))
    least = (mixed(h) >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width < spread:
        step = min(width, spread - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    q = np.arange(len(at))
    text = np.searchsorted(offsets, q, side="right") - 1
    inside = q + (spread + GRAM - 1) <= offsets[text + 1]
    q, at, text = q[inside], at[inside], text[inside]
    first = np.ones(len(q), bool)
    first[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(first)
    low, high = q[run], q[np.append(run[1:], len(q)) - 1] if len(run) else q[run]
    at, text = at[run], text[run]
    high = np.minimum(high, offsets[text + 1] - length)
    starts = low <= high
    dmin, dmax = np.where(starts, at - high, 255), np.where(starts, at - low, 255)
    n = len(at)
    head = np.searchsorted(text, text)
    number = np.arange(n) - head
    end = np.searchsorted(text, text, side="right")
    phrase = np.zeros(n, np.uint64)
    spans = np.full((n, LEVELS), 255, np.int64)
    for level in range(LEVELS):
        there = np.arange(n) + (1 << level)
        ok = there < end
        spans[ok, level] = np.minimum(255, at[there[ok]] - at[ok])
    has_next = spans[:, 0] < 255
    if has_next.any():
        where = np.flatnonzero(has_next)
        phrase[where] = running_hash(ALL_VALUE[body])(at[where], at[where + 1] + GRAM)
    return text, at - offsets[text], number, phrase, spans, dmin, dmax


SAMPLES = "uid bigint, place bigint, phrase bigint, info bigint"


def sample_rows(texts: DataFrame, length: int, spread: int) -> DataFrame:
    """uid, place (position and number), phrase hash, info (spans, dmin, dmax) of every sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy()
            data, offsets = unpacked(batch.column(1))
            for first, _, body, at in chunks(data, offsets):
                text, pos, number, phrase, spans, dmin, dmax = samples(body, at, length, spread)
                info = dmin | dmax << 8
                for level in range(LEVELS):
                    info |= spans[:, level] << (16 + 8 * level)
                arrays = [uids[first + text], pos << 32 | number, phrase.view(np.int64), info]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["uid", "place", "phrase", "info"])

    return texts.mapInArrow(run, SAMPLES)


def span_at(level: int):
    return F.shiftrightunsigned("info", 16 + 8 * level).bitwiseAND(F.lit(255))


def reranked(pairs: DataFrame, *keys: str) -> DataFrame:
    """Ranks of the keys that occur more than once: their places in sorted order."""
    twice = pairs.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return materialize(twice.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def doubled(texts: DataFrame, length: int, spread: int) -> DataFrame:
    """Samples whose surroundings occur again: uid, pos, dmin, dmax."""
    # what follows a sample by less than this lies in every string it stands for
    bound = length - spread - GRAM - spread + 1
    rows = sample_rows(texts, length, spread)
    starts = F.col("info").bitwiseAND(F.lit(255)) < 255
    found = rows.where(starts & (span_at(0) > bound)).select("uid", "place", "info")
    active = rows.where(span_at(0) <= bound)
    ranks = reranked(active, "phrase")
    ranked = materialize(active.join(ranks, "phrase").select("uid", "place", "info", "rank"), "ranked")
    done = [found]
    for level in range(1, LEVELS):
        done.append(ranked.where(starts & (span_at(level) > bound)).select("uid", "place", "info"))
        ahead = F.lit((1 << (level - 1)))
        number = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
        mine = ranked.withColumn("number", number)
        theirs = ranked.select(F.col("uid").alias("uid2"), (number - ahead).alias("number2"), F.col("rank").alias("next"))
        pairs = mine.where(span_at(level) <= bound).join(theirs, (F.col("uid") == F.col("uid2")) & (F.col("number") == F.col("number2")))
        pairs = materialize(pairs.select("uid", "place", "info", F.col("rank").alias("here"), "next"), "rank-pairs")
        if pairs.isEmpty():
            break
        ranked = materialize(pairs.join(reranked(pairs, "here", "next"), ["here", "next"]).select("uid", "place", "info", "rank"), "ranked")
    else:
        done.append(ranked.where(starts).select("uid", "place", "info"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    low = F.lit(255)
    return out.select(
        "uid",
        F.shiftright("place", 32).alias("pos"),
        F.col("info").bitwiseAND(low).alias("dmin"),
        F.shiftright("info", 8).bitwiseAND(low).alias("dmax"),
    )


CELL_ROWS = "uid bigint, pos bigint, low int, high int, weight int, done boolean, i1 bigint, i2 bigint, u1 bigint, u2 bigint"
JOBS = "array<struct<pos:bigint,low:int,high:int,weight:int,done:boolean>>"


def cell_rows(texts: DataFrame, jobs: DataFrame, length: int, width: int) -> DataFrame:
    """Aligned cells of ``width`` starts of every job, with hashes of their common part (i) and their union (u), zero where not wanted."""
    listed = jobs.groupBy("uid").agg(F.collect_list(F.struct("pos", "low", "high", "weight", "done")).alias("jobs"))
    joined = texts.join(listed, "uid").select("uid", "packed", "jobs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = unpacked(batch.column(1))
            lists = batch.column(2)
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(lists)), counts)
            pos, low, high, weight = (flat.field(k).to_numpy() for k in range(4))
            done = flat.field(4).to_numpy(zero_copy_only=False)
            for first, last, body, at in chunks(data, offsets):
                a, b = np.searchsorted(owner, (first, last))
                if a == b:
                    continue
                lowest, most = low[a:b] // width, high[a:b] // width
                n = (most - lowest + 1).astype(np.int64)
                row = np.repeat(np.arange(a, b), n)
                cell = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lowest, n)
                c_low, c_high = np.maximum(low[row], cell * width), np.minimum(high[row], cell * width + width - 1)
                here = at[owner[row] - first] + pos[row]
                spans = [(here - cell * width, here - cell * width - width + 1 + length), (here - c_high, here - c_low + length)]
                hashes = []
                for values in (ALL_VALUE, OTHER_VALUE):
                    of = running_hash(values[body])
                    # for single starts the union is the common part: kept once; else one hash of the common part will do
                    wanted = (width == 1 or not hashes, width > 1)
                    hashes.append([of(s, e).view(np.int64) if w else np.zeros(len(s), np.int64) for w, (s, e) in zip(wanted, spans)])
                arrays = [
                    pa.array(batch.column(0).to_numpy()[owner[row]]), pa.array(pos[row], pa.int64()), pa.array(c_low.astype(np.int32)), pa.array(c_high.astype(np.int32)),
                    pa.array(weight[row]), pa.array(done[row]), *[pa.array(hashes[v][s]) for s in (0, 1) for v in (0, 1)],
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["uid", "pos", "low", "high", "weight", "done", "i1", "i2", "u1", "u2"])

    return joined.mapInArrow(run, CELL_ROWS)


def covered_starts(texts: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """Runs of starts whose strings occur elsewhere: uid, begin, end (of the bytes they cover)."""
    jobs = candidates.select("uid", "pos", F.col("dmin").cast("int").alias("low"), F.col("dmax").cast("int").alias("high"), F.lit(1).alias("weight"), F.lit(False).alias("done"))
    found = None
    # the common part only tells cells that go on: texts that share its hash by chance are told apart by single starts
    kind = ["i1", "low", "high", "u1", "u2"]
    for width in CELLS[:-1]:
        rows = materialize(cell_rows(texts, jobs, length, width).drop("i2"), f"cells-{width}")
        unions = rows.groupBy(*kind).agg(F.sum("weight").alias("n_union"), F.min("uid").alias("one"))
        cores = unions.groupBy("i1").agg(F.sum("n_union").alias("n_core"), F.max(F.col("n_union") == 1).alias("open"))
        judged = rows.join(unions.join(cores, "i1"), kind)
        again = F.col("n_union") > 1
        judged = materialize(
            judged.where(~F.col("done") & again | (F.col("n_core") > 1) & F.col("open")).select("uid", "pos", "low", "high", "done", again.alias("again"), "one", "open"), f"judged-{width}"
        )
        settled = settled_bytes(judged.where("again and not done"), length)
        found = settled if found is None else found.unionByName(settled)
        # unsettled cells, and one member of each repeated union that they may match
        jobs = judged.where("open and (not again or uid = one)").select(
            "uid", "pos", "low", "high", F.when(F.col("again"), 2).otherwise(1).alias("weight"), (F.col("again") | F.col("done")).alias("done")
        )
    # a single start's common part is its union: its own count settles it
    singles = materialize(cell_rows(texts, jobs, length, CELLS[-1]).select("uid", "pos", "low", "high", "weight", "done", "i1", "i2"), "starts")
    twice = singles.groupBy("i1", "i2").agg(F.sum("weight").alias("n")).where("n > 1").select("i1", "i2")
    settled = settled_bytes(singles.where("not done").select("uid", "pos", "low", "high", "i1", "i2").join(twice, ["i1", "i2"]), length)
    return settled if found is None else found.unionByName(settled)


def settled_bytes(cells: DataFrame, length: int) -> DataFrame:
    """The bytes that the strings of covered cells cover."""
    return cells.select("uid", (F.col("pos") - F.col("high")).alias("begin"), (F.col("pos") - F.col("low") + length).alias("end"))


def removed_bytes(texts: DataFrame, covered: DataFrame) -> DataFrame:
    """uid, n_removed, n_spans, kept digest, spans of every text with covered bytes."""
    listed = covered.groupBy("uid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = texts.join(listed, "uid").select("uid", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, runs, kept, spans = [], [], [], []
            lists = batch.column(2)
            edges = lists.offsets.to_numpy()
            flat = lists.flatten()
            begins, ends = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            for k, packed in enumerate(batch.column(1).to_pylist()):
                body = unpack.decompress(packed)
                order = np.argsort(begins[edges[k] - edges[0] : edges[k + 1] - edges[0]], kind="stable")
                b = begins[edges[k] - edges[0] : edges[k + 1] - edges[0]][order]
                e = np.maximum.accumulate(ends[edges[k] - edges[0] : edges[k + 1] - edges[0]][order])
                new = np.concatenate(([True], b[1:] > e[:-1]))
                b, e = b[new], e[np.append(np.flatnonzero(new)[1:], len(e)) - 1]
                left, digest = 0, hashlib.sha256()
                for x, y in zip(b.tolist(), e.tolist()):
                    digest.update(body[left:x])
                    left = y
                digest.update(body[left:])
                removed.append(int((e - b).sum()))
                runs.append(len(b))
                kept.append(digest.digest())
                spans.append([{"begin": x, "end": y} for x, y in zip(b.tolist(), e.tolist())])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            arrays = [batch.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["uid", "n_removed", "n_spans", "kept", "spans"])

    return joined.mapInArrow(run, "uid bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<begin:bigint,end:bigint>>")


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Spans are the maximal runs of bytes covered by a ``length``-byte string that
    also starts anywhere else, in the same text or another; all is judged on the
    input. Null and empty texts and texts shorter than ``length`` lose nothing;
    repeated rows are copies of each other and lose all from ``length`` bytes on.
    Null ids stay null; an empty table gives no rows; further columns are
    ignored. A worker holds about 100 bytes per byte of its longest text.
    """
    if not 2 * spread + GRAM < length:
        raise ValueError("length is more than twice spread, and 16 bytes")
    salt = 0
    while True:  # two texts with one uid are as good as impossible; if there are any, others are drawn
        rows = materialize(text_rows(docs, id_col, text_col, salt), "text-rows")
        if rows.select("uid", "digest").distinct().groupBy("uid").count().where("count > 1").isEmpty():
            break
        salt += 1
    texts = distinct_texts(docs, text_col, length, salt)
    candidates = materialize(doubled(texts, length, spread), "doubled")
    covered = covered_starts(texts, candidates, length)
    cut = materialize(removed_bytes(texts, covered), "removed")
    texts.unpersist()
    copies = rows.groupBy("uid").agg(F.count("*").alias("copies"))
    whole = (F.col("copies") > 1) & (F.col("n") >= length)
    none = F.lit(0).cast("bigint")
    everything = F.array(F.struct(none.alias("begin"), F.col("n").alias("end")))
    nothing = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    empty_digest = F.lit(hashlib.sha256(b"").digest())
    return rows.join(copies, "uid").join(cut, "uid", "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.lower(F.hex(F.when(whole, empty_digest).otherwise(F.coalesce("kept", "digest")))).alias("kept_sha256"),
        F.when(whole, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
    )
