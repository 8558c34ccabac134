"""Near duplicates: n-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its five-word shingles. Texts with one shingle set form a
class; only one member of a class is compared. Every class has ``HASHES``
MinHash values; those that agree in one of ``BANDS`` bands of four values are
candidates (two sets of similarity 0.8 share a band but for 5 in 10^8 pairs).

Classes that share a band are compared inside tasks, in blocks of bounded size,
so no row is made per pair. A pair belongs to the first band in which it agrees
and is looked at there only. MinHash values are compared in rounds: a pair is
dropped once the posterior probability that its similarity reaches the
threshold (uniform prior) is below ``TOLERANCE``. For what is left the shingle
sets are brought and the similarity is computed exactly.

Links are counted per class, and the smallest linked class of each block goes on
as an edge, from which connected components (groups) follow by alternating star
contractions, all as joins and groupings of written tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewright.llm.ragged import chunks, mixed, shingle_sets, text_bytes
from pricewright.llm.tables import column, kept_rows, materialize, numbered, text_digest, text_or_empty

WORDS = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
ROUND = 16
TOLERANCE = 1e-7
#: Members of a block: two blocks are compared in one go, larger buckets in many.
BLOCK = 512
#: Pairs whose MinHash values are compared at a time.
PAIRS = 1 << 17

TEXTS = "doc_id bigint, digest binary, key binary, size int, signature binary"

@lru_cache(1)
def multipliers() -> tuple[np.ndarray, np.ndarray]:
    g = np.random.default_rng(8191)
    return g.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), g.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest element under each of ``HASHES`` orders."""
    a, b = multipliers()
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[k : k + 512, None] * a + b).min(axis=0))
    return (mixed(low) >> np.uint64(48)).astype(np.uint16)


@lru_cache(4)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Matches needed after each round: P(similarity >= threshold | matches) >= tolerance."""
    out = []
    for n in range(ROUND, HASHES + 1, ROUND):
        tail = 0.0
        for m in range(n + 2):  # posterior Beta(m + 1, n - m + 1): a binomial sum
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append(m)
    return tuple(out)


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest of the text, key of the shingle set, its size and signature."""
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            digests, keys, sizes, signatures = [], [], [], []
            for _, _, body, at in chunks(data, offsets):
                raw = body.tobytes()
                for i, s in enumerate(shingle_sets(body, at, WORDS)):
                    digests.append(hashlib.sha256(raw[at[i] : at[i + 1]]).digest())
                    # texts without words are like no other text but their copies
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else digests[-1][:16])
                    sizes.append(len(s))
                    signatures.append(signature(s).tobytes() if len(s) else None)
            arrays = [batch.column(0), pa.array(digests, pa.binary()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "digest", "key", "size", "signature"])

    return named.mapInArrow(run, TEXTS)


def band_rows(classes: DataFrame) -> DataFrame:
    """bucket and band of every class with shingles: ``BANDS`` rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(n, BANDS)
            bands = np.arange(BANDS, dtype=np.uint64)
            buckets = mixed(values * np.uint64(BANDS * 2 + 1) + bands * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(buckets.ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n))],
                ["uid", "bucket", "band"],
            )

    return classes.select("uid", "signature").mapInArrow(run, "uid bigint, bucket bigint, band int")


def block_members(bands: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of every block pair of every bucket that holds at least two classes."""
    crowded = bands.groupBy("bucket", "band").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = bands.join(crowded, ["bucket", "band"]).select("bucket", "band", "uid", blocks.alias("blocks"), F.pmod(F.xxhash64("uid"), blocks).cast("int").alias("mine"))
    pairs = placed.select("bucket", "band", "uid", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return pairs.select(
        "bucket", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "band", "mine", "uid"
    ).join(classes.select("uid", "size", "signature"), "uid")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole block pairs from rows sorted by (bucket, one, two); small ones come many at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows < 4 * BLOCK:
            continue
        names = [rest.column(c).to_numpy() for c in ("bucket", "one", "two")]
        same = np.logical_and.reduce([x[:-1] == x[-1] for x in names])
        last = rest.num_rows - 1
        while last > 0 and same[last - 1]:
            last -= 1
        if last:
            yield rest.slice(0, last)
            rest = rest.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


def _pairs(table: pa.Table, threshold: float, tolerance: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each block pair, owned by their band, that the MinHash values leave."""
    bucket, one, two, band, mine, size = (table.column(c).to_numpy() for c in ("bucket", "one", "two", "band", "mine", "size"))
    sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
    wide = np.ascontiguousarray(sig).view(np.uint64)
    heads = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
    ends = np.append(heads[1:], len(bucket))
    needed = least_matches(threshold, tolerance)

    def left(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        keep &= (one[i] == two[i]) | (mine[i] != mine[j])  # inside a block: in its own pair only
        i, j = i[keep], j[keep]
        first = (wide[i] == wide[j]).argmax(axis=1)
        owned = first == band[i]
        i, j = i[owned], j[owned]
        matches = np.zeros(len(i), np.int32)
        for r, least in enumerate(needed):
            cut = slice(r * ROUND, (r + 1) * ROUND)
            matches += (sig[i, cut] == sig[j, cut]).sum(axis=1, dtype=np.int32)
            alive = matches >= least
            i, j, matches = i[alive], j[alive], matches[alive]
        return i, j

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    many = 0
    for a, b in zip(heads.tolist(), ends.tolist()):
        n = b - a
        step = max(1, PAIRS // n)
        for k in range(0, n, step):
            rows = np.arange(k, min(k + step, n))
            count = n - 1 - rows
            i = np.repeat(rows, count)
            j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + i + 1
            waiting.append((a + i, a + j))
            many += len(i)
            if many >= PAIRS:
                yield left(*(np.concatenate(x) for x in zip(*waiting)))
                waiting, many = [], 0
    if waiting:
        yield left(*(np.concatenate(x) for x in zip(*waiting)))


def candidates(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Members of block pairs that still have a pair: bucket, one, two, band, mine, uid, size, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            used = np.zeros(table.num_rows, bool)
            for i, j in _pairs(table, threshold, tolerance):
                used[i] = True
                used[j] = True
            if used.any():
                yield from table.filter(pa.array(used)).combine_chunks().to_batches()

    return members.mapInArrow(run, members.schema)


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    rows, back = np.unique(np.concatenate((i, j)), return_inverse=True)
    i, j = back[: len(i)], back[len(i) :]
    out = np.zeros(len(i), np.int64)
    if len(i) > 4 * len(rows):
        # many pairs of few sets: products of membership matrices, some shingles at a time
        flat = np.concatenate([sets[r] for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        values, number, times = np.unique(flat, return_inverse=True, return_counts=True)
        common = times[number] > 1
        owner, number = owner[common], (np.cumsum(times > 1) - 1)[number[common]]
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        total = np.zeros((len(rows), len(rows)), np.float32)
        width = 4096
        for k in range(0, int(number[-1]) + 1 if len(number) else 0, width):
            a, b = np.searchsorted(number, (k, k + width))
            block = np.zeros((len(rows), width), np.float32)
            block[owner[a:b], number[a:b] - k] = 1
            total += block @ block.T
        return total[i, j].astype(np.int64)
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = sets[rows[a]], sets[rows[b]]
        at = np.searchsorted(x, y)
        at[at == len(x)] = 0
        out[k] = int((x[at] == y).sum())
    return out


def verified(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """uid, links, root: exact links of each member in a block pair, and the least member it hangs together with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            uid, size = table.column("uid").to_numpy(), table.column("size").to_numpy()
            heads = table.column("bucket").to_numpy(), table.column("one").to_numpy(), table.column("two").to_numpy()
            change = np.logical_or.reduce([h[1:] != h[:-1] for h in heads])
            group = np.concatenate(([0], np.cumsum(change)))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            links, root = np.zeros(len(uid), np.int64), np.arange(len(uid))

            def top(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for i, j in _pairs(table, threshold, tolerance):
                for g in np.unique(group[i]):
                    here = group[i] == g
                    a, b = i[here], j[here]
                    both = _shared(sets, a, b)
                    good = both >= threshold * (size[a] + size[b] - both) - 1e-9
                    a, b = a[good], b[good]
                    np.add.at(links, a, 1)
                    np.add.at(links, b, 1)
                    for x, y in zip(a.tolist(), b.tolist()):
                        x, y = top(x), top(y)
                        if x != y:
                            low, high = (x, y) if uid[x] < uid[y] else (y, x)
                            root[high] = low
            linked = np.flatnonzero(links)
            tops = np.array([top(k) for k in linked.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(uid[linked]), pa.array(links[linked]), pa.array(uid[tops] if len(tops) else np.zeros(0, np.int64))], ["uid", "links", "root"])

    return members.mapInArrow(run, "uid bigint, links bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) edges: node, root (its least node).

    Large-star and small-star steps alternate until the edges no longer change.
    Every step is a grouping and a join over a written table; a node with very
    many neighbours is one skewed key of a join, which adaptive execution splits.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large-star")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = materialize(small.select("e.a", "e.b").where("a <> b").distinct(), "small-star")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def shingle_classes(texts: DataFrame) -> DataFrame:
    """key, uid, lead (its first row: null_id, doc_id, digest), copies, size and signature of each shingle set.

    Classes are numbered in order of their first row's id (null last) and key, so
    ``uid`` is the same however the table is laid out. All rows of a class have
    one size and one signature.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "digest")).alias("lead")
    grouped = texts.groupBy("key").agg(first, F.count("*").alias("copies"), F.first("size").alias("size"), F.first("signature").alias("signature"))
    listed = materialize(grouped, "classes").withColumns({"all": F.lit(0), "null_id": F.col("lead.null_id"), "class_id": F.col("lead.doc_id"), "digest": F.col("lead.digest")})
    return numbered(listed, "all", ["null_id", "class_id", "key"], "uid", "numbered-classes").drop("all", "null_id", "lead")


def near_duplicate_classes(docs: DataFrame, texts: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float) -> DataFrame:
    """key, class_id and digest of its first row, copies, n_links, group_id, first (of its group)."""
    classes = shingle_classes(texts)
    members = classes.where("size > 0").select("uid", "size", "signature")
    bands = band_rows(members)
    order = ["bucket", "one", "two"]
    dealt = block_members(bands, members).repartition(*order).sortWithinPartitions(*order, "uid")
    found = materialize(candidates(dealt, threshold, tolerance), "candidates")
    # the sets of those texts only that still have a partner
    wanted = found.select("uid").distinct()
    sets = shingles_of(docs, classes.select("uid", "class_id", "digest").join(wanted, "uid", "left_semi"), id_col, text_col)
    whole = found.join(sets, "uid").repartition(*order).sortWithinPartitions(*order, "uid")
    links = materialize(verified(whole, threshold, tolerance), "links")
    roots = components(links.select(F.col("uid").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("uid"), "root")
    counted = links.groupBy("uid").agg(F.sum("links").alias("n_links"))
    lead = classes.select(F.col("uid").alias("root"), F.col("class_id").alias("lead"))
    grouped = roots.join(lead, "root")
    named = classes.select("key", "uid", "class_id", "digest", "copies").join(counted, "uid", "left").join(grouped, "uid", "left")
    # the lead of a group may have no id
    return named.select(
        "key", "class_id", "digest", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("root").isNull(), F.col("class_id")).otherwise(F.col("lead")).alias("group_id"),
        (F.col("root").isNull() | (F.col("root") == F.col("uid"))).alias("first"),
    )


def described_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return materialize(described(docs, id_col, text_col), "shingle-signatures")


def shingles_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """uid and sorted shingle hashes of the wanted rows (uid, class_id, digest): one text of each class."""
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body")).withColumn("mine", text_digest(F.col("body")))
    row = F.xxhash64("id", "mine").alias("row")
    theirs = wanted.select("uid", "class_id", "digest", F.xxhash64("class_id", "digest").alias("row"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            values = [s.tobytes() for _, _, body, at in chunks(data, offsets) for s in shingle_sets(body, at, WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["uid", "shingles"])

    texts = named.select("id", "mine", "body", row).join(theirs, "row").where(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("mine") == F.col("digest"))).select("uid", "body")
    return texts.mapInArrow(sets, "uid bigint, shingles binary").dropDuplicates(["uid"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per input row: doc_id, class_id, copies, n_links, group_id.

    A class is the texts with one shingle set, named by its smallest id (null
    only where no row has one); ``n_links`` counts the other classes of
    similarity ``threshold`` or more; ``group_id`` is the class_id of the first
    class of the connected group, in order of class_id (null last) and shingle
    hash. A text of fewer than five words, but not none, is one shingle; texts
    without words (null, empty) are linked to nothing and share a class with
    their copies. The answer is the same in whatever order, files or partitions
    the rows come. Rows repeat as in the input, also with null ids; an empty table
    gives no rows; further columns are ignored.
    """
    texts = described_texts(docs, id_col, text_col)
    classes = near_duplicate_classes(docs, texts, id_col, text_col, threshold, tolerance)
    return texts.select("doc_id", "key").join(classes, "key").select("doc_id", "class_id", "copies", "n_links", "group_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one row of each group of near duplicates.

    Of a group the row of the smallest id stays (null ids last; of one id the
    least text digest; of rows equal in both any one, once). Texts without words
    stay, one of each text. An empty table stays empty.
    """
    texts = described_texts(docs, id_col, text_col)
    classes = near_duplicate_classes(docs, texts, id_col, text_col, threshold, TOLERANCE)
    return kept_rows(docs, classes.where("first").select(F.col("class_id").alias("doc_id"), "digest"), id_col, text_col)
