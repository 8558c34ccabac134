"""Nearest neighbours without a cross join: exact, or approximate by random projections.

Training rows are grouped into cells around pivot vectors. The triangle
inequality tells which cells can hold one of a query's k nearest rows, and only
those are compared. Neighbouring cells make up slices of bounded size, and the
queries that ask for a slice are dealt over blocks of bounded size, so a cell of
many copies spreads over many tasks and a row is sent once to each block it meets.
Inside a task one matrix product finds the rows that may be among the k nearest;
their distances are then computed directly. Each slice returns k rows per query
instead of all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pricewright.session import materialize

MAX_PIVOTS = 256
#: Queries that a task compares with a slice in one matrix product, at most.
BLOCK = 256
#: Rows of a slice, and of the queries that one task compares with it, at most; wide vectors take fewer.
SLICE_ROWS, SLICE_BYTES = 8192, 1 << 25
#: Columns from which the first bound on the k-th distance is taken.
BOUND_COLUMNS = 1024
#: Rows of the sample from which a bucket length is taken, and how many of them are asked.
SAMPLE_ROWS, SAMPLE_ASKED = 1000, 100


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), len(pivots)))
    for j, p in enumerate(pivots):
        gap = points - p
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _short(near: np.ndarray, asked: np.ndarray, matrix: np.ndarray, k: int, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that hold every pair of the k nearest rows, out of the allowed ones.

    Squared distances come from one product. They are off by rounding alone, which
    the slack covers; values that squares cannot hold are left to the direct form.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 16 * (matrix.shape[1] + 8) * np.finfo(float).eps * (np.einsum("ij,ij->i", asked, asked) + near.max(initial=0))
    if len(near) <= k or not np.isfinite(slack).all():
        return np.nonzero(np.ones((len(asked), len(near)), dtype=bool) if allowed is None else allowed)
    gap = (asked * -2.0) @ matrix.T
    gap += near
    if allowed is not None:
        gap[~allowed] = np.inf
    some = max(k, min(len(near), BOUND_COLUMNS))
    bound = np.partition(gap[:, :some], k - 1, axis=1)[:, k - 1]
    far = np.flatnonzero(np.isinf(bound))
    if len(far) and some < len(near):
        bound[far] = np.partition(gap[far], k - 1, axis=1)[:, k - 1]
    within = gap <= (bound + slack)[:, None]
    return np.nonzero(within if allowed is None else within & allowed)


def _best(asked: np.ndarray, matrix: np.ndarray, near: np.ndarray, keys: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """(queries, rows, distances) of the k nearest rows of each query, equal distances by key."""
    at, of = _short(near, asked, matrix, k, allowed)
    d = np.empty(len(at))
    step = max(1, SLICE_BYTES // (8 * max(1, matrix.shape[1])))
    for start in range(0, len(at), step):
        part = slice(start, start + step)
        gap = matrix[of[part]] - asked[at[part]]
        d[part] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    order = np.lexsort((keys[of], d, at))
    at, of, d = at[order], of[order], d[order]
    first = np.searchsorted(at, at, side="left")
    kept = np.arange(len(at)) - first < k
    return at[kept], of[kept], d[kept]


def _vectors(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    kind = df.schema[vector].dataType
    plain = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    return df.select(F.col(key).alias(name), (F.col(vector) if plain else F.col(vector).cast("array<double>")).alias("v"))


def _slice_rows(width: int) -> int:
    return max(1, min(SLICE_ROWS, SLICE_BYTES // (8 * max(1, width))))


class _Slices:
    """Training rows in cells around pivots, and neighbouring cells together in slices of bounded size."""

    def __init__(self, train: DataFrame, key: str, vector: str, k: int):
        train = _vectors(train, key, vector, "t")
        # of equal vectors only the k smallest keys can be among k nearest rows; the
        # limit is applied in every task before the shuffle, so hot copies stay cheap
        copies = Window.partitionBy("v").orderBy("t")
        once = train.withColumn("__copy", F.row_number().over(copies)).where(F.col("__copy") <= k).drop("__copy")
        self.train = materialize(once, "neighbour-rows")
        rows = self.train.count()
        wanted = int(min(MAX_PIVOTS, max(1, rows**0.5 / 2)))
        picked = self.train.orderBy(F.md5(F.col("t").cast("string"))).limit(wanted).select("v").collect()
        if not picked:
            raise ValueError("no training rows")
        points = np.array([r["v"] for r in picked], dtype=float)
        self.pivots = train.sparkSession.sparkContext.broadcast(points)
        pivots = self.pivots

        def to_cells(batches):
            for batch in batches:
                if len(batch):
                    d = _distances(_stack(batch["v"]), pivots.value)
                    cell = d.argmin(axis=1)
                    yield batch.assign(cell=cell.astype("int32"), d=d[np.arange(len(d)), cell])

        fields = [T.StructField("cell", T.IntegerType()), T.StructField("d", T.DoubleType())]
        celled = self.train.mapInPandas(to_cells, T.StructType(self.train.schema.fields + fields))
        stats = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).orderBy("cell").collect()
        self.cells = np.array([s["cell"] for s in stats])
        self.sizes = np.array([s["n"] for s in stats])
        self.radii = np.array([s["r"] for s in stats])
        self.limit = _slice_rows(points.shape[1])
        self._pack(points)
        firsts, counts = ([int(x) for x in y] for y in (self.firsts, self.counts))
        by_cell = dict(zip(self.cells.tolist(), zip(firsts, counts)))
        first, count = (F.array(*[F.lit(by_cell.get(c, (0, 1))[i]) for c in range(len(points))]) for i in (0, 1))
        own = F.pmod(F.xxhash64("t"), F.element_at(count, F.col("cell") + 1).cast("long")).cast("int")
        self.rows = celled.select("t", "v", (F.element_at(first, F.col("cell") + 1) + own).alias("slice"))

    def _pack(self, points: np.ndarray) -> None:
        """The first slice and the number of slices of each cell; a chain of near pivots fills a slice."""
        left, chain, at = set(range(len(self.cells))), [], 0
        while left:
            left.discard(at)
            chain.append(at)
            if left:
                rest = np.array(sorted(left))
                gap = points[self.cells[rest]] - points[self.cells[at]]
                at = int(rest[np.einsum("ij,ij->i", gap, gap).argmin()])
        self.firsts, self.counts = np.zeros(len(self.cells), dtype=int), np.ones(len(self.cells), dtype=int)
        used, open_rows = 0, None
        for c in chain:
            n = int(self.sizes[c])
            if n > self.limit:
                self.firsts[c], self.counts[c] = used, -(-n // self.limit)
                used, open_rows = used + int(self.counts[c]), None
            elif open_rows is not None and open_rows + n <= self.limit:
                self.firsts[c], open_rows = used - 1, open_rows + n
            else:
                self.firsts[c], used, open_rows = used, used + 1, n
        self.number = used

    def compare(self, listed: DataFrame, local, schema: T.StructType) -> DataFrame:
        """``local(rows, queries)`` for every slice and the queries (q, v, ..., slice) listed for it, block by block."""
        asked = {r["slice"]: r["n"] for r in listed.groupBy("slice").agg(F.count("*").alias("n")).collect()}
        blocks = {s: -(-n // self.limit) for s, n in asked.items()}
        spark = listed.sparkSession
        table = spark.createDataFrame([(int(s), int(n)) for s, n in blocks.items()], "slice int, blocks int")
        # one short row per slice
        left = self.rows.join(F.broadcast(table), "slice").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        right = listed.join(F.broadcast(table), "slice").withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks").cast("long")).cast("int"))
        part, tasks = ["slice", "block"], max(1, min(4096, sum(blocks.values())))
        # a number of tasks of their own: few bytes stand for much work
        left, right = (x.drop("blocks").repartition(tasks, *part) for x in (left, right))
        return left.groupBy(*part).cogroup(right.groupBy(*part)).applyInPandas(local, schema)


def _pairs_schema(train: DataFrame, train_key: str, query: DataFrame, query_key: str) -> T.StructType:
    return T.StructType(
        [T.StructField("q", query.schema[query_key].dataType), T.StructField("t", train.schema[train_key].dataType), T.StructField("distance", T.DoubleType())]
    )


def _pairs(found: list[tuple]) -> pd.DataFrame:
    q, t, d = (np.concatenate([f[i] for f in found]) if found else [] for i in range(3))
    return pd.DataFrame({"q": q, "t": t, "distance": d})


def nearest(
    train: DataFrame,
    query: DataFrame,
    k: int = 5,
    train_key: str = "id",
    query_key: str = "query_id",
    vector: str = "vector",
    block: int = BLOCK,
) -> DataFrame:
    """The k nearest training rows of each query row: (query_key, train_key, distance, rank)."""
    schema = _pairs_schema(train, train_key, query, query_key)
    slices = _Slices(train, train_key, vector, k)
    query = _vectors(query, query_key, vector, "q")
    pivots, cells, sizes, radii, firsts, counts = slices.pivots, slices.cells, slices.sizes, slices.radii, slices.firsts, slices.counts

    def to_candidates(batches):
        for batch in batches:
            if not len(batch):
                continue
            d = _distances(_stack(batch["v"]), pivots.value[cells])
            reach = d + radii
            order = reach.argsort(axis=1)
            enough = (np.cumsum(sizes[order], axis=1) >= k).argmax(axis=1)
            short = sizes.sum() < k
            bound = np.take_along_axis(reach, order, axis=1)[np.arange(len(d)), enough]
            bound = np.full(len(d), np.inf) if short else bound * (1 + 1e-9) + 1e-12
            listed = []
            for row, limit in zip(d, bound):
                of = np.flatnonzero(row - radii <= limit)
                runs = [np.arange(firsts[c], firsts[c] + counts[c]) for c in of]
                listed.append(np.unique(np.concatenate(runs)).astype("int32") if runs else np.empty(0, dtype="int32"))
            yield batch.assign(slices=listed)

    fields = [T.StructField("slices", T.ArrayType(T.IntegerType()))]
    listed = query.mapInPandas(to_candidates, T.StructType(query.schema.fields + fields)).select("q", "v", F.explode("slices").alias("slice"))
    step = max(1, min(block, BLOCK))

    def local(points: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(asking):
            matrix, keys, asked, names = _stack(points["v"]), points["t"].to_numpy(), _stack(asking["v"]), asking["q"].to_numpy()
            with np.errstate(over="ignore"):
                near = np.einsum("ij,ij->i", matrix, matrix)
            for start in range(0, len(asked), step):
                at, of, d = _best(asked[start : start + step], matrix, near, keys, k)
                found.append((names[start + at], keys[of], d))
        return _pairs(found)

    w = Window.partitionBy("q").orderBy("distance", "t")
    ranked = slices.compare(listed, local, schema).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_key), F.col("t").alias(train_key), "distance", "rank")


def suggested_bucket(train: DataFrame, k: int, train_key: str = "id", vector: str = "vector") -> float:
    """The shift of a projection that a k-th neighbour causes: its median distance over the root of the dimensions.

    Taken inside a sample of at most ``SAMPLE_ROWS`` rows (the first by MD5 of the key).
    A sample is sparser than the table, so the distance is on the large side: it
    costs pairs, not recall.
    """
    picked = train.orderBy(F.md5(F.col(train_key).cast("string"))).limit(SAMPLE_ROWS).select(F.col(vector).cast("array<double>")).collect()
    points = np.array([r[0] for r in picked], dtype=float)
    if len(points) < 2:
        return 1.0
    asked = points[:SAMPLE_ASKED]
    gaps = np.sqrt(np.maximum(0, (asked**2).sum(1)[:, None] + (points**2).sum(1) - 2 * asked @ points.T))
    gaps.sort(axis=1)  # the first is the row itself
    # projections go onto unit vectors, which see one dimension's share of a distance
    return float(np.median(gaps[:, min(k, len(points) - 1)])) / points.shape[1] ** 0.5 or 1.0


def _hashed(df: DataFrame, directions: np.ndarray, bucket_length: float) -> DataFrame:
    """The rows with their bucket in every table."""

    def hashes(batches):
        for batch in batches:
            if len(batch):
                codes = np.floor(_stack(batch["v"]) @ directions / bucket_length).clip(-(2.0**62), 2.0**62)
                yield batch.assign(h=list(codes.astype("int64")))

    return df.mapInPandas(hashes, T.StructType(df.schema.fields + [T.StructField("h", T.ArrayType(T.LongType()))]))


def candidate_pairs(
    train: DataFrame,
    query: DataFrame,
    train_key: str,
    query_key: str,
    vector: str,
    bucket_length: float,
    tables: int,
    seed: int = 42,
    k: int | None = None,
    counted: bool = False,
) -> DataFrame:
    """Pairs (q, t, distance) that share a bucket in one of the tables of random projections.

    With ``k`` each slice gives the k nearest of a query's pairs only. ``counted``
    gives rows (q, pairs) that add up to the number of pairs, which are then never
    rows themselves. A query goes to the slices whose range of buckets holds its
    own in some table; which pairs share a bucket is settled there, in blocks.
    """
    schema = _pairs_schema(train, train_key, query, query_key)
    # a repeated row makes no pair of its own
    train, query = train.select(train_key, vector).distinct(), query.select(query_key, vector).distinct()
    # copies of a vector under other keys count as pairs; only the nearest need no more than k of each
    slices = _Slices(train, train_key, vector, (1 << 31) - 1 if k is None else k)
    width = slices.pivots.value.shape[1]
    directions = np.random.default_rng(seed).standard_normal((width, tables))
    directions /= np.sqrt((directions**2).sum(axis=0))
    slices.rows = _hashed(slices.rows, directions, bucket_length)
    bounds = [f(F.col("h")[i]) for i in range(tables) for f in (F.min, F.max)]
    ranges = slices.rows.groupBy("slice").agg(F.array(*bounds).alias("b")).orderBy("slice").collect()
    names = np.array([r["slice"] for r in ranges], dtype="int32")
    low, high = (np.array([r["b"][i::2] for r in ranges], dtype="int64") for i in (0, 1))

    def to_slices(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(slices=[names[((h >= low) & (h <= high)).any(axis=1)] for h in batch["h"]])

    asked = _hashed(_vectors(query, query_key, vector, "q"), directions, bucket_length)
    fields = [T.StructField("slices", T.ArrayType(T.IntegerType()))]
    listed = asked.mapInPandas(to_slices, T.StructType(asked.schema.fields + fields)).select("q", "v", "h", F.explode("slices").alias("slice"))

    def local(points: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found, counts, asks = [], [], asking["q"].to_numpy()
        if len(points) and len(asking):
            keys, matrix, vectors = points["t"].to_numpy(), _stack(points["v"]), _stack(asking["v"])
            codes, own = np.stack(points["h"].to_list()), np.stack(asking["h"].to_list())
            # numbers within the slice take few bytes
            for i in range(tables):
                known, codes[:, i] = np.unique(codes[:, i], return_inverse=True)
                place = np.searchsorted(known, own[:, i]).clip(max=len(known) - 1)
                own[:, i] = np.where(known[place] == own[:, i], place, -1)
            codes, own = np.ascontiguousarray(codes.T.astype("int16" if len(keys) < 1 << 15 else "int64")), own.astype("int64")
            with np.errstate(over="ignore"):
                near = np.einsum("ij,ij->i", matrix, matrix)
            for start in range(0, len(asking), BLOCK):
                shared = np.zeros((len(own[start : start + BLOCK]), len(keys)), dtype=bool)
                for i in range(tables):
                    shared |= own[start : start + BLOCK, i : i + 1].astype(codes.dtype) == codes[i]
                if counted:
                    counts.append(shared.sum(axis=1))
                    continue
                at, of, d = _best(vectors[start : start + BLOCK], matrix, near, keys, len(keys) if k is None else k, shared)
                found.append((asks[start + at], keys[of], d))
        if counted:
            return pd.DataFrame({"q": asks, "pairs": np.concatenate(counts)} if counts else {"q": [], "pairs": []})
        return _pairs(found)

    return slices.compare(listed, local, T.StructType([schema["q"], T.StructField("pairs", T.LongType())]) if counted else schema)


def approximate_nearest(
    train: DataFrame,
    query: DataFrame,
    k: int = 5,
    train_key: str = "id",
    query_key: str = "query_id",
    vector: str = "vector",
    bucket_length: float | None = None,
    tables: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Nearly the k nearest training rows of each query row: (query_key, train_key, distance, rank).

    Rows are compared when they share a bucket of a random projection. A pair whose
    projections differ by about the bucket length is missed by one table with
    probability 0.63, by eight with 0.025; closer pairs less. Distances are exact. Queries that share a bucket
    with fewer than k rows are answered by the exact form. Keys tell rows apart.
    """
    if bucket_length is None:
        bucket_length = suggested_bucket(train, k, train_key, vector)
    pairs = candidate_pairs(train, query, train_key, query_key, vector, bucket_length, tables, seed, k)
    order = Window.partitionBy("q").orderBy("distance", "t")
    ranked = materialize(pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "near-pairs")
    full = ranked.where(F.col("rank") == k).select(F.col("q").alias(query_key))
    names = [F.col("q").alias(query_key), F.col("t").alias(train_key), "distance", "rank"]
    found = ranked.join(full.withColumnRenamed(query_key, "q"), "q", "left_semi").select(*names)
    short = materialize(query.join(full, query_key, "left_anti"), "short-queries")
    if short.isEmpty():
        return found
    return found.unionByName(nearest(train, short, k, train_key, query_key, vector).select(query_key, train_key, "distance", "rank"))


def recall(found: DataFrame, exact: DataFrame, query_key: str, train_key: str) -> DataFrame:
    """One row: wanted, hit, recall of the exact neighbours."""
    hits = exact.select(query_key, train_key).join(found.select(query_key, train_key, F.lit(1).alias("hit")), [query_key, train_key], "left")
    return hits.agg(F.count("*").alias("wanted"), F.count("hit").alias("hit"), F.try_divide(F.count("hit"), F.count("*")).alias("recall"))


def knn_predict(
    train: DataFrame,
    query: DataFrame,
    target: str,
    k: int = 5,
    train_key: str = "id",
    query_key: str = "query_id",
    vector: str = "vector",
    output: str = "prediction",
    block: int = BLOCK,
) -> DataFrame:
    """Mean target of the k nearest training rows, per query key."""
    found = nearest(train, query, k, train_key, query_key, vector, block)
    targets = train.select(train_key, F.col(target).cast("double").alias("__target"))
    return found.join(targets, train_key).groupBy(query_key).agg(F.avg("__target").alias(output))
