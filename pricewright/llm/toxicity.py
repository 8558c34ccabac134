"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

1. Words and word stems of labelled documents are counted by class into a hashed table of fixed
   size. The log-odds of a word between the classes have a Dirichlet prior with
   the classes' overall shares; they are shrunk by their standard error.
2. A linear-time scan finds all maximal segments of a document whose token scores
   have the greatest sums (Ruzzo and Tompa). Only tokens with a positive score
   start work in Python; sums between them come from one cumulative sum.
3. The best random segment of n clean tokens follows an extreme-value law
   (Karlin and Altschul): lambda solves E[exp(lambda * score)] = 1 over clean
   tokens, K comes from clean documents. A segment is significant when fewer than
   one such segment is expected by chance. The excess of the best one and the sum
   over all significant ones are turned into a probability by a logistic fit.

Each half of the labelled rows is scored with the log-odds of the other half for
the calibration, so that it sees no score learned from the same document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from pricewright.llm.ragged import WORD_VALUE, chunks, mixed, text_bytes, words
from pricewright.llm.tables import column, map_batches, text_or_empty, unique_name

#: Size of the hashed word table: bounds what is collected and broadcast (one megabyte).
BUCKETS = 1 << 18
#: Labelled rows used for learning, those of smallest hash; more add little.
TRAIN_ROWS = 200_000
#: Observations of every word that the prior adds, divided as the classes' tokens are.
PRIOR_WEIGHT = 5.0
#: Bytes of a word's stem; a token's score is the stronger one of word and stem.
STEM = 4
STANDARD_ERRORS = 3.0
DRIFT = 0.1

PASSAGES = "array<struct<begin:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Model:
    """Token scores and calibration; everything a task needs."""

    scores: np.ndarray
    rate: float  # lambda of the extreme-value law
    scale: float  # K
    weights: tuple[float, float, float]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, sum), in order."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    found: list[tuple[int, int, float, float, int]] = []  # begin, end, sum before, sum after, earlier one to look at
    for p in positive.tolist():
        begin, end, low, high = p, p + 1, total[p], total[p + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((begin, end, low, high, j))
                break
            begin, low = found[j][0], found[j][2]
            del found[j:]
    return [(b, e, high - low) for b, e, low, high, _ in found]


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Shrunken log-odds of every bucket, less the drift that makes clean text sum to less than nothing."""
    both = toxic + clean
    if not toxic.sum() or not clean.sum():
        return np.full(len(both), -DRIFT, np.float32)
    share = toxic.sum() / both.sum()
    a, b = toxic + PRIOR_WEIGHT * share, clean + PRIOR_WEIGHT * (1 - share)
    delta = np.log(a / b) - math.log(share / (1 - share))
    margin = STANDARD_ERRORS * np.sqrt(1 / a + 1 / b)
    return (np.sign(delta) * np.maximum(0, np.abs(delta) - margin) - DRIFT).astype(np.float32)


def chance_rate(scores: np.ndarray, clean: np.ndarray) -> float:
    """Positive solution of E[exp(rate * score)] = 1 over clean tokens; 1 where there is none."""
    seen = clean > 0
    if not seen.any() or (scores[seen] > 0).sum() == 0:
        return 1.0
    p, s = clean[seen] / clean[seen].sum(), scores[seen].astype(np.float64)
    if (p * s).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * s, 700))).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 700))).sum() < 1 else (low, mid)
    return max((low + high) / 2, 1e-3)


def token_buckets(body: np.ndarray, offsets: np.ndarray):
    """Table cells of each word and of its stem (first ``STEM`` bytes), with the words' starts and ends."""
    hashes, owner, starts, ends = words(body, offsets)
    stem = np.zeros(len(starts), np.uint64)
    for k in range(STEM):
        at = starts + k
        inside = at < ends
        stem = stem * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, WORD_VALUE[body[np.where(inside, at, 0)]], np.uint64(0))
    cells = [(h & np.uint64(BUCKETS - 1)).astype(np.int64) for h in (hashes, mixed(stem + np.uint64(1)))]
    return cells, owner, starts, ends


def document_scores(column_: pa.Array, scores: list[np.ndarray] | np.ndarray, pick: np.ndarray | None = None):
    """Per text: (token count, its maximal segments, word starts, word ends)."""
    data, offsets = text_bytes(column_)
    for first, last, body, at in chunks(data, offsets):
        (word, stem), _, starts, ends = token_buckets(body, at)
        low, high = np.searchsorted(starts, at[:-1]), np.searchsorted(starts, at[1:])
        for i in range(last - first):
            table = scores if pick is None else scores[pick[first + i]]
            span = slice(low[i], high[i])
            a, b = table[word[span]], table[stem[span]]
            token = np.where(np.abs(a) >= np.abs(b), a, b)
            token[1:][(word[span][1:] == word[span][:-1]) & (token[1:] > 0)] = -DRIFT  # a word repeated at once counts once
            yield int(high[i] - low[i]), maximal_segments(token), starts[span] - at[i], ends[span] - at[i]


def features(n: int, segments, rate: float, scale: float) -> tuple[float, float]:
    """Excess of the best segment over chance, and the sum over significant segments."""
    if not segments:
        return 0.0, 0.0
    chance = math.log(max(scale * n, 1e-9))
    over = [rate * s - chance for _, _, s in segments]
    return max(0.0, max(over)), sum(x for x in over if x > 0)


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Weights of a constant and two features, lightly penalised, by Newton steps."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return float(np.log(rate / (1 - rate))), 0.0, 0.0
    z = np.column_stack((np.ones(len(y)), np.log1p(x)))
    w = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def probability(n: int, segments, model: Model) -> float:
    a, b = features(n, segments, model.rate, model.scale)
    t = model.weights[0] + model.weights[1] * math.log1p(a) + model.weights[2] * math.log1p(b)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, t))))


def fold_of(identity):
    return F.pmod(F.crc32(F.coalesce(identity.cast("string"), F.lit(""))), F.lit(5))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled documents whose crc32(id as text) mod 5 is not 0.

    At most ``train_rows`` label rows are used, those of smallest id hash. Null
    ids and null labels are not used; of several labels of an id the greatest
    counts. Without both classes the score is the rate of toxic rows.
    """
    marked = labels.select(column(labels, "doc_id").cast("bigint").alias("id"), column(labels, label_col).cast("int").alias("y"))
    chosen = (
        marked.where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
        .withColumn("fold", fold_of(F.col("id"))).where("fold <> 0").orderBy(F.xxhash64("id"), "id").limit(train_rows)
    )
    texts = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))
    rows = texts.join(F.broadcast(chosen), "id").select("body", (F.col("y") > 0).cast("int").alias("y"), (F.col("fold") > 2).cast("int").alias("half"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(0))
        group = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) * 2 + batch.column(2).to_numpy(zero_copy_only=False)
        table = np.zeros(4 * BUCKETS, np.int64)
        for first, _, body, at in chunks(data, offsets):
            cells, owner, _, _ = token_buckets(body, at)
            for cell in cells:  # each word once per document, so that a document of one word proves little
                once = np.unique(owner * BUCKETS + cell)
                table += np.bincount(group[first + once // BUCKETS] * BUCKETS + once % BUCKETS, minlength=4 * BUCKETS)
        cells = np.flatnonzero(table)
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(table[cells], pa.int64())], ["cell", "n"])

    counts = map_batches(rows, counted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(4 * BUCKETS)
    table[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    clean, toxic = table.reshape(2, 2, BUCKETS)  # class, half
    halves = [log_odds(toxic[h], clean[h]) for h in (0, 1)]
    scores = log_odds(toxic.sum(0), clean.sum(0))
    rate = chance_rate(scores, clean.sum(0))
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def best(batch: pa.RecordBatch) -> pa.RecordBatch:
        half = 1 - batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        n, segments = [], []
        for count, found, _, _ in document_scores(batch.column(0), shared.value, half):
            n.append(count)
            segments.append([s for _, _, s in found])
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int64()), pa.array(segments, pa.list_(pa.float64()))], ["y", "n", "found"])

    held = map_batches(rows, best, "y int, n bigint, found array<double>").toArrow()
    y, size = held["y"].to_numpy().astype(np.float64), held["n"].to_numpy()
    found = held["found"].combine_chunks()
    flat = found.flatten().to_numpy()
    owner = np.repeat(np.arange(len(y)), np.diff(found.offsets.to_numpy())) if len(y) else np.zeros(0, np.int64)
    top = np.zeros(len(y))
    np.maximum.at(top, owner, flat)
    tops = (rate * top - np.log(np.maximum(size, 1)))[(y == 0) & (top > 0)]
    scale = math.exp(float(tops.mean()) - np.euler_gamma) if len(tops) >= 10 else 0.05
    over = np.maximum(0, rate * flat - np.log(np.maximum(scale * size, 1e-9))[owner])
    most = np.zeros(len(y))
    np.maximum.at(most, owner, over)
    x = np.column_stack((most, np.bincount(owner, over, len(y)))) if len(y) else np.zeros((0, 2))
    return Model(scores, rate, scale, logistic_fit(x, y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with toxic_score, toxic_predicted and toxic_passages added.

    Passages are the significant segments: byte begin and end in the UTF-8 text
    and their score. Null and empty texts have none and get the lowest score.
    Nothing is shuffled. Added names are lengthened where a column has them.
    """
    names = [unique_name(docs, s) for s in ("toxic_score", "toxic_predicted", "toxic_passages")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.columns
    place = given.index(text_col)
    added = [StructField(n, t.dataType) for n, t in zip(names, StructType.fromDDL(f"a double, b int, c {PASSAGES}"))]
    schema = StructType([*docs.schema.fields, *added])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        fitted = shared.value
        texts = batch.column(place)
        values, passages = [], []
        for n, segments, starts, ends in document_scores(texts, fitted.scores):
            values.append(probability(n, segments, fitted))
            chance = math.log(max(fitted.scale * n, 1e-9)) if n else 0.0
            passages.append([{"begin": int(starts[b]), "end": int(ends[e - 1]), "score": s} for b, e, s in segments if fitted.rate * s > chance])
        added = [pa.array(values, pa.float64()), pa.array([int(v >= 0.5) for v in values], pa.int32()), pa.array(passages, kind)]
        return pa.RecordBatch.from_arrays(list(batch.columns) + added, [*given, *names])

    return map_batches(docs, scored, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, passages.

    Learns from ``labels`` (see ``learn``). Ids, sources, languages and labels
    take no part in a score. A null id counts as held out. Rows repeat as in the
    input; an empty table gives no rows; further columns are ignored.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    return score(rows, model).select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.col("toxic_predicted").alias("predicted"),
        F.col("toxic_passages").alias("passages"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not predicted toxic."""
    scored = score(docs, learn(docs, labels, id_col, text_col), id_col, text_col)
    added = [c for c in scored.columns if c not in docs.columns]
    return scored.where(F.col(added[1]) == 0).select(*[column(scored, c) for c in docs.columns])
