"""Ranked lexical search with NRA: impact-sorted lists read in sequence, score intervals per document.

The documents are indexed block by block: a stored row holds the postings of some
megabytes of text for the terms that the queries use. Grouped sums over the blocks
give the corpus counts that scores need. Every block is then searched for every
query by NRA (no random access): each list is sorted by impact and read from the
top in steps of doubling depth. A document's lower bound is what was read of it,
its upper bound adds the last impact read for every term not met yet. Documents
whose upper bound cannot reach the results are dropped; reading goes on until no
unseen document can reach them and every document left has one exact score, so
membership, ties and scores are settled. A task carries its results from block to
block, which raises the bar for the next one; the best of all tasks are merged.

Queries are held in sets of bounded bytes, and each set is searched on its own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from pricewright.llm.tables import column, materialize

#: Text bytes after which an index block is closed; one longer text is a block of its own.
BLOCK_BYTES = 1 << 22
#: Mean text bytes of a set of queries, which every task holds.
QUERY_BYTES = 1 << 22
#: Postings of each list that the first step reads.
FIRST_DEPTH = 64
#: A run of digits, ASCII letters and characters above 127.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

BLOCK_FIELDS = [
    ("doc_id", pa.list_(pa.int64())),  # documents with at least one term
    ("length", pa.list_(pa.int64())),
    ("term", pa.list_(pa.int32())),  # numbers of query terms in the block, ascending
    ("holders", pa.list_(pa.int64())),  # documents of the block that hold the term
    ("place", pa.list_(pa.int32())),  # postings by term: index of the document
    ("times", pa.list_(pa.int32())),
]
_SQL = {pa.int64(): "bigint", pa.int32(): "int"}
BLOCKS = ", ".join(f"{n} array<{_SQL[t.value_type]}>" for n, t in BLOCK_FIELDS)
FOUND = "query int, doc_id bigint, score bigint"


def terms(text: str | None) -> list[str]:
    return TERM.findall(text.translate(LOWER)) if text else []


def term_weight(n_docs: int, holders: int) -> int:
    """Never negative, as no term has more holders than there are documents."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def _indexed(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), column(docs, text_col).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, places, numbers, times, size = [], [], [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, lengths, places, numbers, times, size
            number, place = np.array(numbers, np.int32), np.array(places, np.int32)
            order = np.argsort(number, kind="stable")
            term, holders = np.unique(number, return_counts=True)
            row = [ids, lengths, term, holders, place[order], np.array(times, np.int32)[order]]
            ids, lengths, places, numbers, times, size = [], [], [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, (_, kind) in zip(row, BLOCK_FIELDS)], [n for n, _ in BLOCK_FIELDS])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                counts = Counter(terms(text))
                size += 32 + len(text or "")
                if counts:
                    for t in counts.keys() & vocabulary.keys():
                        places.append(len(ids))
                        numbers.append(vocabulary[t])
                        times.append(counts[t])
                    ids.append(doc.as_py())
                    lengths.append(counts.total())
                if size >= BLOCK_BYTES:
                    yield close()
        if ids:
            yield close()

    return named.mapInArrow(run, BLOCKS)


class Best:
    """The best k documents of one query so far: score descending, doc_id ascending, null ids last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bar(self) -> tuple[int, int] | None:
        """Score and id of the last result, once there are k."""
        return (int(self.score[-1]), int(self.doc[-1])) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate((self.score, score)), np.concatenate((self.doc, doc))
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]


#: Stands for a null id while ranking, after all others.
NULL_ID = np.iinfo(np.int64).max


class Block:
    """Postings of one block, each list by impact descending."""

    def __init__(self, doc: np.ndarray, length: np.ndarray, term: np.ndarray, holders: np.ndarray, place: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int):
        self.doc, ends = doc, np.cumsum(holders)
        norm = 100 - 25 + (25 * length * n_docs) // n_terms
        times = times.astype(np.int64)
        impact = (1000000000 * times) // (1000 * times + 12 * norm[place])
        number = np.repeat(np.arange(len(term)), holders)
        order = np.lexsort((-impact, number))
        impact, place = impact[order], place[order]
        self.lists = {t: (place[a:b], impact[a:b]) for t, a, b in zip(term.tolist(), (ends - holders).tolist(), ends.tolist())}

    def search(self, weights: dict[int, int], best: Best) -> None:
        """Bring ``best`` up to date with this block's documents for one query (term number: weight)."""
        lists = [(w, *self.lists[t]) for t, w in weights.items() if w and t in self.lists]
        if not lists:
            return
        lower = np.zeros(len(self.doc), np.int64)
        unseen = np.ones((len(lists), len(self.doc)), bool)
        live = np.ones(len(self.doc), bool)
        # a term's highest impact not read yet, times its weight; documents without the term have none
        bounds = np.array([w * int(impact[0]) for w, _, impact in lists], np.int64)
        read, depth = 0, FIRST_DEPTH
        while True:
            for k, (w, place, impact) in enumerate(lists):
                some = place[read:depth]
                if len(some):
                    lower[some] += w * impact[read:depth]
                    unseen[k, some] = False
                    bounds[k] = w * int(impact[depth]) if depth < len(impact) else 0
            upper = lower + bounds @ unseen if bounds.any() else lower
            done = depth >= max(len(p) for _, p, _ in lists)
            bar = self._bar(lower, live, best)
            live &= upper > 0
            if bar is not None:
                live &= (upper > bar[0]) | ((upper == bar[0]) & (self.doc <= bar[1]))
            if done or not (live & (upper != lower)).any():
                break
            read, depth = depth, 4 * depth
        live &= lower > 0
        best.add(lower[live], self.doc[live])

    @staticmethod
    def _bar(lower: np.ndarray, live: np.ndarray, best: Best) -> tuple[int, int] | None:
        """What a document has to reach: the k-th best of sure scores, here and in earlier blocks."""
        bar, k = best.bar(), best.k
        sure = np.flatnonzero(live & (lower > 0))
        if len(sure) >= k:
            cut = np.partition(lower[sure], len(sure) - k)[len(sure) - k]
            here = (int(cut), NULL_ID)  # ids of ties are settled by the final order
            if bar is None or here[0] > bar[0]:
                bar = here
        return bar


def _searched(blocks: DataFrame, queries: list[dict[int, int]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        best = [Best(k) for _ in weights]
        for batch in batches:
            for i in range(batch.num_rows):
                values = [batch.column(c)[i].values for c in range(len(BLOCK_FIELDS))]
                arrays = [values[0].fill_null(NULL_ID).to_numpy(zero_copy_only=False), *(v.to_numpy() for v in values[1:])]
                block = Block(*arrays, n_docs, n_terms)
                for query, found in zip(weights, best):
                    block.search(query, found)
        for number, found in enumerate(best):
            if len(found.doc):
                ids = pa.array(found.doc, mask=found.doc == NULL_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.doc), number, np.int32)), ids, pa.array(found.score)], ["query", "doc_id", "score"])

    return blocks.mapInArrow(run, FOUND)


def _query_sets(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[Row]]:
    """Distinct (item, text) rows in sets of about ``QUERY_BYTES``; rows without text have no terms."""
    named = items.select(column(items, item_col).alias("item_id"), column(items, text_col).cast("string").alias("text")).where("text is not null").distinct()
    total = named.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    sets = -(-total // QUERY_BYTES)
    for number in range(sets):
        yield named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(sets)) == number).collect()


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score.

    A score sums, over the item's terms with repeats, the term's integer weight
    times its integer impact in the document; only scores above 0 rank, equal
    scores by ascending doc_id (null ids last; ids are below 2^63 - 1). Null and empty texts have no terms
    and are never found; an item without terms, or that nothing matches, has no
    rows. Items that repeat as a whole count once; different texts under one
    item_id are ranked apart. Documents that repeat are ranked each on its own.
    Empty tables give no rows; further columns are ignored.

    A task holds one block (four megabytes of text, or one longer text), one set
    of queries and k results for each.
    """
    spark = docs.sparkSession
    kind = items.schema[[f.name for f in items.schema].index(item_col)].dataType.simpleString()
    ranked = [_ranked_set(spark, docs, rows, kind, k, id_col, text_col) for rows in _query_sets(items, item_col, item_text_col)]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for part in ranked:
        out = out.unionByName(part)
    return out


def _ranked_set(spark: SparkSession, docs: DataFrame, rows: list[Row], kind: str, k: int, id_col: str, text_col: str) -> DataFrame:
    counted = [Counter(terms(r.text)) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))} if counted else {}
    blocks = materialize(_indexed(docs, vocabulary, id_col, text_col), "search-blocks")
    corpus = blocks.agg(F.sum(F.size("doc_id")), F.sum(F.aggregate("length", F.lit(0).cast("bigint"), lambda a, n: a + n))).first()
    n_docs, n_terms = corpus[0] or 0, corpus[1] or 0
    held = blocks.select(F.explode(F.arrays_zip("term", "holders")).alias("held")).groupBy("held.term").agg(F.sum("held.holders"))
    holders = {t: n for t, n in held.collect()}  # no more rows than the set of queries has terms
    weight = {t: term_weight(n_docs, holders[i]) for t, i in vocabulary.items() if i in holders}
    queries = [{vocabulary[t]: n * weight[t] for t, n in c.items() if t in weight} for c in counted]
    found = _searched(blocks, queries, n_docs, max(1, n_terms), k)
    # twice: the tasks' results of one query meet in several tasks first
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (["query", "part"], ["query"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {kind}")
    return some.join(F.broadcast(named), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
