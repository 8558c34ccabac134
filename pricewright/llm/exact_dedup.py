"""Exact duplicates: 128-bit content hash, bytes compared inside each hash group.

Texts are equal when they are identical after lower-casing A-Z; null counts as
empty. The hash is the first half of the SHA-256 of the normalised UTF-8 text.
Texts with one hash are compared byte by byte by grouping on (hash, text): the
grouping combines on the map side, so a text that a third of all rows share
reaches the shuffle once per task. Documents are then joined to their group by
the hash alone; only where two different texts share a hash is the text itself
part of the key.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pricewright.llm.tables import column, kept_rows, map_batches, materialize, text_or_empty

ROWS = "id bigint, digest binary"
TEXTS = "id bigint, digest binary, body binary"


def _hashed(batch: pa.RecordBatch, with_body: bool) -> pa.RecordBatch:
    # bytes.lower() changes A-Z only
    bodies = [(t or "").encode().lower() for t in batch.column(1).to_pylist()]
    digests = pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary())
    arrays = [batch.column(0), digests] + ([pa.array(bodies, pa.binary())] if with_body else [])
    return pa.RecordBatch.from_arrays(arrays, ["id", "digest", "body"][: len(arrays)])


def hashed_rows(docs: DataFrame, id_col: str, text_col: str, with_body: bool) -> DataFrame:
    named = docs.select(column(docs, id_col).cast("bigint").alias("id"), text_or_empty(docs, text_col).alias("body"))
    rows = map_batches(named, lambda b: _hashed(b, with_body), TEXTS if with_body else ROWS)
    return rows.withColumn("hash", F.substring("digest", 1, 16))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the row that stays: ``smallest`` or ``largest`` id. A null id
    never beats a number; a group of null ids alone has keep_id null. Of rows
    that repeat the kept id, one is marked kept. An empty table gives no rows;
    further columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best = F.min("id") if keep == "smallest" else F.max("id")
    grouped = hashed_rows(docs, id_col, text_col, True).groupBy("hash", "body").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(grouped.drop("body"), "exact-groups")
    clashes = groups.groupBy("hash").count().where("count > 1").select("hash")
    if clashes.isEmpty():
        joined = hashed_rows(docs, id_col, text_col, False).join(groups, "hash")
    else:
        # hashes with several texts: the text decides, for these rows only
        rows = hashed_rows(docs, id_col, text_col, True)
        clear = rows.drop("body").join(groups.join(clashes, "hash", "left_anti"), "hash")
        mixed = rows.join(clashes, "hash", "left_semi").join(grouped.join(clashes, "hash", "left_semi"), ["hash", "body"]).drop("body")
        joined = clear.unionByName(mixed)
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    # one partition per id and text: more than one row only where ids repeat
    turn = F.row_number().over(Window.partitionBy("digest", "id").orderBy("keep_id"))
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("group_size").cast("bigint"),
        (stays & (turn == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one_per_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one row of each distinct text."""
    decided = exact_duplicates(docs, id_col, text_col, keep).where("kept")
    listed = decided.select("doc_id", F.unhex("text_sha256").alias("digest"))
    return kept_rows(docs, listed, id_col, text_col, lowered=True)
