"""Shards of near-equal bytes by Karmarkar-Karp differencing; equal texts stay together.

Differencing keeps partial partitions, lists of shard loads. It takes the two of
largest spread, adds them in opposite order (the heaviest shard of one to the
lightest of the other) and goes on until one is left. Its items are

* every group of equal texts whose bytes exceed a fixed share of the total, so
  that there are at most ``ITEMS`` of them whatever the table holds, and
* the lighter groups, added up by a hash of their text into ``ITEMS`` bins.

So a table of few groups is differenced group by group, and a table of any size
hands the driver at most twice ``ITEMS`` numbers. Hashes, sizes, grouped sums and
the numbering of rows are Spark's own operations; no text is shuffled.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from pricewright.llm.tables import column, materialize, numbered, text_or_empty

#: Bins of light groups; heavy groups are those above the total divided by this number.
ITEMS = 6144
#: Bytes that a stored row takes beside its text.
ROW_BYTES = 8


def differenced(sizes: list[int], shards: int) -> list[int]:
    """A shard for every item, by Karmarkar-Karp differencing into ``shards`` parts.

    Ties are broken by the order of the items, so equal input gives equal output.
    """
    # a partial partition: loads in ascending order, less the least; and the items behind each load
    heap = [(-size, turn, [0] * (shards - 1) + [size], [[] for _ in range(shards - 1)] + [[turn]]) for turn, size in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        _, _, loads, items = heapq.heappop(heap)
        _, _, other_loads, other_items = heapq.heappop(heap)
        sums = [x + y for x, y in zip(loads, reversed(other_loads))]
        merged = [_longer_first(x, y) for x, y in zip(items, reversed(other_items))]
        order = sorted(range(shards), key=sums.__getitem__)
        least = sums[order[0]]
        heapq.heappush(heap, (least - sums[order[-1]], turn, [sums[k] - least for k in order], [merged[k] for k in order]))
        turn += 1
    shard_of = [0] * len(sizes)
    for shard, listed in enumerate(reversed(heap[0][3]) if heap else ()):
        for item in listed:
            shard_of[item] = shard
    return shard_of


def _longer_first(x: list[int], y: list[int]) -> list[int]:
    if len(x) < len(y):
        x, y = y, x
    x.extend(y)
    return x


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", items: int = ITEMS) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards 0 to ``shards`` - 1 have near-equal sums of
    ``size`` (UTF-8 bytes and eight more), as far as groups of equal texts, which
    are never divided, allow. Null counts as the empty text. Groups are told apart
    by 128 bits of SHA-256 and their length. ``slot`` numbers the rows of a shard
    from 0 in order of doc_id (null ids first, ties by text hash; rows equal in
    both in any order). Rows repeat as in the input; an empty table gives no
    rows; further columns are ignored. ``grown_shard`` belongs to another law and is null.
    Shards depend on the texts alone, not on ids, row order or partitions.

    The driver holds at most ``items`` heavy groups and ``items`` bins, with
    ``shards`` loads each; both lists are broadcast.
    """
    spark = docs.sparkSession
    named = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), text_or_empty(docs, text_col).alias("body"))
    rows = materialize(
        named.select(
            "doc_id",
            (F.octet_length("body").cast("bigint") + ROW_BYTES).alias("size"),
            F.crc32(F.col("body").cast("binary")).alias("text_crc32"),
            F.substring(F.unhex(F.sha2("body", 256)), 1, 16).alias("hash"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("hash", "size").agg(F.sum("size").alias("bytes"))
    groups = materialize(groups.withColumn("bin", F.pmod(F.xxhash64("hash", "size"), F.lit(items))), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    # fewer than ``items`` groups can exceed that share
    is_heavy = F.col("bytes") * items > total
    heavy = groups.where(is_heavy).select("hash", "size", "bytes").collect()
    light = groups.where(~is_heavy).groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()
    heavy.sort(key=lambda r: (-r.bytes, bytes(r.hash), r.size))
    light.sort(key=lambda r: (-r.bytes, r.bin))
    chosen = differenced([r.bytes for r in heavy] + [r.bytes for r in light], shards)
    of_group = spark.createDataFrame([(bytes(r.hash), r.size, s) for r, s in zip(heavy, chosen)], "hash binary, size bigint, own int")
    of_bin = spark.createDataFrame([(r.bin, s) for r, s in zip(light, chosen[len(heavy) :])], "bin bigint, shared int")
    dealt = rows.withColumn("bin", F.pmod(F.xxhash64("hash", "size"), F.lit(items)))
    dealt = dealt.join(F.broadcast(of_group), ["hash", "size"], "left").join(F.broadcast(of_bin), "bin", "left")
    dealt = dealt.withColumn("shard", F.coalesce("own", "shared")).drop("own", "shared", "bin")
    placed = numbered(dealt, "shard", ["doc_id", "hash", "size"], "slot", "shard-slots")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint"), F.lit(None).cast("int").alias("grown_shard"))
