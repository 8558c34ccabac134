"""Bounded constant dictionaries as one literal, with constant-time lookup."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, functions as F

MAX_ENTRIES = 100_000
# Keys that a plan may list: absent ones, the common case, are then told by one hash set.
MAX_LISTED = 4096


def constant_lookup(key: Column, table: dict[str, object], kind: str) -> Column:
    """Value of a string key in a constant dictionary, NULL when absent.

    A map literal is searched entry by entry, so the entries are spread over
    buckets by CRC-32 and only one bucket of a handful of entries is searched.
    """
    if len(table) > MAX_ENTRIES:
        raise ValueError(f"{len(table)} entries are too many for a constant; operators.dictionaries takes them as a table")
    buckets = 1
    while buckets * 4 < len(table):
        buckets *= 2
    parts: list[dict[str, object]] = [{} for _ in range(buckets)]
    for name, value in table.items():
        parts[zlib.crc32(name.encode()) % buckets][name] = value
    literal = F.from_json(F.lit(json.dumps(parts, ensure_ascii=False)), f"array<map<string,{kind}>>")
    value = F.get(literal, F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int"))[key]
    return F.when(key.isin(list(table)), value) if 0 < len(table) <= MAX_LISTED else value


def in_constant(key: Column, names) -> Column:
    names = list(names)
    listed = key.isin(names) if 0 < len(names) <= MAX_LISTED else constant_lookup(key, {n: True for n in names}, "boolean")
    return F.coalesce(listed, F.lit(False))
