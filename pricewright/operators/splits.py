"""Reproducible splits and dataset preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pricewright.functions.text import clean_text
from pricewright.operators.quantiles import EXACT_ROWS, order_statistics
from pricewright.operators.windows import drop_exact_duplicates, number_rows
from pricewright.session import fresh_path
from pricewright.vocab import TEXT_COLUMNS

PARTS = ("train", "eval", "test")


def hash_share(key: Column, seed: int | Column = 42, digits: int = 8) -> Column:
    """A number in [0, 1) that depends on the key and seed only."""
    salted = F.concat(key.cast("string"), F.lit("#"), F.lit(seed).cast("string"))
    return F.conv(F.substring(F.md5(salted), 1, digits), 16, 10).cast("double") / F.lit(float(16**digits))


def split_label(key: Column, shares: tuple[float, ...] = (0.6, 0.2, 0.2), seed: int = 42) -> Column:
    u = hash_share(key, seed)
    return F.when(u < shares[0], PARTS[0]).when(u < shares[0] + shares[1], PARTS[1]).otherwise(PARTS[2])


def split(
    df: DataFrame, key: str, shares: tuple[float, ...] = (0.6, 0.2, 0.2), seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Disjoint, exhaustive parts by key hash; sizes are close to the shares."""
    labelled = df.withColumn("__part", split_label(F.col(key), shares, seed))
    return tuple(labelled.where(F.col("__part") == p).drop("__part") for p in PARTS)


def split_exact(
    df: DataFrame,
    key: str,
    shares: tuple[float, ...] = (0.6, 0.2, 0.2),
    seed: int = 42,
    exact_rows: int = EXACT_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts of exactly the asked sizes: cut at order statistics of the key hash.

    Rows of one key have one hash and stay in one part, so sizes are exact for
    unique keys and off by at most the rows of the key at each cut otherwise.
    """
    u = hash_share(F.col(key), seed, 13)
    values = df.select(u.alias("v"))
    n = values.count()
    first, second = int(n * shares[0]), int(n * shares[0]) + int(n * shares[1])
    cuts = order_statistics(values, [min(first, n - 1), min(second, n - 1)], exact_rows) if n else {}
    a = cuts.get(first, float("inf"))
    b = cuts.get(second, float("inf"))
    return df.where(u < a), df.where((u >= a) & (u < b)), df.where(u >= b)


def write_datasets(
    df: DataFrame,
    n: int | None,
    key: str = "id",
    columns=TEXT_COLUMNS,
    shares: tuple[float, ...] = (0.6, 0.2, 0.2),
    seed: int = 42,
) -> tuple[DataFrame, dict[str, int]]:
    """(all prepared rows with their ``part``, rows of each part), cleaned and written in one job.

    The parts are folders of one table; their sizes are observed while it is
    written. With ``n`` the first n rows in order of the key are taken, and a
    table that has fewer is an error; equal keys are ordered by the other columns.
    """
    rows = drop_exact_duplicates(df)
    if n is not None:
        others = [f.name for f in df.schema if f.name != key and f.dataType.typeName() not in ("map", "variant")]
        rows = number_rows(rows, [key, *others], "__place").where(F.col("__place") < n).drop("__place")
    cleaned = rows.withColumns({c: clean_text(F.col(c)) for c in columns})
    seen = Observation("datasets")
    sizes = [F.count_if(F.col("part") == p).alias(p) for p in PARTS]
    # label and sizes are worked out in the writing tasks; nothing is read twice
    labelled = cleaned.withColumn("part", split_label(F.col(key), shares, seed)).observe(seen, *sizes)
    path = fresh_path(df.sparkSession, "datasets")
    labelled.write.partitionBy("part").parquet(path)
    counted = {p: seen.get[p] for p in PARTS}
    if n is not None and sum(counted.values()) != n:
        raise ValueError(f"asked for {n} rows, the table has {sum(counted.values())}")
    if not any(counted.values()):  # a table without files has no folders to read
        return labelled.where("false"), counted
    return df.sparkSession.read.schema(labelled.schema).parquet(path), counted


def prepare_datasets(
    df: DataFrame,
    n: int | None,
    key: str = "id",
    columns=TEXT_COLUMNS,
    shares: tuple[float, ...] = (0.6, 0.2, 0.2),
    seed: int = 42,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deduplicate, take the first n rows (all when n is None), clean the text and split."""
    table, _ = write_datasets(df, n, key, columns, shares, seed)
    if exact:
        # the cuts are found over the written keys; the texts are not cleaned again
        return split_exact(table.drop("part"), key, shares, seed)
    return tuple(table.where(F.col("part") == p).drop("part") for p in PARTS)
