"""Wide to long, lists to rows, dotted columns to structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.let import let, spread
from pricewright.functions.text import clean_tokens, ngrams, text_stats_eda
from pricewright.vocab import PLACEHOLDER

STATS = ("char_count", "word_count", "avg_word_length")
NGRAMS = ("unigrams", "bigrams", "trigrams")


def melt(df: DataFrame, ids: list[str], columns: list[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, variable, value)


def melt_metrics(df: DataFrame, ids: list[str]) -> DataFrame:
    """Train and eval rows with both metric families side by side, in one pass."""
    rows = F.array(
        *[
            F.struct(
                F.lit(f"rmsle_{part}").alias("rmsle"),
                F.col(f"rmsle_{part}").alias("rmsle_value"),
                F.lit(f"wape_{part}").alias("wape"),
                F.col(f"wape_{part}").alias("wape_value"),
            )
            for part in ("train", "eval")
        ]
    )
    return df.select(*ids, F.explode(rows).alias("m")).select(*ids, "m.*")


def text_long(df: DataFrame, columns: list[str], price: str = "sold_price") -> DataFrame:
    return df.unpivot([price], columns, "text_feature", "text")


def text_stats_long(df: DataFrame, columns: list[str], price: str = "sold_price") -> DataFrame:
    """Exploration statistics as rows (text_feature, price, stat, value)."""
    stats = text_long(df, columns, price).select("text_feature", price, text_stats_eda(F.col("text")).alias("s"))
    wide = stats.select("text_feature", price, *[F.col(f"s.{c}").cast("double").alias(c) for c in STATS])
    return wide.unpivot(["text_feature", price], list(STATS), "stat", "value")


def ngrams_long(df: DataFrame, columns: list[str], price: str = "sold_price", keep: str = "alpha", tags: tuple[str, ...] = ()) -> DataFrame:
    """One row per n-gram occurrence: (text_feature, price, *tags, ngram, value).

    ``tags`` are further columns that go along. Text left empty by cleaning carries the placeholder as its only token.
    """

    def kinds(tokens: Column) -> Column:
        present = F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(PLACEHOLDER)))
        return let(
            present,
            lambda t: F.array(
                *[F.struct(F.lit(k).alias("ngram"), ngrams(t, n + 1).alias("v")) for n, k in enumerate(NGRAMS)]
            ),
        )

    long = df.unpivot([price, *tags], columns, "text_feature", "text")
    by_kind = spread(long, ["text_feature", price, *tags], let(clean_tokens(F.col("text"), keep), kinds), "k")
    return by_kind.select("text_feature", price, *tags, "k.ngram", F.explode("k.v").alias("value"))


def explode_list(df: DataFrame, column: str, output: str = "value") -> DataFrame:
    """List to rows; an empty or missing list keeps its row with NULL."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode_outer(column).alias(output))


def nest_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Dotted column names to nested structs; siblings merge into one struct."""
    tree: dict = {}
    for name in df.columns:
        parts = name.split(sep)
        node = tree
        for part in parts[:-1]:
            node = node.setdefault(part, {})
            if not isinstance(node, dict):
                raise ValueError(f"{name!r} is both a value and a group")
        if parts[-1] in node:
            raise ValueError(f"{name!r} is both a value and a group")
        node[parts[-1]] = F.col(f"`{name}`")

    def build(node) -> Column:
        if not isinstance(node, dict):
            return node
        return F.struct(*[build(child).alias(key) for key, child in node.items()])

    return df.select(*[build(node).alias(key) for key, node in tree.items()])


def nest_config(flat: dict) -> dict:
    """Dotted configuration keys to nested dictionaries; a key that is a value and a group at once is refused."""
    out: dict = {}
    made = [out]
    for key, value in flat.items():
        *groups, leaf = key.split(".")
        node = out
        for group in groups:
            if group not in node:
                node[group] = {}
                made.append(node[group])
            node = node[group]
            # a value may be a dictionary too; only those made here are groups
            if not any(node is m for m in made):
                raise ValueError(f"{key!r} is both a value and a group")
        if leaf in node:
            raise ValueError(f"{key!r} is both a value and a group")
        node[leaf] = value
    return out
