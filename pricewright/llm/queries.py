"""Queries of the training-data operators over the driver's tables, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewright.llm.alignment import align_tokenizers
from pricewright.llm.decontaminate import contamination
from pricewright.llm.exact_dedup import exact_duplicates
from pricewright.llm.html_text import page_text
from pricewright.llm.jaccard import near_duplicates
from pricewright.llm.lexical_search import rank_documents
from pricewright.llm.packing import pack
from pricewright.llm.secrets import scan_secrets
from pricewright.llm.sharding import shard_by_bytes
from pricewright.llm.suffix_dedup import repeated_substrings
from pricewright.llm.token_counts import count_tokens
from pricewright.llm.token_output import token_digests, write_token_ids
from pricewright.llm.toxicity import toxicity
from pricewright.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op1_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY body)
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


@query("op2_repeated_substrings")
def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_substrings(table(spark, sf_dir, "documents")).drop("spans")


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_token_output")
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, tokenizer())
    return token_digests(spark, path)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.selectExpr("doc_id", "held_out", "score", "predicted", "cast(size(passages) as bigint) as n_passages")


@query("op6_page_text")
def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text(table(spark, sf_dir, "pages"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer())


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer())


@query(
    "op10_decontaminate",
    rf"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), items AS (
        SELECT CAST(item_id AS VARCHAR) AS item,
               regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), wins AS (
        SELECT DISTINCT item, wide, array_to_string(w[start:start + wide - 1], ' ') AS win
        FROM (SELECT item, w, wide, unnest(range(1, len(w) - wide + 2)) AS start
              FROM (SELECT item, w, least(13, len(w)) AS wide FROM items WHERE len(w) > 0))
    ), places AS (
        SELECT doc_id, wide, start, array_to_string(w[start:start + wide - 1], ' ') AS win
        FROM (SELECT doc_id, w, wide, unnest(range(1, len(w) - wide + 2)) AS start
              FROM words, (SELECT DISTINCT wide FROM wins) WHERE len(w) >= wide)
    ), hits AS (
        SELECT doc_id, item, start, places.wide FROM places JOIN wins USING (win, wide)
    ), n_hit AS (
        SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(start, start + wide)) AS pos FROM (SELECT DISTINCT doc_id, start, wide FROM hits)) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM words LEFT JOIN n_hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model"))


@query("op12_sharding")
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 24)


TERMS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op13_lexical_search",
    f"""
    WITH d AS (
        SELECT row_number() OVER () AS place, doc_id, {TERMS} AS w FROM documents WHERE text IS NOT NULL
    ), sized AS (
        SELECT place, doc_id, len(w) AS n FROM d WHERE len(w) > 0
    ), corpus AS (
        SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized
    ), tf AS (
        SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(w) AS term FROM d) GROUP BY place, term
    ), df AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, corpus GROUP BY term, docs
    ), asked AS (
        SELECT row_number() OVER () AS asked, item_id, {TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
    ), q AS (
        SELECT asked, term, count(*) AS repeats FROM (SELECT asked, unnest(w) AS term FROM asked) GROUP BY asked, term
    ), scored AS (
        SELECT asked, place,
               CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words))))) AS BIGINT) AS score
        FROM q JOIN df USING (term) JOIN tf USING (term) JOIN sized USING (place), corpus GROUP BY asked, place
    ), ranked AS (
        SELECT asked, doc_id, score, row_number() OVER (PARTITION BY asked ORDER BY score DESC, doc_id) AS rank
        FROM scored JOIN sized USING (place) WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN asked USING (asked) WHERE rank <= 20
    """,
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
