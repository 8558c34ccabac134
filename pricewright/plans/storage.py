"""Source and sink queries: what is written is read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from pricewright.plans.registry import query
from pricewright.schemas import LISTINGS
from pricewright.session import fresh_path
from pricewright.sources import readers, writers
from pricewright.sources.image_files import write_image_files

_LISTING_SQL = """SELECT id, parsing_date, designer, department, category, subcategory, n_photos, md5(item_name) AS item_md5,
       size, color, condition, md5(description) AS text_md5, nullif(hashtags, 'missing') AS hashtags, sold_price
       FROM {described}"""


def _listings(t):
    rows = t.described(*LISTINGS.fieldNames())
    return rows.withColumn("hashtags", F.nullif("hashtags", F.lit("missing"))).to(LISTINGS)


def _digest(rows):
    return rows.withColumns({"item_md5": F.md5("item_name"), "text_md5": F.md5("description")}).drop("item_name", "description")


@query("csv_round_trip", "SNK1 SRC1 SRC2", _LISTING_SQL)
def csv_round_trip(t):
    """Free text with quotes, commas and line breaks survives."""
    root = fresh_path(t.spark, "csv")
    writers.write_csv(_listings(t), f"{root}/raw/sold_listings")
    return _digest(readers.read_listings(t.spark, f"{root}/raw", "sold_listings"))


@query("json_lines_round_trip", "SNK2 SRC3", _LISTING_SQL)
def json_lines_round_trip(t):
    path = fresh_path(t.spark, "jsonl")
    writers.write_jsonl(_listings(t), path)
    return _digest(readers.read_json(t.spark, path))


@query(
    "listing_table_after_batches",
    "SNK3 JOI3",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
)
def listing_table_after_batches(t):
    """Three overlapping batches appended by key; an empty one writes nothing."""
    path = fresh_path(t.spark, "table")
    rows = t.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.append_batch(rows.where("o_orderkey % 3 = 0"), path, key="o_orderkey", partition_by="o_orderstatus")
    writers.append_batch(rows.where("o_orderkey % 2 = 0"), path, key="o_orderkey", partition_by="o_orderstatus")
    writers.append_batch(rows.where("o_orderkey < 0"), path, key="o_orderkey", partition_by="o_orderstatus")
    writers.append_batch(rows, path, key="o_orderkey", partition_by="o_orderstatus")
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "image_archive",
    "SNK4",
    "SELECT doc_id || '.webp' AS name, strlen(text)::BIGINT AS bytes FROM documents",
)
def image_archive(t):
    path = fresh_path(t.spark, "images")
    rows = t.documents().select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".webp")).alias("name"), F.col("text").cast("binary").alias("content"), "doc_id"
    )
    writers.append_images(rows.where("doc_id % 2 = 0"), path)
    writers.append_images(rows, path)
    return t.spark.read.parquet(path).select("name", F.length("content").cast("long").alias("bytes"))


@query(
    "image_files",
    "SRC5 SNK4 JOI3",
    "SELECT doc_id || '.webp' AS name, strlen(text)::BIGINT AS bytes, md5(text) AS content_md5 FROM documents WHERE strlen(text) > 0",
)
def image_files(t):
    """Two overlapping batches stored as a file each, read by the binary file source."""
    path = fresh_path(t.spark, "image-files")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".webp")).alias("name")
    rows = t.documents().select(name, F.col("text").cast("binary").alias("content"), "doc_id")
    write_image_files(rows.where("doc_id % 2 = 0"), path)
    write_image_files(rows, path)
    return readers.read_images(t.spark, path).select("name", F.length("content").cast("long").alias("bytes"), F.md5("content").alias("content_md5"))


@query(
    "request_log_table",
    "SNK6 SRC6 AGG14",
    """WITH r AS {requests} SELECT date_trunc('day', "timestamp")::DATE AS day, request_path, count(*) AS requests,
              count(*) FILTER (WHERE status_code >= 400) AS failed FROM r GROUP BY ALL""",
)
def request_log_table(t):
    path = fresh_path(t.spark, "request-log")
    writers.log_requests(t.requests(), path)
    log = readers.read_request_log(t.spark, path)
    return log.groupBy(F.to_date("timestamp").alias("day"), "request_path").agg(
        F.count("*").alias("requests"), F.count_if(F.col("status_code") >= 400).alias("failed")
    )


_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("estimator_class", T.StringType()),
        T.StructField("transformer_params.catboost_cols", T.ArrayType(T.StringType())),
        T.StructField("rmsle_eval", T.DoubleType()),
        T.StructField("_timestamp", T.TimestampType()),
    ]
)


@query(
    "sweep_export",
    "SRC7 SRC3",
    """SELECT run, estimator_class, array_to_string(catboost_cols, ',') AS cols, rmsle_eval, _timestamp FROM {runs}""",
)
def sweep_export(t):
    path = fresh_path(t.spark, "sweep")
    runs = t.runs()
    config = F.struct("run", "estimator_class", "`transformer_params.catboost_cols`")
    runs.select(config.alias("config"), F.struct("rmsle_eval", "_timestamp").alias("summary")).write.json(path)
    back = readers.sweep_runs(t.spark, path, _RUN_SCHEMA)
    return back.select(
        "run", "estimator_class", F.array_join("`transformer_params.catboost_cols`", ",").alias("cols"), "rmsle_eval",
        F.col("_timestamp").cast("timestamp_ntz").alias("_timestamp"),
    )
