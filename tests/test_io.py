import datetime
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from pricewright.operators.select import transform_listings
from pricewright.schemas import LISTINGS, REQUESTS
from pricewright.sources import readers, writers
from pricewright.sources.image_files import write_image_files
from pricewright.streaming import flows

DAY = datetime.date(2024, 1, 1)


def listing(i, **change):
    row = dict(id=str(i), parsing_date=DAY, designer="acme", department="menswear", category="tops", subcategory="polos",
               n_photos=3, item_name='say "hi", twice', size="Men's / US M", color="red", condition="New",
               description="two\nlines", hashtags=None, sold_price=100 + i)
    row.update(change)
    return tuple(row[f] for f in LISTINGS.fieldNames())


@pytest.fixture
def listings(spark):
    return spark.createDataFrame([listing(i) for i in range(6)], LISTINGS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_csv_round_trip_and_search(spark, listings, tmp_path):
    writers.write_csv(listings, f"{tmp_path}/a/b/sold.csv")
    assert rows(readers.read_listings(spark, f"{tmp_path}/a/b/sold.csv")) == rows(listings)
    assert rows(readers.read_listings(spark, f"{tmp_path}/a/b", "sold.csv")) == rows(listings)
    part = next(f for f in os.listdir(f"{tmp_path}/a/b/sold.csv") if f.endswith(".csv"))
    assert readers.read_listings(spark, str(tmp_path), part).count() > 0
    with pytest.raises(FileNotFoundError):
        readers.read_listings(spark, str(tmp_path), "none.csv")


def test_csv_name_found_twice(spark, tmp_path):
    for folder in ("x", "y"):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "same.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="more than once"):
        readers.read_listings(spark, str(tmp_path), "same.csv")


def test_object_store_needs_bucket_and_credentials(spark):
    with pytest.raises(ValueError):
        readers.require_object_store(spark, None)
    with pytest.raises(OSError):
        readers.require_object_store(spark, "bucket")


def test_json_forms(spark, listings, tmp_path):
    writers.write_jsonl(listings, f"{tmp_path}/lines")
    assert rows(readers.read_json(spark, f"{tmp_path}/lines")) == rows(listings)
    (tmp_path / "array.json").write_text(json.dumps([{"id": "1", "sold_price": 5}, {"id": "2", "hashtags": "a"}]))
    got = readers.read_json(spark, f"{tmp_path}/array.json", lines=False)
    assert {r["id"]: (r["sold_price"], r["hashtags"]) for r in got.collect()} == {"1": (5, None), "2": (None, "a")}


def test_images_append_only_new_names(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.webp").write_bytes(bytes([i]))
    images = readers.read_images(spark, str(tmp_path))
    store = f"{tmp_path}/store"
    assert writers.append_images(images.where("name < '2'"), store)
    assert writers.append_images(images, store)
    assert not writers.append_images(images, store)
    assert {(r["name"], bytes(r["content"])) for r in spark.read.parquet(store).collect()} == {
        (f"{i}.webp", bytes([i])) for i in range(3)
    }


def test_append_batch(spark, listings, tmp_path):
    path = f"{tmp_path}/table"
    assert not writers.append_batch(listings.limit(0), path)
    assert writers.append_batch(listings.where("sold_price < 103"), path, key="id")
    assert writers.append_batch(listings, path, key="id")
    assert spark.read.parquet(path).count() == 6
    assert writers.append_batch(listings, path)
    assert spark.read.parquet(path).count() == 12


def test_request_log_keeps_failures(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1, 12)
    log = spark.createDataFrame(
        [(1, at, "1.1.1.1", "/a", "POST", 0.2, 200, None, None), (2, at, "1.1.1.1", "/b", "POST", 0.1, None, "boom", "ua")], REQUESTS
    )
    writers.log_requests(log, f"{tmp_path}/log")
    got = {r["id"]: (r["status_code"], r["error_detail"], r["user_agent"]) for r in readers.read_request_log(spark, f"{tmp_path}/log").collect()}
    assert got == {1: (200, None, "Unknown"), 2: (500, "boom", "ua")}


def test_sweep_export(spark, tmp_path):
    runs = [{"config": {"estimator_class": "ridge", "transformer_params.catboost_cols": ["size"]}, "summary": {"rmsle_eval": 0.7}},
            {"config": {"estimator_class": "lr"}, "summary": {"rmsle_eval": 0.8, "estimator_class": "lr2"}}]
    (tmp_path / "runs.json").write_text("\n".join(map(json.dumps, runs)))
    schema = T.StructType([T.StructField("estimator_class", T.StringType()), T.StructField("rmsle_eval", T.DoubleType()),
                           T.StructField("transformer_params.catboost_cols", T.ArrayType(T.StringType()))])
    got = readers.sweep_runs(spark, f"{tmp_path}/runs.json", schema)
    assert rows(got) == [("lr2", 0.8, None), ("ridge", 0.7, ["size"])]
    (tmp_path / "none.json").write_text("")
    empty = readers.sweep_runs(spark, f"{tmp_path}/none.json", schema)
    assert empty.count() == 0 and empty.columns == got.columns


def test_ingest_stream_equals_batch(spark, tmp_path):
    source, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    first = spark.createDataFrame([listing(i) for i in range(4)], LISTINGS)
    second = spark.createDataFrame([listing(i, parsing_date=datetime.date(2024, 1, 2)) for i in range(3, 8)], LISTINGS)
    first.write.mode("append").json(source)
    flows.ingest_stream(flows.listing_stream(spark, source), out, checkpoint).awaitTermination()
    second.write.mode("append").json(source)
    flows.ingest_stream(flows.listing_stream(spark, source), out, checkpoint).awaitTermination()
    stored = spark.read.parquet(out)
    expected = transform_listings(first.unionByName(second.where("id > '3'")))
    columns = ["id", "size", "hashtags", "sold_price"]
    assert rows(stored.select(columns)) == rows(expected.select(columns))
    assert {r["size"] for r in stored.collect()} == {"M"}


def test_usage_windows_stream_equals_table(spark, tmp_path):
    log = spark.range(500).select(
        "id", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
        F.concat(F.lit("/p"), (F.col("id") % 2).cast("string")).alias("request_path"),
        (F.col("id") % 10).cast("double").alias("response_time"), F.when(F.col("id") % 5 == 0, 500).otherwise(200).alias("status_code"),
    )
    log.write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    flows.usage_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "1 hour").awaitTermination()
    closed = flows.usage_windows(log, "1 hour").where("end <= timestamp'2024-01-01 08:09:00'")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(closed)
    assert closed.count() == 16


def test_ingest_stream_keeps_late_files(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("late", "late-out", "late-checkpoint"))
    days = ["2024-03-01", "2024-03-03", "2024-01-15", "2024-01-16"]
    for k, day in enumerate(days):
        rows = [(f"{k}-{i}" if i else "same", day) for i in range(10)]
        spark.createDataFrame(rows, "id string, parsing_date string").coalesce(1).write.mode("append").json(source)
    stream = flows.listing_stream(spark, source, files_per_trigger=1)
    flows.ingest_stream(stream, out, checkpoint).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.select("id").distinct().count() == stored.count() == 37
    assert stored.select("batch").distinct().count() == 4


def test_one_per_key_keeps_the_earliest_row(spark):
    rows = spark.createDataFrame(
        [("a", "z", 3), ("a", "y", 2), ("a", "x", 2), ("b", None, 1), (None, "n", 5), (None, "m", 5)], "id string, title string, parsing_date int"
    )
    kept = {tuple(r) for r in writers.one_per_key(rows, "id", "parsing_date").collect()}
    assert kept == {("a", "x", 2), ("b", None, 1), (None, "m", 5)}
    assert writers.one_per_key(rows.select("id"), "id").count() == 3


def test_usage_updates_add_up(spark, tmp_path):
    """Files out of order and late rows; a second run over new files replaces the windows it touches."""
    log, out, checkpoint = f"{tmp_path}/log", f"{tmp_path}/usage", f"{tmp_path}/check"
    hours = [9, 1, 30, 1, 9, 50, 2, 30]

    def rows(ids):
        return spark.createDataFrame(
            [(i, hours[i % 8], f"/p{i % 3}", float(i), 500 if i % 5 == 0 else 200) for i in ids], "id long, hour int, request_path string, response_time double, status_code int"
        ).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, hour) AS timestamp", "request_path", "response_time", "status_code")

    for part in range(4):
        rows(range(part * 10, part * 10 + 10)).coalesce(1).write.mode("append").parquet(log)
    stream = lambda: spark.readStream.schema(spark.read.parquet(log).schema).option("maxFilesPerTrigger", 1).parquet(log)

    def agree(n):
        wanted = flows.usage_windows(rows(range(n)), "1 day", None)
        found = flows.read_usage(spark, out)
        assert found.columns == wanted.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
        assert found.agg(F.sum("requests")).first()[0] == n

    flows.usage_updates(stream(), out, checkpoint).awaitTermination()
    agree(40)
    assert spark.read.parquet(out).select("batch").distinct().count() == 4
    rows(range(40, 45)).coalesce(1).write.mode("append").parquet(log)
    flows.usage_updates(stream(), out, checkpoint).awaitTermination()
    agree(45)
    flows.usage_updates(stream(), out, checkpoint).awaitTermination()
    agree(45)
    flows.compact_usage(spark, out, f"{tmp_path}/compact")
    assert spark.read.parquet(f"{tmp_path}/compact").count() == flows.read_usage(spark, out).count()


def test_image_files(spark, tmp_path):
    schema = "name string, content binary, page int"
    long = bytes(range(256)) * 5_000
    batch = spark.createDataFrame([("a.webp", b"one", 1), ("b c.webp", None, 2), ("a.webp", b"two", 3), ("d.png", long, 4)], schema)
    path = f"{tmp_path}/images"
    write_image_files(batch, path)
    stored = {r["name"]: bytes(r["content"]) for r in readers.read_images(spark, path, "*").collect()}
    assert stored == {"a.webp": b"one", "d.png": long}
    assert {f: os.path.getsize(f"{path}/{f}") for f in os.listdir(path)} == {"a.webp": 3, "b c.webp": 0, "d.png": len(long)}
    # stored images stay as they are; a batch without rows adds none
    write_image_files(spark.createDataFrame([("a.webp", b"new", 1), ("e.webp", b"five", 1)], schema), path)
    write_image_files(batch.where("false"), path)
    assert {r["name"]: bytes(r["content"]) for r in readers.read_images(spark, path).collect()} == {"a.webp": b"one", "e.webp": b"five"}
    for name in (None, "", "../up.webp", "_hidden", ".hidden"):
        with pytest.raises(Exception, match="no name for an image file"):
            write_image_files(spark.createDataFrame([(name, b"x", 1)], schema), path)


def test_many_image_files_are_read_by_few_tasks(spark, tmp_path):
    path = f"{tmp_path}/images"
    batch = spark.range(200).selectExpr("concat(id, '.webp') AS name", "cast(cast(id AS string) AS binary) AS content")
    write_image_files(batch, path)
    found = readers.read_images(spark, path, tasks=2)
    assert found.rdd.getNumPartitions() == 2
    assert {r["name"]: bytes(r["content"]) for r in found.collect()} == {f"{k}.webp": str(k).encode() for k in range(200)}
    assert sorted(os.listdir(path)) == sorted(f"{k}.webp" for k in range(200))


def test_streams_read_tables_stored_as_folders(spark, tmp_path):
    from pricewright.plans.views import Tables

    rows = spark.range(20).withColumn("text", F.lit("x"))
    rows.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows.write.parquet(f"{tmp_path}/single")
    part = next(p for p in (tmp_path / "single").iterdir() if p.name.endswith(".parquet"))
    (tmp_path / "events.parquet").write_bytes(part.read_bytes())
    tables = Tables(spark, str(tmp_path))
    for name in ("documents", "events"):
        out = f"{tmp_path}/out-{name}"
        flows.append_stream(tables.stream(name), out, f"{tmp_path}/checkpoint-{name}").awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted(r["id"] for r in tables.table(name).collect())
