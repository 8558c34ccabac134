"""Declared schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

LISTING_FIELDS = T.StructType(
    [
        T.StructField("designer", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("n_photos", T.IntegerType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("hashtags", T.StringType()),
    ]
)

LISTINGS = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("parsing_date", T.DateType())]
    + LISTING_FIELDS.fields
    + [T.StructField("sold_price", T.IntegerType())]
)

ERROR_CAUSE = T.StructType(
    [
        T.StructField("error", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("message", T.StringType()),
    ]
)

SCRAPE_ERRORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("parsing_date", T.DateType()),
        T.StructField("error_source", T.StringType()),
        T.StructField("error_cause", ERROR_CAUSE),
    ]
)

IMAGES = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())])

REQUESTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("client_ip", T.StringType()),
        T.StructField("request_path", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("error_detail", T.StringType()),
        T.StructField("user_agent", T.StringType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("prediction_id", T.StringType()),
        T.StructField("predicted_price", T.DoubleType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

TEXT_STATS_LONG = T.StructType(
    [
        T.StructField("text_feature", T.StringType()),
        T.StructField("sold_price", T.IntegerType()),
        T.StructField("stat", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
