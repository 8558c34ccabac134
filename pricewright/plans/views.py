"""Listing-shaped views over the driver tables, once for Spark and once as SQL.

The Spark builders join only the tables whose columns are asked for, so a query
on price alone scans one column of one table. Foreign keys of the driver tables
are total and dimension keys unique, so leaving a join out keeps all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.operators.partitioning import spread_small
from pricewright.sources.writers import is_folder


def whole_dollars(amount: Column) -> Column:
    return F.round(amount).cast("int")


def _condition() -> Column:
    return (
        F.when(F.col("l_returnflag") == "R", "Worn")
        .when(F.col("l_returnflag") == "A", "Used")
        .when(F.col("o_orderstatus") == "F", "Gently Used")
        .otherwise("New")
    )


# column -> (tables it needs beside lineitem, expression)
LISTING_COLUMNS = {
    "id": ("", lambda: F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
    "parsing_date": ("", lambda: F.col("l_shipdate").cast("date")),
    "sold_price": ("", lambda: whole_dollars(F.col("l_extendedprice"))),
    "department": ("", lambda: F.when(F.col("l_linestatus") == "O", "menswear").otherwise("womenswear")),
    "n_photos": ("", lambda: F.col("l_linenumber")),
    "designer": ("part", lambda: F.col("p_brand")),
    "color": ("part", lambda: F.substring_index("p_name", " ", 1)),
    "category": ("part", lambda: F.col("p_type")),
    "size": ("part", lambda: F.col("p_size").cast("string")),
    "subcategory": ("part orders customer", lambda: F.concat_ws("-", "p_type", "c_mktsegment")),
    "condition": ("orders", _condition),
}


class Tables:
    """The driver tables of one scale directory and the views built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The rows of a table as they arrive; a table is one file or a folder of files."""
        schema, path = self.table(name).schema, f"{self.sf_dir}/{name}.parquet"
        reader = self.spark.readStream.schema(schema)
        if is_folder(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)

    def listings(self, *columns: str) -> DataFrame:
        """Sold listings with the asked columns (all of them when none is named)."""
        columns = columns or tuple(LISTING_COLUMNS)
        needed = {t for c in columns for t in LISTING_COLUMNS[c][0].split()}
        rows = self.table("lineitem")
        if len(columns) > 2:
            # wide jobs on one small split; price-only jobs are cheaper where they are
            rows = spread_small(rows)
        if "part" in needed:
            rows = rows.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        if "orders" in needed:
            orders = self.table("orders")
            if "customer" in needed:
                orders = orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.select(*[LISTING_COLUMNS[c][1]().alias(c) for c in columns])

    def described(self, *columns: str) -> DataFrame:
        """Listings with text: documents priced and classified through part."""
        rows = self.documents() if "description" in columns or not columns else self.table("documents")
        from_part = {"sold_price", "designer", "color", "size", "category", "subcategory"}
        columns = columns or tuple(DESCRIBED_COLUMNS)
        if from_part & set(columns):
            rows = rows.join(self.table("part"), F.col("doc_id") == F.col("p_partkey"))
        return rows.select(*[DESCRIBED_COLUMNS[c]().alias(c) for c in columns])

    def documents(self) -> DataFrame:
        return spread_small(self.table("documents"))

    def requests(self) -> DataFrame:
        """Request log out of the event table."""
        return request_rows(self.table("events"))

    def vectors(self) -> DataFrame:
        return self.table("embeddings")

    def runs(self) -> DataFrame:
        """Sweep runs: one per order priority and month."""
        return sweep_run_rows(self.table("orders"))

    def pages(self) -> DataFrame:
        return spread_small(self.table("pages"))

    def images(self) -> DataFrame:
        """Image archive rows: one per document."""
        return self.table("documents").select(
            F.concat(F.col("doc_id").cast("string"), F.lit(".webp")).alias("name"), F.md5("text").alias("content"), "doc_id"
        )


DESCRIBED_COLUMNS = {
    "id": lambda: F.col("doc_id").cast("string"),
    "parsing_date": lambda: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")),
    "sold_price": lambda: whole_dollars(F.col("p_retailprice")),
    "designer": lambda: F.col("p_brand"),
    "department": lambda: F.when(F.col("lang") == "en", "menswear").otherwise("womenswear"),
    "category": lambda: F.col("p_type"),
    "subcategory": lambda: F.concat_ws("-", "p_type", "lang"),
    "n_photos": lambda: (1 + F.col("doc_id") % 12).cast("int"),
    "item_name": lambda: F.substring("text", 1, 60),
    "size": lambda: F.col("p_size").cast("string"),
    "color": lambda: F.substring_index("p_name", " ", 1),
    "condition": lambda: F.element_at(
        F.array(*[F.lit(c) for c in ("New", "Gently Used", "Used", "Worn")]), (F.col("doc_id") % 4 + 1).cast("int")
    ),
    "description": lambda: F.col("text"),
    "hashtags": lambda: F.when(F.col("doc_id") % 4 == 0, "missing").otherwise(F.concat_ws(" ", "lang", "source")),
}


def request_rows(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("client_ip"),
        F.concat(F.lit("/"), "event_type").alias("request_path"),
        F.lit("POST").alias("method"),
        F.col("value").alias("response_time"),
        F.when(F.col("event_type") == "error", 500).when(k >= 90, 404).otherwise(200).alias("status_code"),
        F.lit(None).cast("string").alias("error_detail"),
        F.lit("Unknown").alias("user_agent"),
    )


def sweep_run_rows(orders: DataFrame) -> DataFrame:
    priority = F.col("o_orderpriority")
    grouped = orders.groupBy(priority, F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(
        F.min("o_orderdate").cast("timestamp").alias("_timestamp"),
        F.avg(whole_dollars(F.col("o_totalprice"))).alias("a"),
        F.min(whole_dollars(F.col("o_totalprice"))).cast("double").alias("m"),
        F.count("*").alias("n"),
    )
    columns = (
        F.when(priority == "1-URGENT", F.array(*map(F.lit, ("subcategory", "size"))))
        .when(priority == "2-HIGH", F.array(*map(F.lit, ("designer", "color"))))
        .otherwise(F.array(*map(F.lit, ("subcategory", "size", "designer", "color"))))
    )
    return grouped.select(
        F.concat_ws("/", priority, F.col("month").cast("string")).alias("run"),
        priority.alias("sweep"),
        "_timestamp",
        F.when(F.month("month") % 2 == 0, "catboost").otherwise("ridge").alias("estimator_class"),
        (priority != "5-LOW").alias("use_tab_features"),
        (priority != "1-URGENT").alias("use_text_features"),
        columns.alias("transformer_params.catboost_cols"),
        (F.month("month") > 6).alias("transformer_params.normalize_size"),
        F.bround(F.col("a") / F.lit(400000.0), 3).alias("rmsle_train"),
        F.bround((F.col("a") + F.col("m")) / F.lit(400000.0), 3).alias("rmsle_eval"),
        F.bround(F.col("m") / F.lit(20000.0), 2).alias("wape_train"),
        F.bround((F.col("m") + F.col("n")) / F.lit(20000.0), 2).alias("wape_eval"),
    )


LISTINGS_SQL = """(
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         CAST(l_shipdate AS DATE) AS parsing_date,
         CAST(round(l_extendedprice) AS INTEGER) AS sold_price,
         CASE WHEN l_linestatus = 'O' THEN 'menswear' ELSE 'womenswear' END AS department,
         l_linenumber AS n_photos, p_brand AS designer, split_part(p_name, ' ', 1) AS color, p_type AS category,
         CAST(p_size AS VARCHAR) AS size, p_type || '-' || c_mktsegment AS subcategory,
         CASE WHEN l_returnflag = 'R' THEN 'Worn' WHEN l_returnflag = 'A' THEN 'Used'
              WHEN o_orderstatus = 'F' THEN 'Gently Used' ELSE 'New' END AS condition
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey)"""

DESCRIBED_SQL = """(
  SELECT CAST(doc_id AS VARCHAR) AS id, DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS parsing_date,
         CAST(round(p_retailprice) AS INTEGER) AS sold_price, p_brand AS designer,
         CASE WHEN lang = 'en' THEN 'menswear' ELSE 'womenswear' END AS department, p_type AS category,
         p_type || '-' || lang AS subcategory, CAST(1 + doc_id % 12 AS INTEGER) AS n_photos,
         substr(text, 1, 60) AS item_name, CAST(p_size AS VARCHAR) AS size, split_part(p_name, ' ', 1) AS color,
         ['New', 'Gently Used', 'Used', 'Worn'][doc_id % 4 + 1] AS condition, text AS description,
         CASE WHEN doc_id % 4 = 0 THEN 'missing' ELSE lang || ' ' || source END AS hashtags
  FROM documents JOIN part ON doc_id = p_partkey)"""

REQUESTS_SQL = """(
  SELECT event_id AS id, ts AS "timestamp", '10.0.0.' || user_id AS client_ip, '/' || event_type AS request_path,
         value AS response_time,
         CASE WHEN event_type = 'error' THEN 500
              WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90 THEN 404 ELSE 200 END AS status_code
  FROM events)"""

RUNS_SQL = """(
  SELECT o_orderpriority || '/' || CAST(month AS VARCHAR) AS run, o_orderpriority AS sweep, _timestamp,
         CASE WHEN month(month) % 2 = 0 THEN 'catboost' ELSE 'ridge' END AS estimator_class,
         o_orderpriority <> '5-LOW' AS use_tab_features, o_orderpriority <> '1-URGENT' AS use_text_features,
         CASE WHEN o_orderpriority = '1-URGENT' THEN ['subcategory', 'size']
              WHEN o_orderpriority = '2-HIGH' THEN ['designer', 'color']
              ELSE ['subcategory', 'size', 'designer', 'color'] END AS catboost_cols,
         month(month) > 6 AS normalize_size,
         round_even(a / 400000.0, 3) AS rmsle_train, round_even((a + m) / 400000.0, 3) AS rmsle_eval,
         round_even(m / 20000.0, 2) AS wape_train, round_even((m + n) / 20000.0, 2) AS wape_eval
  FROM (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
               min(o_orderdate) AS _timestamp,
               CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) / count(*) AS a,
               CAST(min(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS m, count(*) AS n
        FROM orders GROUP BY 1, 2))"""

SQL_VIEWS = {
    "{listings}": LISTINGS_SQL,
    "{described}": DESCRIBED_SQL,
    "{requests}": REQUESTS_SQL,
    "{runs}": RUNS_SQL,
}



def fill_sql(sql: str) -> str:
    from pricewright.plans.sql_text import TEXT_MACROS

    for name, body in {**TEXT_MACROS, **SQL_VIEWS}.items():
        sql = sql.replace(name, body)
    return sql.strip()
