"""Sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricewright.schemas import IMAGES, LISTINGS, REQUESTS
from pricewright.sources.writers import CSV_TEXT, path_exists

# Tasks that read a folder of small files, for each core.
TASKS_PER_CORE = 16


def _files_named(spark: SparkSession, root: str, name: str) -> list[str]:
    """Files of that name below a folder, on whichever file system it names."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    if fs.exists(base):
        walk = fs.listFiles(base, True)
        while walk.hasNext():
            path = walk.next().getPath()
            if path.getName() == name:
                found.append(path.toString())
    return sorted(found)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with quoted line breaks; such files are read whole per task, so write many of them."""
    return (
        spark.read.schema(schema)
        .options(**CSV_TEXT)
        .option("multiLine", True)
        .option("enforceSchema", False)
        .csv(paths)
    )


def read_listings(spark: SparkSession, root: str, name: str | None = None, schema: T.StructType = LISTINGS) -> DataFrame:
    """A CSV dataset by file name anywhere below a root, or by exact path.

    Works on any file system Spark reads (``s3a://`` included). A missing file is
    an error, and so are several files of the same name. ``name`` may also be the
    folder of a partitioned CSV written by Spark.
    """
    if name is None:
        if not path_exists(spark, root):
            raise FileNotFoundError(f"no folder or file {root}")
        return read_csv(spark, root, schema)
    found = _files_named(spark, root, name)
    if not found and path_exists(spark, f"{root}/{name}"):
        found = [f"{root}/{name}"]
    if not found:
        raise FileNotFoundError(f"nothing named {name} below {root}")
    if len(found) > 1:
        raise ValueError(f"{name} was found more than once: {found}")
    return read_csv(spark, found[0], schema)


def require_object_store(spark: SparkSession, bucket: str | None) -> str:
    """``s3a://`` root of a bucket, or an error when bucket or credentials are not set."""
    if not bucket:
        raise ValueError("reading from an object store needs a bucket")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    explicit = conf.get("fs.s3a.access.key") and conf.get("fs.s3a.secret.key")
    if not explicit and not spark.conf.get("spark.hadoop.fs.s3a.aws.credentials.provider", None):
        raise OSError("the Spark configuration holds no object-store credentials")
    return f"s3a://{bucket}"


def read_json(spark: SparkSession, path: str, lines: bool = True, schema: T.StructType = LISTINGS) -> DataFrame:
    """JSON lines, or one JSON array per file."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_images(spark: SparkSession, path: str, pattern: str = "*.webp", tasks: int | None = None) -> DataFrame:
    """Image files as (name, content), read by at most ``tasks`` tasks (some for each core, unless given).

    Spark counts a small file as four megabytes, so it would start a task for every 32 of them.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    raw = raw.coalesce(tasks or TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return raw.select(F.substring_index("path", "/", -1).alias("name"), "content").to(IMAGES)


def read_request_log(
    spark: SparkSession, path: str | None = None, url: str | None = None, table: str = "api_requests",
    properties: dict | None = None,
) -> DataFrame:
    """Request log from a parquet table, or from a database through JDBC."""
    if path is not None:
        return spark.read.schema(REQUESTS).parquet(path)
    if url is None:
        raise ValueError("give a path or a JDBC url")
    return spark.read.jdbc(url, table, properties=properties or {}).select(*REQUESTS.fieldNames())


def sweep_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Exported runs (one JSON object per line with ``config`` and ``summary``) as flat rows.

    ``schema`` lists the wanted columns; dotted names are plain column names here.
    A column is taken from the summary where present, else from the configuration.
    """
    quoted = T.StructType([T.StructField("config", schema), T.StructField("summary", schema)])
    rows = spark.read.schema(quoted).json(path)
    return rows.select(
        *[F.coalesce(F.col(f"summary.`{f.name}`"), F.col(f"config.`{f.name}`")).alias(f.name) for f in schema.fields]
    )
