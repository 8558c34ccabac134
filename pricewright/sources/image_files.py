"""A sink that stores each image as a file of its own, for use with ``readers.read_images``.

Tasks write through pyarrow's file systems. A file gets its name only when it is
whole, so a task that is run again, also at the same time, leaves the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pricewright.sources.readers import read_images
from pricewright.sources.writers import one_per_key, only_new, path_exists


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class ImageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "image_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> "ImageWriter":
        return ImageWriter(self.options["path"])


class ImageWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _opened(self.path)
        # folders whose name starts with an underscore are not read; tasks that create files in one folder wait for each other
        unfinished = f"{root}/_{uuid.uuid4().hex}"
        store.create_dir(unfinished, recursive=True)
        try:
            for batch in iterator:
                for name, content in zip(batch.column("name"), batch.column("content")):
                    with store.open_output_stream(f"{unfinished}/image") as out:
                        out.write(content.as_buffer() if content.is_valid else b"")
                    store.move(f"{unfinished}/image", f"{root}/{name.as_py()}")
        finally:
            store.delete_dir(unfinished)
        return WriterCommitMessage()


def write_image_files(new: DataFrame, path: str) -> None:
    """Store the images (name, content) that the folder does not hold yet.

    A null image is stored as an empty file; Spark's file sources list no empty
    files, so it is not among the images read. Of images with one name the one with
    the least content is stored. A null or empty name, and one that would leave the folder or
    be hidden in it, is an error.
    """
    spark = new.sparkSession
    spark.dataSource.register(ImageFiles)
    fault = F.col("name").isNull() | F.col("name").rlike("^$|^[._]|[/:\\n]")
    shown = F.concat(F.lit("no name for an image file: "), F.coalesce("name", F.lit("NULL")))
    named = new.select(F.when(fault, F.raise_error(shown).cast("string")).otherwise(F.col("name")).alias("name"), F.coalesce("content", F.lit(b"")).alias("content"))
    rows = one_per_key(named, "name")
    if path_exists(spark, path):
        rows = only_new(rows, read_images(spark, path, "*").select("name"), "name")
    rows.write.format("image_files").mode("append").save(path)
