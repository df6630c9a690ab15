"""New book files as a stream; each micro-batch goes through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioloom.functions import book_of_path, name_of_path
from folioloom.sources.folders import SourceConfig, in_book_of, literal_glob, supported_files


def new_files(spark: SparkSession, root: str, config: SourceConfig = SourceConfig()) -> DataFrame:
    """A stream of supported files that appear in the folders below ``root``, with content."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).load(f"{literal_glob(root.rstrip('/'))}/*").filter(in_book_of("path", root))
    return supported_files(files.select(book_of_path("path").alias("book_id"), "path", name_of_path("path").alias("name"), "length", "content"), config)


def each_batch(files: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``apply(batch, id)`` on each batch of what is there now, then stop; a rerun goes on where this one ended.

    ``apply`` may see a batch again after a failure, so it should upsert.
    """
    return files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
