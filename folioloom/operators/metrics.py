"""Sizes and counts of books, as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioloom.functions import base64_unbroken, extension_of, megabytes, present


def disk_sizes(files: DataFrame) -> DataFrame:
    """Files, bytes and MB of each book on disk, and its set of suffixes, sorted and joined."""
    return files.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("disk_bytes"),
        megabytes(F.sum("length")).alias("disk_mb"),
        F.array_join(F.array_sort(F.collect_set(extension_of("name"))), " ").alias("extensions"),
    )


def image_sizes(gathered: DataFrame) -> DataFrame:
    """Pictures, bytes and base64 characters of each gathered book; base64 is counted, never stored."""
    total = lambda each: F.aggregate(F.transform("images_data", each), F.lit(0).cast("long"), lambda a, x: a + x)
    return gathered.select(
        "book_id",
        F.size("images_data").cast("long").alias("n_images"),
        total(lambda d: F.octet_length(d).cast("long")).alias("binary_bytes"),
        total(lambda d: F.length(base64_unbroken(d)).cast("long")).alias("base64_chars"),
        megabytes(total(lambda d: F.octet_length(d).cast("long"))).alias("binary_mb"),
    )


def record_counts(catalogue: DataFrame) -> DataFrame:
    """How much each record holds: list lengths with null as 0, and which texts are there."""
    n = lambda c: F.coalesce(F.size(c).cast("long"), F.lit(0).cast("long"))
    return catalogue.select(
        "book_id",
        n("book_genre").alias("n_genres"),
        n("bookNERData").alias("n_names"),
        n("authors").alias("n_authors"),
        present("raw_analysis.coverPageDescription").alias("has_cover"),
        present("raw_analysis.colophonPageDescription").alias("has_colophon"),
    )


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``rows`` with counts that are filled in by whatever action runs over them: rows, failures, fallbacks."""
    seen = Observation(name)
    status = [c for c in rows.columns if c.endswith("_status")]
    counts = [F.count(F.when(~F.col(c).isin("ok", "success"), 1)).alias(f"not_ok_{c.removesuffix('_status')}") for c in status]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def stage_memory(spark: SparkSession) -> list[tuple[int, str, float]]:
    """(stage, name, MB) of the stages that this application still keeps: the greatest execution memory of a task of each."""
    jvm = spark._jvm
    held = spark._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return [(s.stageId(), s.name(), s.peakExecutionMemory() / (1024 * 1024)) for s in (held.apply(i) for i in range(held.size()))]
