"""Where results go: image files, JSON files, and the catalogue table."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions import image_file_name
from folioloom.plans.schemas import CATALOGUE
from folioloom.sources.stores import spread

#: Buckets of the catalogue; each holds the books of one hash, and an upsert rewrites only the buckets it touches.
BUCKETS = 64


def prepare_folder(spark: SparkSession, path: str) -> str:
    """Make a folder and its parents; nothing happens if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    return path


def image_files(images: DataFrame, extension: str = ".webp") -> DataFrame:
    """(book_id, file_name, data): images in order, numbered from 1 within their book."""
    number = F.row_number().over(W.partitionBy("book_id").orderBy("idx"))
    return images.select("book_id", image_file_name("book_id", number, extension).alias("file_name"), "data")


def save_images(images: DataFrame, out: str, extension: str = ".webp", books: DataFrame | None = None) -> None:
    """One folder per book with its numbered image files; what a book's folder held before is replaced. ``books`` names books whose folder is emptied even if they have no image now."""
    files = image_files(images, extension)
    if books is not None:
        none = books.select("book_id", F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("binary").alias("data"))
        files = files.unionByName(none)
    _write_files(files, out, replace_books=True)


def json_files(records: DataFrame, analysis: str, column: str = "record") -> DataFrame:
    """(book_id, file_name, data): the record of each book as indented JSON in UTF-8, nulls kept."""
    body = F.to_json(F.col(column), {"ignoreNullFields": "false", "pretty": "true"})
    return records.select("book_id", F.concat("book_id", F.lit(f"_{analysis}.json")).alias("file_name"), F.encode(body, "utf-8").alias("data"))


def save_json(records: DataFrame, analysis: str, out: str, column: str = "record") -> None:
    _write_files(json_files(records, analysis, column), out, replace_books=False)


def _write_files(files: DataFrame, out: str, replace_books: bool) -> None:
    """Write ``data`` to {out}/{book_id}/{file_name} from the executors, through the file system that the address ``out`` names.

    Each file is written under another name first and then moved, so a repeated
    task leaves whole files only. A path without scheme must be a folder that
    executors mount; a scheme that no file system here knows is an error.
    """
    from pyarrow import fs

    known = bool(re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", out))

    def opened() -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(out) if known and not out.startswith("file:") else (fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", out))

    opened()  # an unknown scheme fails here, before any task

    def put(rows) -> None:
        store, root = opened()
        cleared = set()
        for row in rows:
            folder = f"{root.rstrip('/')}/{row.book_id}"
            if row.book_id not in cleared:
                if replace_books and store.get_file_info(folder).type == fs.FileType.Directory:
                    store.delete_dir(folder)
                store.create_dir(folder, recursive=True)
                cleared.add(row.book_id)
            if row.file_name is None:
                continue
            part = f"{folder}/.{row.file_name}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as f:
                f.write(row.data)
            store.move(part, f"{folder}/{row.file_name}")

    # All files of a book are one task's, so that replacing its folder can't lose another task's files.
    spread(files, "book_id", least=int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))).foreachPartition(put)


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _store(spark, path)
    return fs.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _store(spark, path)
    fs.delete(target, True)


def table_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a catalogue was written with; null where the table doesn't say."""
    if not _exists(spark, f"{path}/_buckets"):
        return None
    fs, target = _store(spark, f"{path}/_buckets")
    held = fs.open(target)
    try:
        return int("".join(chr(held.read()) for _ in range(fs.getFileStatus(target).getLen())))
    finally:
        held.close()


def _note_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    fs, target = _store(spark, f"{path}/_buckets")
    out = fs.create(target, True)
    out.write(bytearray(str(buckets).encode()))
    out.close()


def _replay(spark: SparkSession, path: str) -> None:
    """Finish an upsert that was cut off: its new buckets are whole beside the table, or it has changed nothing."""
    beside = f"{path.rstrip('/')}._pending"
    if _exists(spark, f"{beside}/_SUCCESS"):
        rows = spark.read.schema(_stored()).parquet(beside)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    _delete(spark, beside)


def _stored() -> T.StructType:
    return T.StructType([*CATALOGUE.fields, T.StructField("bucket", T.IntegerType())])


def write_catalogue(records: DataFrame, path: str, mode: str = "upsert", buckets: int = BUCKETS) -> None:
    """Write catalogue records once, one row per book_id.

    mode 'upsert' replaces books that are there and adds the others; it rewrites
    only the buckets of the new books, by the number of buckets the table was
    written with (``buckets`` counts for new tables only). The new buckets are
    written beside the table first; a run that ends before they have taken their
    place is finished by the next one. 'append' adds without looking, 'overwrite'
    starts anew, 'error' fails if the table exists. Records without book_id, and
    but for 'append' several of one, are an error.
    """
    if mode not in ("upsert", "append", "overwrite", "error"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = records.sparkSession
    seen = records.groupBy("book_id").agg(F.count(F.lit(1)).alias("n")).filter("book_id is null" if mode == "append" else "book_id is null or n > 1").orderBy("book_id").limit(3).collect()
    if seen:
        raise ValueError(f"records without book_id, or several of one: {[(r.book_id, r.n) for r in seen]}")
    _replay(spark, path)
    exists = _exists(spark, path)
    held = table_buckets(spark, path) if exists and mode in ("upsert", "append") else buckets
    if held is None:
        raise ValueError(f"{path} doesn't say how many buckets it has; overwrite it once")
    rows = records.select([F.col(c).cast(CATALOGUE[c].dataType).alias(c) for c in CATALOGUE.names]).withColumn("bucket", F.pmod(F.xxhash64("book_id"), F.lit(held)).cast("int"))
    if mode != "upsert" or not exists:
        rows.write.mode({"upsert": "error"}.get(mode, mode)).partitionBy("bucket").parquet(path)
        _note_buckets(spark, path, held)
        return
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``held``
    old = spark.read.schema(_stored()).parquet(path).filter(F.col("bucket").isin(touched)).join(rows.select("book_id"), "book_id", "left_anti")
    # A partition can't be read and replaced in one job.
    old.select(*rows.columns).unionByName(rows).write.partitionBy("bucket").parquet(f"{path.rstrip('/')}._pending")
    _replay(spark, path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*CATALOGUE.names)


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, that of the greatest ``order``: what repeated upserts leave."""
    last = F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("_n", last).filter("_n = 1").drop("_n")


def written_twice(rows: DataFrame) -> DataFrame:
    """Every row two times, as a table has it whose creation loads the rows and which then adds them; for comparison only."""
    return rows.unionAll(rows)
