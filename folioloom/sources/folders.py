"""Book folders as a source: list, filter, classify, validate, load.

A book is a folder; its id is the folder's name. Listing never opens a file, so
filters on names and sizes come before any content is read.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.functions import book_of_path, extension_of, name_of_path
from folioloom.plans.providers import HttpProvider
from folioloom.plans.schemas import IMAGE_EXTENSIONS, PDF_EXTENSIONS
from folioloom.sources.stores import addresses, all_open, can_open, folders_below, listed, with_content

LISTING = "book_id string, path string, name string, length bigint"
REJECTS = "book_id string, folder string, reason string"


@dataclass(frozen=True)
class SourceConfig:
    """Which suffixes count; an empty list falls back to the default, all are compared in lower case."""

    image_extensions: tuple[str, ...] = ()
    pdf_extensions: tuple[str, ...] = ()

    @property
    def images(self) -> tuple[str, ...]:
        return tuple(e.lower() for e in (self.image_extensions or IMAGE_EXTENSIONS))

    @property
    def pdfs(self) -> tuple[str, ...]:
        return tuple(e.lower() for e in (self.pdf_extensions or PDF_EXTENSIONS))

    @property
    def supported(self) -> tuple[str, ...]:
        """All suffixes, sorted, each once."""
        return tuple(sorted({*self.images, *self.pdfs}))


@dataclass(frozen=True)
class Settings:
    """Provider keys and paths from the environment, read once on the driver."""

    api_key: str | None = None
    warehouse: str | None = None
    extra: dict = field(default_factory=dict)

    @staticmethod
    def load(env_file: str | None = None, environ: dict | None = None, prefix: str = "FOLIOLOOM_") -> Settings:
        """Values of ``environ`` (the process's by default) win over those of a KEY=VALUE file; a missing file is empty."""
        found: dict[str, str] = {}
        if env_file and os.path.isfile(env_file):
            with open(env_file, encoding="utf-8") as f:
                for line in f:
                    key, eq, value = line.strip().partition("=")
                    if eq and not key.startswith("#"):
                        found[key.strip()] = value.strip().strip("'\"")
        found |= dict(os.environ if environ is None else environ)
        own = {k.removeprefix(prefix).lower(): v for k, v in found.items() if k.startswith(prefix)}
        return Settings(own.pop("api_key", None), own.pop("warehouse", None), own)

    def provider(self) -> HttpProvider:
        """The provider that ``url`` and ``model`` name, with the key."""
        missing = [k for k in ("url", "model") if k not in self.extra]
        if missing:
            raise ValueError(f"settings lack {' and '.join(missing)}")
        return HttpProvider(self.extra["url"], self.extra["model"], self.api_key)


def list_folders(spark: SparkSession, folders: list[str] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files directly in each folder, and the folders that can't be used with the reason. ``folders`` is a list, or a table of one column.

    Executors list the folders, and the listing is kept in the folder that they
    share, so both results are of one look. Files of 0 bytes are listed, which
    ``binaryFile`` leaves out. Names are taken as they are: no mark in them is a
    pattern. Only a store that pyarrow can't open is listed by the driver, through
    Hadoop's file system and one folder after the other.
    """
    given = folders if isinstance(folders, DataFrame) else spark.createDataFrame([(f,) for f in folders], "folder string")
    if not all_open(spark, given):
        return _listed_by_driver(spark, [r[0] for r in given.collect()])
    rows = _kept(spark, listed(given))
    return rows.filter("reason is null").select("book_id", "path", "name", "length"), rows.filter("reason is not null").select("book_id", "folder", "reason")


def _kept(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows as they are now, in ``spark.checkpoint.dir``; without one, kept on the executors' disks at their first use."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return rows.persist(StorageLevel.DISK_ONLY)
    path = f"{shared.rstrip('/')}/folioloom/listing-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _listed_by_driver(spark: SparkSession, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files, rejects = [], []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs, book = path.getFileSystem(conf), path.getName()
        if not fs.exists(path):
            rejects.append((book, folder, "not_found"))
            continue
        if not fs.getFileStatus(path).isDirectory():
            rejects.append((book, folder, "not_a_directory"))
            continue
        own = [(book, s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.isFile()]
        if not own:
            rejects.append((book, folder, "no_files"))
        files += own
    return spark.createDataFrame(files, LISTING), spark.createDataFrame(rejects, REJECTS)


def literal_glob(path: str) -> str:
    """A pattern that matches just ``path``: Spark's readers take every path as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def in_book_of(path: str, root: str) -> Column:
    """Whether a path is a file of a folder directly below ``root``; files that lie in ``root`` itself are of no book."""
    bare = re.sub(r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "", root).rstrip("/")
    own = F.regexp_replace(path, r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "")
    return F.startswith(own, F.lit(f"{bare}/")) & (F.size(F.split(F.substring(own, F.lit(len(bare) + 2), F.length(own)), "/")) == 2)


def scan_root(spark: SparkSession, root: str) -> DataFrame:
    """Files directly in each folder below ``root``, listed by the executors; contents aren't opened. Empty and hidden files are left out, as Spark's readers leave them out."""
    if not can_open(addresses(spark)(root)):
        found = spark.read.format("binaryFile").load(f"{literal_glob(root.rstrip('/'))}/*").select("path", "length").filter(in_book_of("path", root))
        return found.select(book_of_path("path").alias("book_id"), "path", name_of_path("path").alias("name"), "length")
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top):
        raise FileNotFoundError(root)
    seen = (F.col("length") > 0) & ~F.col("name").rlike(r"^\.|^_(?!.*=)")
    return listed(folders_below(spark, root)).filter(seen).select("book_id", "path", "name", "length")


def load_files(spark: SparkSession, root: str) -> DataFrame:
    """``scan_root`` with the column content."""
    files = scan_root(spark, root)
    return with_content(files) if can_open(addresses(spark)(root)) else load_contents(spark, files)


def supported_files(files: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """Files with a supported suffix, with ``kind`` image or pdf."""
    ext = extension_of("name")
    kind = F.when(ext.isin(*config.pdfs), "pdf").when(ext.isin(*config.images), "image")
    return files.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def book_types(files: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """(book_id, data_type): pdf if any file is one, else images if any is one, else others."""
    ext = extension_of("name")
    kind = F.when(F.bool_or(ext.isin(*config.pdfs)), "pdf").when(F.bool_or(ext.isin(*config.images)), "images").otherwise("others")
    return files.groupBy("book_id").agg(kind.alias("data_type"))


def select_sources(files: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """The files a book is made of, in path order with ``idx`` from 0: its PDFs alone if it has any, else its images.

    One shuffle on book_id serves both the choice and the numbering.
    """
    mine = W.partitionBy("book_id")
    chosen = supported_files(files, config).withColumn("has_pdf", F.max((F.col("kind") == "pdf").cast("int")).over(mine) == 1).filter((F.col("kind") == "pdf") == F.col("has_pdf"))
    numbered = chosen.withColumn("idx", F.row_number().over(mine.orderBy("path")).cast("long") - 1)
    return numbered.select("book_id", "idx", "path", "name", "length", "kind")


def unsupported_books(files: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """Books with files, none of them supported, as rejects that name the suffixes."""
    reason = f"no_supported_files: {' '.join(config.supported)}"
    books = files.select("book_id").distinct()
    return books.join(supported_files(files, config).select("book_id").distinct(), "book_id", "left_anti").select("book_id", F.lit(None).cast("string").alias("folder"), F.lit(reason).alias("reason"))


def load_contents(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``sources`` with the column content, null for an empty file. Executors open the listed files and no others."""
    rows = sources.select("path", *[c for c in sources.columns if c != "path"])
    if all_open(spark, rows.select("path")):
        return with_content(rows)
    paths = [r.path for r in sources.select("path").distinct().collect()]  # Spark's scan takes its paths from the driver
    read = spark.read.format("binaryFile").load([literal_glob(p) for p in paths]).select("path", "content")
    return rows.join(read, "path", "left")


def any_case_glob(extensions: tuple[str, ...]) -> str:
    """A glob for names that end in one of the suffixes in any mix of cases: Hadoop's globs know cases, file names don't."""
    each = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    return "*{" + ",".join(each) + "}"


def load_root(spark: SparkSession, root: str, config: SourceConfig = SourceConfig()) -> DataFrame:
    """The sources of all books below ``root`` with content, without a list of paths on the driver.

    Files of other kinds are never opened. Empty files are left out, as
    ``binaryFile`` leaves them out. A store that pyarrow can't open is read by
    Spark, whose listing lies on the driver.
    """
    sources = select_sources(scan_root(spark, root), config)
    if can_open(addresses(spark)(root)):
        return with_content(sources.select("path", *[c for c in sources.columns if c != "path"]))
    read = spark.read.format("binaryFile").option("pathGlobFilter", any_case_glob(config.supported)).load(f"{literal_glob(root.rstrip('/'))}/*")
    return sources.join(read.select("path", "content"), "path")
