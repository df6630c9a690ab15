"""Folders and files as executors see them, so that no list of files goes through the driver.

A folder that all machines mount is read as it is, other addresses through
pyarrow's file systems. Where pyarrow can't open a store there is no ``Store``,
and callers fall back on Spark's readers, which list on the driver.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The scheme and host of an address.
PREFIX = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"
#: A batch of contents is handed on when it has so many bytes or files.
BATCH_BYTES, BATCH_FILES = 4 << 20, 1_000


def address_of(path: str, base: str, here: str) -> str:
    """``path`` as Hadoop writes it: with the scheme of ``base`` (the default store) where it names none, and absolute."""
    prefix = re.match(PREFIX, path).group()
    rest = path[len(prefix) :]
    prefix = prefix or base
    if prefix.startswith("file:"):
        prefix = "file:"
        rest = rest if rest.startswith("/") else f"{here}/{rest}"
    return prefix + re.sub("/+", "/", rest if rest.startswith("/") else f"/{rest}").rstrip("/")


class Store:
    """The store of one address prefix, opened where it is used."""

    def __init__(self, prefix: str):
        self.prefix, self.local = prefix, prefix.startswith("file:")
        if not self.local:
            from pyarrow import fs

            self.fs, self.base = fs.FileSystem.from_uri(prefix)

    def inner(self, address: str) -> str:
        rest = address[len(self.prefix) :] or "/"
        return rest if self.local else f"{self.base.rstrip('/')}{rest}"

    def folders(self, root: str) -> Iterator[str]:
        """Names of the folders directly below ``root``."""
        if self.local:
            with os.scandir(self.inner(root)) as entries:
                yield from (e.name for e in entries if e.is_dir())
            return
        from pyarrow import fs

        yield from (i.base_name for i in self.fs.get_file_info(fs.FileSelector(self.inner(root))) if i.type == fs.FileType.Directory)

    def files(self, folder: str) -> list[tuple[str, int]] | str:
        """(name, bytes) of the files directly in a folder, or why there are none. Checksum files of Hadoop's local store aren't files of the folder."""
        inner = self.inner(folder)
        if self.local:
            try:
                with os.scandir(inner) as entries:
                    found = [(e.name, e.stat().st_size) for e in entries if e.is_file() and not (e.name.startswith(".") and e.name.endswith(".crc"))]
            except FileNotFoundError:
                return "not_found"
            except NotADirectoryError:
                # A path below a file isn't there; the file itself is no folder.
                return "not_a_directory" if os.path.exists(inner) else "not_found"
            return found or "no_files"
        from pyarrow import fs

        kind = self.fs.get_file_info(inner).type
        if kind != fs.FileType.Directory:
            return "not_found" if kind == fs.FileType.NotFound else "not_a_directory"
        return [(i.base_name, i.size) for i in self.fs.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File] or "no_files"

    def read(self, path: str) -> bytes:
        if self.local:
            with open(self.inner(path), "rb") as f:
                return f.read()
        with self.fs.open_input_stream(self.inner(path)) as f:
            return f.read()


class Stores:
    """Stores by prefix, each opened once."""

    def __init__(self):
        self.known = {}

    def of(self, address: str) -> Store:
        prefix = re.match(PREFIX, address).group()
        if prefix not in self.known:
            self.known[prefix] = Store(prefix)
        return self.known[prefix]


def can_open(address: str) -> bool:
    try:
        Store(re.match(PREFIX, address).group())
    except (ImportError, OSError, ValueError, NotImplementedError):
        return False
    return True


def addresses(spark: SparkSession):
    """A function that makes an address of a path, by the default store and the folder of the driver."""
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString().rstrip("/")
    here = os.getcwd()
    return lambda path: address_of(path, default, here)


def all_open(spark: SparkSession, paths: DataFrame) -> bool:
    """Whether executors can open every store that the one column of ``paths`` names; a row a store comes to the driver."""
    own = addresses(spark)
    prefix = F.regexp_extract(paths.columns[0], f"({PREFIX})", 1).alias("p")
    return all(can_open(own(r.p or "/")) for r in paths.filter(F.col(paths.columns[0]).isNotNull()).select(prefix).distinct().collect())


def spread(rows: DataFrame, *keys: str, least: int = 1) -> DataFrame:
    """Rows over all cores: small rows that stand for much work would else be put together into a few tasks."""
    return rows.repartition(max(least, 4 * rows.sparkSession.sparkContext.defaultParallelism), *keys)


def folders_below(spark: SparkSession, root: str) -> DataFrame:
    """(folder): addresses of the folders directly below ``root``; one task streams their names."""
    top = addresses(spark)(root)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names = []
            for name in Stores().of(top).folders(top):
                names.append(f"{top}/{name}")
                if len(names) == BATCH_FILES:
                    yield pa.RecordBatch.from_pydict({"folder": names})
                    names = []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["folder"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, "folder string")


def listed(folders: DataFrame) -> DataFrame:
    """(book_id, folder, path, name, length, reason) of a column of folders: a row a file, or one with the reason why there is none."""
    own = addresses(folders.sparkSession)

    def run(batches):
        stores = Stores()
        for batch in batches:
            out = []
            for folder in batch.column(0).to_pylist():
                at = own(folder)
                book, found = at.rsplit("/", 1)[-1], stores.of(at).files(at)
                out += [(book, folder, None, None, None, found)] if isinstance(found, str) else [(book, folder, f"{at}/{name}", name, size, None) for name, size in found]
                if len(out) >= BATCH_FILES:
                    yield _rows(out)
                    out = []
            yield _rows(out)

    return spread(folders).mapInArrow(run, "book_id string, folder string, path string, name string, length long, reason string")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 6
    kinds = [pa.int64() if i == 4 else pa.string() for i in range(6)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["book_id", "folder", "path", "name", "length", "reason"])


def with_content(rows: DataFrame) -> DataFrame:
    """``rows`` (path and others) with the column content; null where a file is empty. A file that has gone is an error."""
    own = addresses(rows.sparkSession)

    def run(batches):
        stores = Stores()
        for batch in batches:
            begin, held, size = 0, [], 0
            for i, path in enumerate(batch.column("path").to_pylist()):
                at = None if path is None else own(path)
                held.append((stores.of(at).read(at) or None) if at else None)
                size += len(held[-1] or b"")
                if size >= BATCH_BYTES or len(held) == BATCH_FILES:
                    yield _beside(batch.slice(begin, len(held)), held)
                    begin, held, size = i + 1, [], 0
            yield _beside(batch.slice(begin, len(held)), held)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return spread(rows, "path").mapInArrow(run, f"{kinds}, content binary")


def _beside(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(held, pa.binary())], [*batch.schema.names, "content"])
