"""Images of books: decode, fit, encode, gather in order.

Codecs are pluggable. Pillow and PyMuPDF are used where they can be imported; a
codec that is missing is an error on the row, never another format in silence.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.functions import base64_unbroken
from folioloom.plans.schemas import IMAGES

#: Names of resampling filters that a config may use.
RESAMPLING = ("NEAREST", "BILINEAR", "BICUBIC", "LANCZOS")
#: Encoded pictures leave Python in frames of so many bytes or rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1_000


@dataclass(frozen=True)
class ImageConfig:
    """One encoder setting for all outputs; checked on the driver before any image is opened."""

    max_width: int = 800
    max_height: int = 800
    quality: int = 85
    webp_method: int = 4
    pdf_dpi: int = 150
    resampling: str = "LANCZOS"

    def __post_init__(self):
        if self.resampling.upper() not in RESAMPLING:
            raise ValueError(f"unknown resampling filter {self.resampling!r}")
        if not (self.max_width > 0 and self.max_height > 0 and 0 <= self.quality <= 100 and 0 <= self.webp_method <= 6 and self.pdf_dpi > 0):
            raise ValueError("image settings out of range")


class Codec(Protocol):
    """Turns the bytes of a source file into encoded pictures, one for an image and one a page for a PDF."""

    def pictures(self, content: bytes, is_pdf: bool, config: ImageConfig) -> Iterator[tuple[bytes, int, int]]: ...


class MissingCodec(RuntimeError):
    """The library for a format can't be imported here."""


class PillowCodec:
    """WEBP through Pillow, PDF pages through PyMuPDF."""

    def pictures(self, content: bytes, is_pdf: bool, config: ImageConfig) -> Iterator[tuple[bytes, int, int]]:
        try:
            from PIL import Image
        except ImportError as gone:
            raise MissingCodec("Pillow is needed to decode and encode images") from gone
        if not is_pdf:
            with Image.open(io.BytesIO(content)) as picture:
                yield self._encoded(picture if picture.mode == "RGB" else picture.convert("RGB"), config, Image)
            return
        try:
            import fitz
        except ImportError as gone:
            raise MissingCodec("PyMuPDF is needed to render PDF pages") from gone
        with fitz.open(stream=content, filetype="pdf") as document:
            for page in document:
                drawn = page.get_pixmap(dpi=config.pdf_dpi)
                yield self._encoded(Image.frombytes("RGB", (drawn.width, drawn.height), drawn.samples), config, Image)

    @staticmethod
    def _encoded(picture, config: ImageConfig, library) -> tuple[bytes, int, int]:
        picture = picture.copy()
        picture.thumbnail((config.max_width, config.max_height), library.Resampling[config.resampling.upper()])
        held = io.BytesIO()
        picture.save(held, format="WEBP", quality=config.quality, method=config.webp_method)
        return held.getvalue(), picture.width, picture.height


class PassThroughCodec:
    """Hands files on as they are; for tests and for stores that hold finished images. A PDF counts its page objects."""

    def pictures(self, content: bytes, is_pdf: bool, config: ImageConfig) -> Iterator[tuple[bytes, int, int]]:
        if not content:
            raise ValueError("empty file")
        pages = content.count(b"/Type /Page\n") if is_pdf else 1
        for _ in range(pages):
            yield content, 0, 0


def process_images(sources: DataFrame, config: ImageConfig = ImageConfig(), codec: Codec | None = None) -> DataFrame:
    """One row per picture of ``sources`` (book_id, idx, path, kind, content), in the long form of IMAGES.

    PDF pages follow the order of files, then of pages; idx is renumbered by
    ``gather_images``. A file that can't be read gives one row with status
    'failed' and the error; a PDF without pages gives none.
    """
    codec = codec or PillowCodec()

    def rows_of(row):
        page = -1
        try:
            if row.content is None:
                raise FileNotFoundError("the file could not be read")
            for page, (data, width, height) in enumerate(codec.pictures(bytes(row.content), row.kind == "pdf", config)):
                yield row.book_id, row.idx, row.path, page, data, width, height, "ok", None
        except Exception as error:
            yield row.book_id, row.idx, row.path, page + 1, None, None, None, "failed", f"{type(error).__name__}: {error}"

    def run(batches):
        # A frame for each picture would cost more than most codecs do; one for all would hold a whole PDF.
        out, size = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                for found in rows_of(row):
                    out.append(found)
                    size += len(found[4] or b"")
                    if size >= BATCH_BYTES or len(out) == BATCH_ROWS:
                        yield pd.DataFrame(out, columns=IMAGES.names, dtype=object)
                        out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=IMAGES.names, dtype=object)

    return sources.select("book_id", "idx", "path", "kind", "content").mapInPandas(run, IMAGES)


def gather_images(images: DataFrame, books: DataFrame | None = None, policy: str = "fail") -> DataFrame:
    """One row per book: images in order, their number and bytes, and failures.

    policy 'drop' leaves failed pictures out; 'fail' gives a book with any failure
    no images and status 'failed'. ``books`` adds books without pictures (a PDF
    without pages), with no images and status 'empty'.
    """
    if policy not in ("fail", "drop"):
        raise ValueError(f"unknown policy {policy!r}")
    good = F.col("status") == "ok"
    packed = F.array_sort(F.collect_list(F.when(good, F.struct("idx", "page", "data"))))
    held = images.groupBy("book_id").agg(F.transform(packed, lambda x: x["data"]).alias("images_data"), F.count(F.when(~good, 1)).alias("n_failed"), F.array_sort(F.collect_list("error")).alias("errors"))
    if books is not None:
        held = books.select("book_id").distinct().join(held, "book_id", "left")
    kept = F.coalesce("images_data", F.array().cast("array<binary>"))
    if policy == "fail":
        kept = F.when(F.coalesce("n_failed", F.lit(0)) > 0, F.array().cast("array<binary>")).otherwise(kept)
    status = F.when(F.coalesce("n_failed", F.lit(0)) > 0, "failed" if policy == "fail" else "partial").when(F.size(kept) == 0, "empty").otherwise("ok")
    out = held.select("book_id", kept.alias("images_data"), F.coalesce("n_failed", F.lit(0).cast("long")).alias("n_failed"), F.coalesce("errors", F.array().cast("array<string>")).alias("errors"), status.alias("images_status"))
    return out.withColumn("n_images", F.size("images_data").cast("long"))


def explode_pages(sources: DataFrame, pages: str = "n_pages") -> DataFrame:
    """A row for each page of each file, from 0; a file without pages has none."""
    places = F.when(F.col(pages) > 0, F.sequence(F.lit(0).cast("long"), F.col(pages).cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return sources.withColumn("page", F.explode(places))


def wrapped_images(gathered: DataFrame, mime: str = "image/webp") -> DataFrame:
    """Images as the structs a model call takes: mime type and base64 text; empty images are left out."""
    there = F.filter("images_data", lambda d: F.octet_length(d) > 0)
    return gathered.withColumn("media", F.transform(there, lambda d: F.struct(F.lit(mime).alias("mime"), base64_unbroken(d).alias("base64"))))
