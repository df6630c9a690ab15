"""The flow: from book folders to the catalogue, over all books at once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.operators.assembly import catalogue, gather
from folioloom.operators.extraction import extract, raw_notes
from folioloom.operators.images import Codec, ImageConfig, gather_images, process_images
from folioloom.plans.providers import CONSTANT, Provider, Retrying
from folioloom.plans.schemas import PHASES, TEMPERATURE
from folioloom.sources.folders import REJECTS, Settings, SourceConfig, list_folders, load_contents, load_root, scan_root, select_sources, unsupported_books
from folioloom.sources.sinks import save_images, save_json, write_catalogue


@dataclass(frozen=True)
class Stages:
    """Stage tables of a run below one folder that driver and executors share."""

    spark: SparkSession
    root: str

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def image_stage(spark: SparkSession, folders: list[str] | str, stages: Stages, config: ImageConfig = ImageConfig(), sources: SourceConfig = SourceConfig(), codec: Codec | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(books, pictures in long form, rejected books) of a list of folders, or of all folders below a root.

    Pictures are staged, so later steps don't decode again. A root is listed and
    loaded without a list of its files on the driver; ``books`` are those with
    files to look at, whether or not these hold a picture.
    """
    if isinstance(folders, str):
        files, rejects = scan_root(spark, folders), spark.createDataFrame([], REJECTS)
    else:
        files, rejects = list_folders(spark, folders)
    files = stages(files, "listing")
    rejects = rejects.unionByName(unsupported_books(files, sources))
    chosen = stages(select_sources(files, sources), "sources")
    loaded = load_root(spark, folders, sources) if isinstance(folders, str) else load_contents(spark, chosen)
    return chosen.select("book_id").distinct(), stages(process_images(loaded, config, codec), "pictures"), rejects


def two_phases(images: DataFrame, provider: Provider, stages: Stages, temperature: float = TEMPERATURE, log: str | None = None) -> dict[str, DataFrame]:
    """All five analyses of gathered books: condition and raw side by side first, then the other three with the raw notes. Five calls a book."""
    first, second = PHASES
    done = extract(images, first, provider, stages, temperature=temperature, log=log)
    with_notes = images.join(raw_notes(done["raw_analysis"]), "book_id", "left")
    return done | extract(with_notes, second, provider, stages, notes=True, temperature=temperature, log=log)


def failed_books(images: DataFrame) -> DataFrame:
    """Books whose pictures can't be used, as rejects with what went wrong."""
    reason = F.concat(F.lit("images_failed: "), F.array_join("errors", "; "))
    return images.filter("images_status = 'failed'").select("book_id", F.lit(None).cast("string").alias("folder"), reason.alias("reason"))


def build_catalogue(
    spark: SparkSession,
    folders: list[str] | str,
    provider: Provider,
    stage_root: str,
    out: str | None = None,
    image_out: str | None = None,
    json_out: str | None = None,
    config: ImageConfig = ImageConfig(),
    sources: SourceConfig = SourceConfig(),
    codec: Codec | None = None,
    policy: str = "fail",
    temperature: float = TEMPERATURE,
    log: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(catalogue records, rejected books); writes the catalogue, images and JSON where paths are given.

    ``folders`` is a list of book folders, or the path of a root that holds them.
    A book without pictures (a PDF without pages) stays, with no images, and is
    asked like any other. A book that failed under the policy 'fail' isn't asked:
    its record has the status and errors of its images and 'missing' analyses, it
    is among the rejects, and the catalogue table keeps what it has of the book.
    With ``log``, a table of replies, a run that was cut off doesn't pay its calls
    again. A failed sink fails the run, not the record.
    """
    stages = Stages(spark, stage_root)
    books, pictures, rejects = image_stage(spark, folders, stages, config, sources, codec)
    images = stages(gather_images(pictures, books, policy), "images")
    fine = images.filter("images_status != 'failed'")
    if image_out:
        save_images(pictures.join(fine.select("book_id"), "book_id", "left_semi").filter("status = 'ok'"), image_out, books=fine)
    analyses = two_phases(fine.select("book_id", "images_data", "n_images"), provider, stages, temperature, log)
    if json_out:
        for name, records in analyses.items():
            save_json(records, name, json_out)
    records = stages(catalogue(gather(images.select("book_id", "images_data", "images_status", "n_failed", "errors"), analyses)), "catalogue")
    if out:
        write_catalogue(records.filter("images_status != 'failed'"), out)
    return records, rejects.unionByName(failed_books(images))


def main(argv: list[str] | None = None) -> None:
    """Command line: ``python -m folioloom.plans.flow FOLDER... --stages DIR`` with --images OUT for the image stage alone, and --out TABLE for whole records (the provider comes from the settings)."""
    import argparse

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("folders", nargs="+")
    p.add_argument("--stages", required=True)
    p.add_argument("--images")
    p.add_argument("--out")
    p.add_argument("--json")
    p.add_argument("--log")
    p.add_argument("--env")
    given = p.parse_args(argv)
    if not (given.images or given.out):
        p.error("give --images, --out or both")
    spark = SparkSession.builder.appName("folioloom").getOrCreate()
    if given.out:
        provider = Retrying(Settings.load(given.env).provider(), CONSTANT)
        _, rejects = build_catalogue(spark, given.folders, provider, given.stages, given.out, given.images, given.json, log=given.log)
    else:
        books, pictures, rejects = image_stage(spark, given.folders, Stages(spark, given.stages))
        save_images(pictures.filter("status = 'ok'"), given.images, books=books)
    rejects.show(truncate=False)


if __name__ == "__main__":
    main()
