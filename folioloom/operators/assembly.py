"""One catalogue record per book out of its images and five analyses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.plans.schemas import ANALYSES, CATALOGUE


def gather(images: DataFrame, analyses: dict[str, DataFrame]) -> DataFrame:
    """Images (book_id, images_data, ...) with every analysis's record, status and error; books without a row of an analysis get status 'missing'.

    All sides are keyed by book_id with one row each, so the joins share one
    partitioning and nothing multiplies. The records meet first: image bytes move
    once, in the last join.
    """

    def add(left: DataFrame, name: str) -> DataFrame:
        right = analyses[name].select("book_id", F.col("record").alias(name), F.col("status").alias(f"{name}_status"), F.col("error").alias(f"{name}_error"))
        return left.join(right, "book_id", "left").withColumn(f"{name}_status", F.coalesce(f"{name}_status", F.lit("missing")))

    records = reduce(add, [n for n in ANALYSES if n in analyses], images.select("book_id"))
    return images.join(records, "book_id")


def catalogue(gathered: DataFrame) -> DataFrame:
    """The 23 columns of the catalogue, then status and error of each analysis, and of the images where they are given.

    A value that a record has as null stays null; nothing is defaulted here. The
    year of publication comes from the main record, which alone has it.
    """
    main, pub, cond, hints = (F.col(n) for n in ("book_main_data", "book_pub_and_dist_details", "book_condition_data", "book_content_hints"))
    values = {
        "book_id": F.col("book_id"),
        "images_data": F.col("images_data"),
        "book_title": main["title"],
        "isbns": F.struct(main["isbn_10"].alias("isbn_10"), main["isbn_13"].alias("isbn_13")),
        "language_data": F.struct(main["language"].alias("languages"), main["script"].alias("scripts")),
        "authors": main["authors"],
        "translators": main["translator"],
        "published_year": main["published_year"],
        "book_main_data": main,
        "publisher_name": pub["publisher_name"],
        "publisher_location": pub["publisher_location"],
        "distributor_name": pub["distributor_name"],
        "distributor_location": pub["distributor_location"],
        "book_pub_and_dist_details": pub,
        "book_condition_summary": cond["Condition"],
        "print_type": cond["PrintType"],
        "book_condition_data": cond,
        "book_blurb_text": hints["bookBlurbText"],
        "bookNERData": hints["bookNERData"],
        "isFiction": hints["isFiction"],
        "book_genre": hints["bookGenre"],
        "book_content_hints": hints,
        "raw_analysis": F.col("raw_analysis"),
    }
    kept = [F.col(f"{n}_{x}") for n in ANALYSES for x in ("status", "error") if f"{n}_{x}" in gathered.columns]
    kept += [F.col(c) for c in ("images_status", "n_failed", "errors") if c in gathered.columns]
    return gathered.select(*[values[name].alias(name) for name in CATALOGUE.names], *kept)
