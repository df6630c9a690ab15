"""Prompts of the five analyses, as column expressions over a book's images and notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.plans.schemas import ANALYSES, BINDINGS, CONDITION_ALIASES, COVERS, NO_BLURB, PRINT_TYPE_ALIASES, READABILITY, SEVERITIES, TEXT_CONFIDENCE, URGENCY

#: What each analysis is asked to do; our own words.
TASKS = {
    "raw_analysis": "Describe what each photograph shows: the cover, the back cover, the colophon page, and any other page. Two or more photographs are expected.",
    "book_condition_data": (
        "Judge the physical condition and the kind of print. Give one physical observation for each photograph, with a severity out of "
        f"{', '.join(SEVERITIES)} and a readability impact out of {', '.join(READABILITY)}. Preservation urgency begins with one of {', '.join(URGENCY)}; "
        f"cover material is one of {', '.join(COVERS)}; binding is one of {', '.join(BINDINGS)}. Condition is one of {', '.join(f'{a} ({n})' for a, n in CONDITION_ALIASES.items())}; "
        f"print type is one of {', '.join(f'{a} ({n})' for a, n in PRINT_TYPE_ALIASES.items())}."
    ),
    "book_content_hints": f"Collect names, snippets and clues about the content, whether the book is fiction, and its genres. List each name once. Without a blurb, write '{NO_BLURB}'.",
    "book_main_data": (
        "Read title, languages, scripts, authors, translators, ISBN and year of publication. Give the evidence for each value with the number of its photograph and a "
        f"confidence out of {', '.join(TEXT_CONFIDENCE)}. Romanised fields hold plain ASCII only."
    ),
    "book_pub_and_dist_details": "Read publisher, place of publication, editor and distributor. Name a distributor only if it isn't the publisher. Give countries by their English names, and the number of photographs.",
}
#: Analyses that get the notes of the raw analysis.
WITH_NOTES = ("book_content_hints", "book_main_data", "book_pub_and_dist_details")


def describe_type(kind: T.DataType) -> str:
    """A record type in the words of a prompt."""
    if isinstance(kind, T.StructType):
        return "{" + ", ".join(f'"{f.name}": {describe_type(f.dataType)}' for f in kind.fields) + "}"
    if isinstance(kind, T.ArrayType):
        return f"[{describe_type(kind.elementType)}]"
    return {"string": "text or null", "bigint": "integer or null", "double": "number or null", "boolean": "true or false"}[kind.simpleString()]


def image_lines(n_images: Column) -> Column:
    """'Image i of n' for each picture, from 1, a line each; empty without pictures."""
    n = n_images.cast("int")
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: F.format_string("Image %d of %d", i, n)), "\n")


def render(analysis: str, n_images: Column, notes: Column | None = None) -> Column:
    """The prompt of an analysis; notes are left out where they are null or empty."""
    if analysis not in ANALYSES:
        raise ValueError(f"unknown analysis {analysis!r}")
    parts = [F.lit(TASKS[analysis]), F.nullif(image_lines(n_images), F.lit("")), F.concat(F.lit("Answer with one JSON object of this form:\n"), F.lit(describe_type(ANALYSES[analysis])))]
    if analysis in WITH_NOTES and notes is not None:
        parts.insert(2, F.concat(F.lit("Notes of an earlier look at the same photographs:\n"), F.nullif(notes, F.lit(""))))
    return F.concat_ws("\n\n", *parts)
