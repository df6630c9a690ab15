"""The data rules of the record contracts, as flags; no rule drops a row.

A flag is null where the rule has nothing to look at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions import ascii_safe, confidence_band, isbn_ok, severity_rank
from folioloom.plans.schemas import BINDINGS, CONDITION_ALIASES, COVERS, NO_BLURB, PRINT_TYPE_ALIASES, READABILITY, TEXT_CONFIDENCE, URGENCY


def in_domain(value: Column, domain: tuple[str, ...]) -> Column:
    return F.lower(F.trim(value)).isin(*domain)


def begins_in_domain(value: Column, domain: tuple[str, ...]) -> Column:
    """Whether a text begins with a phrase of the domain, as whole words; an explanation may follow."""
    phrases = "|".join(re.escape(phrase) for phrase in domain) or "(?!)"
    return F.lower(F.trim(value)).rlike(rf"^\s*(?:{phrases})(?![\p{{L}}\p{{N}}_])")


def agreement_ok(images: Column, notes: Column, flag: Column) -> Column:
    """Whether the flag says what a comparison of the two sources does; upper and lower case and outer space aside."""
    same = F.lower(F.trim(images)).eqNullSafe(F.lower(F.trim(notes)))
    return same == flag


def blurb_text(value: Column) -> Column:
    """The blurb, or null where the record says that there is none, or has nothing."""
    return F.when((F.lower(F.trim(value)) != NO_BLURB) & (F.trim(value) != ""), value)


def _all(array: Column, rule) -> Column:
    return F.when(F.size(array) > 0, F.forall(array, rule))


def _joined(*flags: Column) -> Column:
    """False if any flag is, null if all are, else true."""
    return F.least(*flags)


def _same_text(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


#: Names of the rules; the last one needs a list of countries.
RULES = (
    "isbn_13",
    "isbn_10",
    "isbn_10_with_x",
    "year",
    "main_confidence",
    "publishing_confidence",
    "text_confidence",
    "severity",
    "readability",
    "urgency",
    "cover",
    "binding",
    "image_numbers",
    "one_observation_per_image",
    "image_count",
    "latin_is_ascii",
    "agreement",
    "names_distinct",
    "names_from_candidates",
    "blurb",
    "distributor_is_other",
    "translator_has_evidence",
    "indonesian_title",
    "condition",
    "print_type",
    "roles",
    "two_images",
    "country",
)


def rules(countries: tuple[str, ...] | None = None, domains: dict[str, tuple[str, ...]] | None = None) -> dict[str, Column]:
    """Rule name -> flag over a catalogue row. ``domains`` replaces closed domains by name; ``countries`` lists English country names."""
    own = {"readability": READABILITY, "urgency": URGENCY, "cover": COVERS, "binding": BINDINGS} | (domains or {})
    main, pub, cond, hints = (F.col(n) for n in ("book_main_data", "book_pub_and_dist_details", "book_condition_data", "book_content_hints"))
    observed, evidence = cond["physicalObservations"], main["extractionEvidence"]
    n = F.size("images_data")
    numbered = lambda array: _all(array, lambda x: x["imageNumber"].between(1, n))
    present = lambda c: F.coalesce(c.isNotNull(), F.lit(False))
    out = {
        "isbn_13": isbn_ok(main["isbn_13"], 13),
        "isbn_10": isbn_ok(main["isbn_10"], 10),
        "isbn_10_with_x": isbn_ok(main["isbn_10"], 10, final_x=True),
        "year": main["published_year"].between(1000, 9999),
        "main_confidence": main["confidence"].between(0, 1),
        "publishing_confidence": pub["confidence"].between(0, 1),
        "text_confidence": _joined(*[_all(x, lambda e: in_domain(e["confidence"], TEXT_CONFIDENCE)) for x in (evidence, pub["extractionEvidence"])]),
        "severity": _all(observed, lambda o: severity_rank(o["severityLevel"]).isNotNull()),
        "readability": _all(observed, lambda o: in_domain(o["readabilityImpact"], own["readability"])),
        "urgency": begins_in_domain(cond["conditionAnalysis"]["preservationUrgency"], own["urgency"]),
        "cover": begins_in_domain(cond["printTypeAnalysis"]["coverMaterial"], own["cover"]),
        "binding": begins_in_domain(cond["printTypeAnalysis"]["bindingType"], own["binding"]),
        "image_numbers": F.coalesce(numbered(observed), F.lit(True)) & F.coalesce(numbered(evidence), F.lit(True)) & F.coalesce(numbered(pub["extractionEvidence"]), F.lit(True)),
        "one_observation_per_image": F.size(observed) == n,
        "image_count": pub["image_count"] == n,
        "latin_is_ascii": _joined(
            ascii_safe(main["title"]["title_in_latin_script"]),
            _all(main["authors"], lambda a: ascii_safe(a["author_in_latin_script"])),
            _all(main["translator"], lambda t: ascii_safe(t["translators_in_latin_script"])),
            *[ascii_safe(pub[name]["romanized"]) for name in ("publisher_name", "editor", "distributor_name")],
        ),
        "agreement": _joined(*[_all(x["dataComparisons"], lambda d: agreement_ok(d["fromImages"], d["fromNotes"], d["agreement"])) for x in (main, pub)]),
        "names_distinct": F.size(F.array_distinct(hints["bookNERData"])) == F.size(hints["bookNERData"]),
        "names_from_candidates": F.size(F.array_except(hints["bookNERData"], hints["nerCandidates"])) == 0,
        # A book has a blurb or says that there is none; nothing at all is neither.
        "blurb": F.when(F.col("book_content_hints").isNotNull(), F.coalesce(F.trim(hints["bookBlurbText"]) != "", F.lit(False))),
        "distributor_is_other": ~_same_text(pub["distributor_name"]["original_script"], pub["publisher_name"]["original_script"]),
        "translator_has_evidence": F.when(F.size(main["translator"]) > 0, F.coalesce(F.exists(evidence, lambda e: F.lower(e["textType"]).contains("translator")), F.lit(False))),
        "indonesian_title": F.when(F.exists(main["language"], lambda x: F.lower(x).isin("indonesian", "indonesia", "bahasa indonesia", "id")), _same_text(main["title"]["title_in_indonesian"], main["title"]["title_in_origin_script"])),
        "condition": F.col("book_condition_summary").isin(*CONDITION_ALIASES.values()),
        "print_type": F.col("print_type").isin(*PRINT_TYPE_ALIASES.values()),
        "roles": (present(pub["publisher_name"]) == pub["roleDistinction"]["publisherIdentified"]) & (present(pub["editor"]) == pub["roleDistinction"]["editorIdentified"]) & (present(pub["distributor_name"]) == pub["roleDistinction"]["distributorIdentified"]),
        "two_images": n >= 2,
    }
    if countries:
        out["country"] = pub["publisher_location"]["country"].isin(*countries)
    return out


def check(records: DataFrame, **settings) -> DataFrame:
    """book_id, a flag ``ok_<rule>`` for each rule, the confidence bands, and how many rules are broken."""
    found = rules(**settings)
    flagged = records.select(
        "book_id",
        *[flag.alias(f"ok_{name}") for name, flag in found.items()],
        blurb_text(F.col("book_content_hints.bookBlurbText")).isNotNull().alias("has_blurb"),
        confidence_band(F.col("book_main_data.confidence")).alias("main_band"),
        confidence_band(F.col("book_pub_and_dist_details.confidence")).alias("publishing_band"),
    )
    broken = sum((F.coalesce((~F.col(f"ok_{name}")).cast("long"), F.lit(0).cast("long")) for name in found), F.lit(0).cast("long"))
    return flagged.withColumn("n_broken", broken)
