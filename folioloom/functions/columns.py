"""Column expressions of the catalogue engine; no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.plans.schemas import CONDITION_ALIASES, PRINT_TYPE_ALIASES, SEVERITIES


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- paths


def bare_path(path: Column | str) -> Column:
    """A web address without query and fragment. Names of files may hold the marks of both, so other paths are taken as they are."""
    return F.regexp_replace(_c(path), r"(?s)^(https?://[^?#]*)[?#].*$", "$1")


def name_of_path(path: Column | str) -> Column:
    """Last component of a path; null for null."""
    return F.element_at(F.split(bare_path(path), "/"), -1)


def book_of_path(path: Column | str) -> Column:
    """Name of the folder that directly holds the file; null where there is none."""
    return F.try_element_at(F.split(bare_path(path), "/"), F.lit(-2))


def extension_of(name: Column | str) -> Column:
    """Lower-case suffix with its full stop, empty text where there is none."""
    return F.lower(F.regexp_extract(_c(name), r"[^/.](\.[^./]+)$", 1))


# -- images


def fitted_size(width: Column | str, height: Column | str, most_wide: int = 800, most_high: int = 800) -> Column:
    """struct(width, height) of a picture fitted to the bound as Pillow's ``thumbnail`` fits it: never enlarged, at least one pixel.

    The side that doesn't touch the bound is rounded up or down, to whichever
    keeps the aspect better; down where both are as good.
    """
    w, h = _c(width).cast("long"), _c(height).cast("long")
    aspect = w.cast("double") / h.cast("double")
    wide, high = F.lit(float(most_wide)), F.lit(float(most_high))

    def rounded(x: Column, off) -> Column:
        down, up = F.floor(x).cast("long"), F.ceil(x).cast("long")
        return F.greatest(F.when(off(up) < off(down), up).otherwise(down), F.lit(1).cast("long"))

    by_height = rounded(high * aspect, lambda n: F.abs(aspect - n.cast("double") / high))
    by_width = rounded(wide / aspect, lambda n: F.when(n == 0, 0.0).otherwise(F.abs(aspect - F.try_divide(wide, n.cast("double")))))
    fits, tall = (w <= most_wide) & (h <= most_high), wide / high >= aspect
    out_w = F.when(fits, w).when(tall, by_height).otherwise(F.lit(most_wide).cast("long"))
    out_h = F.when(fits, h).when(tall, F.lit(most_high).cast("long")).otherwise(by_width)
    return F.struct(out_w.alias("width"), out_h.alias("height"))


def base64_unbroken(data: Column | str) -> Column:
    """Standard base64 without line breaks, whatever the session's setting for chunks is."""
    return F.regexp_replace(F.base64(_c(data)), r"[\r\n]", "")


def image_file_name(book_id: Column | str, number: Column | str, extension: str = ".webp") -> Column:
    """``{book}_img_{number}`` with at least three digits; longer numbers widen it."""
    return F.format_string(f"%s_img_%03d{extension}", _c(book_id), _c(number))


def megabytes(n: Column | str) -> Column:
    return _c(n) / F.lit(1024 * 1024)


# -- values


def present(text: Column | str) -> Column:
    """Whether a text is there and not empty."""
    return F.coalesce(_c(text) != "", F.lit(False))


def _alias(value: Column | str, aliases: dict[str, str]) -> Column:
    """The name an alias or a name stands for; null for anything else."""
    given = F.trim(_c(value))
    known = F.create_map(*[F.lit(x) for k, v in aliases.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(known, F.lower(given)), F.when(F.upper(given).isin(*aliases.values()), F.upper(given)))


def condition_of(value: Column | str) -> Column:
    return _alias(value, CONDITION_ALIASES)


def print_type_of(value: Column | str) -> Column:
    return _alias(value, PRINT_TYPE_ALIASES)


def severity_rank(value: Column | str) -> Column:
    """0 for none up to 6 for critical; null for anything else."""
    place = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.lower(F.trim(_c(value))))
    return F.when(place > 0, place - 1)


def isbn_ok(value: Column | str, digits: int, final_x: bool = False) -> Column:
    """Whether a text is an ISBN of 10 or 13 digits, hyphens aside. ``final_x`` allows X as the last of 10."""
    body = rf"^[0-9]{{{digits - 1}}}[0-9{'Xx' if final_x and digits == 10 else ''}]$"
    return F.regexp_replace(_c(value), "-", "").rlike(body)


def confidence_band(value: Column | str) -> Column:
    """Band of a confidence, lower bound inclusive; out of [0, 1] is 'out_of_range', null stays null."""
    v = _c(value)
    return (
        F.when((v < 0) | (v > 1), "out_of_range")
        .when(v >= 0.9, "very_high")
        .when(v >= 0.7, "high")
        .when(v >= 0.5, "medium")
        .when(v >= 0.3, "low")
        .when(v >= 0, "very_low")
    )


def ascii_safe(value: Column | str) -> Column:
    """Whether all characters are ASCII: only those have one byte each. Decides as the pattern ``^[\\x00-\\x7F]*$`` does, without matching every character."""
    return F.octet_length(_c(value)) == F.length(_c(value))


# -- model replies


def json_body(reply: Column | str) -> Column:
    """What is likely the JSON of a reply: inside a code fence if there is one, else from the first brace to the last; without trailing commas."""
    text = _c(reply)
    fenced = F.regexp_extract(text, r"(?s)```(?:json|JSON)?\s*(.*?)```", 1)
    inner = F.when(fenced != "", fenced).otherwise(text)
    braced = F.regexp_extract(inner, r"(?s)(\{.*\})", 1)
    return F.regexp_replace(F.when(braced != "", braced).otherwise(inner), r",((?:\s|//[^\n]*\n)*[}\]])", "$1")


def lenient_json(reply: Column | str, schema: T.StructType) -> Column:
    """struct(record, ok): the reply as a record; ok is false, and record null, where there is no JSON object in it.

    Strict JSON is tried first, then the body of a fence or of the outer braces,
    with comments, trailing commas and single quotes allowed.
    """
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    loose = options | {"allowComments": "true", "allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}
    fine = lambda s: s.isNotNull() & s["_corrupt"].isNull()
    found = lambda s: F.struct(F.struct(*[s[f.name].alias(f.name) for f in schema.fields]).alias("record"), F.lit(True).alias("ok"))
    none = F.struct(F.lit(None).cast(schema).alias("record"), F.lit(False).alias("ok"))
    given = F.trim(F.coalesce(_c(reply), F.lit("")))
    # The repair is only looked at where the strict reading fails.
    repaired = _let(json_body(given), lambda t: _let(F.from_json(t, marked, loose), lambda r: F.when(t.startswith("{") & fine(r), found(r)).otherwise(none)))
    return _let(F.from_json(given, marked, options), lambda s: F.when(given.startswith("{") & fine(s), found(s)).otherwise(repaired))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
