"""Column expressions; all of them stay in the JVM."""

from folioloom.functions.columns import (
    ascii_safe,
    base64_unbroken,
    book_of_path,
    condition_of,
    confidence_band,
    extension_of,
    fitted_size,
    image_file_name,
    isbn_ok,
    lenient_json,
    megabytes,
    name_of_path,
    present,
    print_type_of,
    severity_rank,
)

__all__ = [
    "ascii_safe",
    "base64_unbroken",
    "book_of_path",
    "condition_of",
    "confidence_band",
    "extension_of",
    "fitted_size",
    "image_file_name",
    "isbn_ok",
    "lenient_json",
    "megabytes",
    "name_of_path",
    "present",
    "print_type_of",
    "severity_rank",
]
