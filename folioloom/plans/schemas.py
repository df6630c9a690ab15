"""Record types and closed domains.

The field names, aliases and domain values are fixed values of the record
contracts; they are spelled as those require.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _list(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


# -- fixed values: enum aliases, best condition first
CONDITION_ALIASES = {"c1": "BARU", "c2": "SANGAT_BAIK", "c3": "BAIK", "c4": "CUKUP_BAIK", "c5": "DITERIMA", "c6": "BURUK"}
PRINT_TYPE_ALIASES = {"pt1": "HARDCOVER", "pt2": "PAPERBACK", "pt3": "FOTOKOPI"}
# -- fixed values: closed domains of text fields; severities are ordered
TEXT_CONFIDENCE = ("high", "medium", "low")
SEVERITIES = ("none", "minimal", "minor", "moderate", "major", "severe", "critical")
NO_BLURB = "no blurb text available"
READABILITY = ("no impact", "slight impact", "moderate impact", "significant impact", "severe impact", "illegible")
URGENCY = ("none needed", "routine care", "preventive measures", "immediate attention", "critical intervention required")
COVERS = ("rigid cardboard/board", "flexible card stock", "paper", "cloth", "leather", "synthetic material", "unknown")
BINDINGS = ("sewn binding", "perfect binding (glued)", "saddle stitch (stapled)", "spiral bound", "loose leaf", "unknown")
# -- fixed value: the temperature of the model calls
TEMPERATURE = 0.8
# -- fixed values: supported files
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".tif", ".webp")
PDF_EXTENSIONS = (".pdf",)

# -- fixed values: the fields of the record contracts
RAW = _struct(coverPageDescription=_S, backCoverDescription=_S, colophonPageDescription=_S, otherPageDescriptions=_S)

CONDITION = _struct(
    physicalObservations=_list(_struct(imageNumber=_L, bookComponent=_S, observedFeatures=_list(_S), severityLevel=_S, readabilityImpact=_S)),
    conditionAnalysis=_struct(overallAssessment=_S, conditionReasoning=_S, preservationUrgency=_S),
    printTypeAnalysis=_struct(coverMaterial=_S, bindingType=_S, printQualityIndicators=_list(_S), printTypeReasoning=_S),
    Condition=_S,
    PrintType=_S,
)

HINTS = _struct(
    extractedTextSnippets=_list(_S),
    nerCandidates=_list(_S),
    contentClues=_list(_S),
    bookBlurbText=_S,
    bookNERData=_list(_S),
    fictionAnalysis=_S,
    isFiction=_B,
    genreAnalysis=_S,
    bookGenre=_list(_S),
    bookContextHints=_S,
)

_COMPARISON = _struct(fieldName=_S, fromImages=_S, fromNotes=_S, agreement=_B, reasoning=_S, finalDecision=_S)

MAIN = _struct(
    extractionEvidence=_list(_struct(imageNumber=_L, location=_S, extractedText=_S, textType=_S, scriptIdentified=_S, confidence=_S)),
    languageScriptAnalysis=_S,
    dataComparisons=_list(_COMPARISON),
    transliterationReasoning=_S,
    title=_struct(title_in_origin_script=_S, title_in_latin_script=_S, title_in_indonesian=_S),
    language=_list(_S),
    script=_list(_S),
    authors=_list(_struct(author_in_origin_script=_S, author_in_latin_script=_S)),
    translator=_list(_struct(translators_in_origin_script=_S, translators_in_latin_script=_S)),
    isbn_13=_S,
    isbn_10=_S,
    published_year=_L,
    confidence=_D,
)

_NAME = dict(original_script=_S, romanized=_S, english_translation=_S, indonesian_translation=_S)

PUBLISHING = _struct(
    extractionEvidence=_list(_struct(imageNumber=_L, pageType=_S, location=_S, extractedText=_S, textType=_S, scriptIdentified=_S, confidence=_S)),
    roleDistinction=_struct(publisherIdentified=_B, editorIdentified=_B, distributorIdentified=_B, printerIdentified=_B, reasoning=_S),
    dataComparisons=_list(_COMPARISON),
    transliterationStrategy=_S,
    geographicAnalysis=_S,
    publisher_name=_struct(**_NAME),
    publisher_location=_struct(**_NAME, country=_S),
    editor=_struct(original_script=_S, romanized=_S),
    distributor_name=_struct(**_NAME),
    distributor_location=_struct(**_NAME, country=_S),
    confidence=_D,
    image_count=_L,
)

#: Analysis name -> record type. The names are also the stems of the JSON files.
ANALYSES = {
    "book_condition_data": CONDITION,
    "raw_analysis": RAW,
    "book_content_hints": HINTS,
    "book_main_data": MAIN,
    "book_pub_and_dist_details": PUBLISHING,
}
#: What each analysis gives when it fails: empty text, empty lists or nothing, by contract. Fields not named are null.
FALLBACKS: dict[str, dict] = {
    "book_condition_data": {},
    "raw_analysis": {name: "" for name in RAW.names},
    "book_content_hints": {"bookNERData": [], "bookGenre": [], "isFiction": False},
    "book_main_data": {"language": [], "script": [], "authors": []},
    "book_pub_and_dist_details": {},
}
#: The two phases; each analysis of the second reads the raw analysis of the first.
PHASES = (("book_condition_data", "raw_analysis"), ("book_content_hints", "book_main_data", "book_pub_and_dist_details"))

IMAGES = T.StructType(
    [T.StructField("book_id", _S), T.StructField("idx", _L), T.StructField("path", _S), T.StructField("page", _L), T.StructField("data", T.BinaryType()), T.StructField("width", _L), T.StructField("height", _L), T.StructField("status", _S), T.StructField("error", _S)]
)

CATALOGUE = _struct(
    book_id=_S,
    images_data=_list(T.BinaryType()),
    book_title=MAIN["title"].dataType,
    isbns=_struct(isbn_10=_S, isbn_13=_S),
    language_data=_struct(languages=_list(_S), scripts=_list(_S)),
    authors=MAIN["authors"].dataType,
    translators=MAIN["translator"].dataType,
    published_year=_L,
    book_main_data=MAIN,
    publisher_name=PUBLISHING["publisher_name"].dataType,
    publisher_location=PUBLISHING["publisher_location"].dataType,
    distributor_name=PUBLISHING["distributor_name"].dataType,
    distributor_location=PUBLISHING["distributor_location"].dataType,
    book_pub_and_dist_details=PUBLISHING,
    book_condition_summary=_S,
    print_type=_S,
    book_condition_data=CONDITION,
    book_blurb_text=_S,
    bookNERData=_list(_S),
    isFiction=_B,
    book_genre=_list(_S),
    book_content_hints=HINTS,
    raw_analysis=RAW,
)
