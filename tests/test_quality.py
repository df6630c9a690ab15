"""Data rules, one violation at a time."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.operators.quality import check, rules
from folioloom.plans.schemas import CATALOGUE

MAIN = {
    "extractionEvidence": [{"confidence": "high"}],
    "dataComparisons": [{"fromImages": "a", "fromNotes": "A ", "agreement": True}],
    "title": {"title_in_latin_script": "Laut"},
    "authors": [{"author_in_latin_script": "Budi"}],
    "translator": [{"translators_in_latin_script": "Ana"}],
}
PUBLISHING = {
    "extractionEvidence": [{"confidence": "low"}],
    "dataComparisons": [{"fromImages": "a", "fromNotes": "b", "agreement": False}],
    "publisher_name": {"romanized": "Gramedia"},
    "editor": {"romanized": "Ed"},
    "distributor_name": {"romanized": "Agung"},
}


def flags(spark, records):
    """The flags of each named record of analyses."""

    def filled(kind, v):
        if isinstance(kind, T.StructType) and v is not None:
            return tuple(filled(f.dataType, v.get(f.name)) for f in kind)
        return [filled(kind.elementType, x) for x in v] if isinstance(kind, T.ArrayType) and v is not None else v

    rows = [{"book_id": name, "images_data": [b"x", b"y"]} | analyses for name, analyses in records.items()]
    return {r.book_id: r for r in check(spark.createDataFrame([filled(CATALOGUE, r) for r in rows], CATALOGUE)).collect()}


VIOLATIONS = [
    ("text_confidence", "book_main_data", "extractionEvidence", [{"confidence": "sure"}]),
    ("text_confidence", "book_pub_and_dist_details", "extractionEvidence", [{"confidence": "sure"}]),
    ("agreement", "book_main_data", "dataComparisons", [{"fromImages": "a", "fromNotes": "b", "agreement": True}]),
    ("agreement", "book_pub_and_dist_details", "dataComparisons", [{"fromImages": "a", "fromNotes": "b", "agreement": True}]),
    ("latin_is_ascii", "book_main_data", "title", {"title_in_latin_script": "L\u00e4ut"}),
    ("latin_is_ascii", "book_main_data", "authors", [{"author_in_latin_script": "B\u00f9di"}]),
    ("latin_is_ascii", "book_main_data", "translator", [{"translators_in_latin_script": "A\u00f1a"}]),
    ("latin_is_ascii", "book_pub_and_dist_details", "publisher_name", {"romanized": "Gram\u00e9dia"}),
    ("latin_is_ascii", "book_pub_and_dist_details", "editor", {"romanized": "\u00c9d"}),
    ("latin_is_ascii", "book_pub_and_dist_details", "distributor_name", {"romanized": "Ag\u00fang"}),
]


def test_one_violation_in_each_field(spark):
    fine = {"book_main_data": MAIN, "book_pub_and_dist_details": PUBLISHING}
    records = {"fine": fine, "nothing": {}}
    for i, (_, record, field, value) in enumerate(VIOLATIONS):
        records[f"among {i}"] = fine | {record: fine[record] | {field: value}}
        records[f"alone {i}"] = {record: {field: value}}
    got = flags(spark, records)
    for i, (rule, record, field, _) in enumerate(VIOLATIONS):
        assert got["fine"][f"ok_{rule}"] is True and got["nothing"][f"ok_{rule}"] is None
        assert got[f"among {i}"][f"ok_{rule}"] is got[f"alone {i}"][f"ok_{rule}"] is False, (rule, record, field)
        assert got[f"among {i}"].n_broken == got["fine"].n_broken + 1


#: Value lists as the record contract states them.
DOMAINS = {
    "readability": ["no impact", "slight impact", "moderate impact", "significant impact", "severe impact", "illegible"],
    "urgency": ["none needed", "routine care", "preventive measures", "immediate attention", "critical intervention required"],
    "cover": ["rigid cardboard/board", "flexible card stock", "paper", "cloth", "leather", "synthetic material", "unknown"],
    "binding": ["sewn binding", "perfect binding (glued)", "saddle stitch (stapled)", "spiral bound", "loose leaf", "unknown"],
}
EXPLAINED = {"urgency": ["Routine care: light wear", "none needed."], "cover": [" Paper, worn"], "binding": ["Perfect binding (glued), tight"]}
WRONG = {"readability": ["none", "no impact at all"], "urgency": ["high", "none", "routine careless"], "cover": ["paperboard", "plastic", "rigid"], "binding": ["perfect", "glued", "loose"]}


def test_contract_values_are_in_their_domains(spark):
    cases = [(rule, v, ok) for values, ok in ((DOMAINS, True), (EXPLAINED, True), (WRONG, False)) for rule, vs in values.items() for v in vs]
    rows = [(i, v) for i, (_, v, _) in enumerate(cases)]
    condition = F.struct(
        F.array(F.struct(F.col("v").alias("readabilityImpact"))).alias("physicalObservations"),
        F.struct(F.col("v").alias("preservationUrgency")).alias("conditionAnalysis"),
        F.struct(F.col("v").alias("coverMaterial"), F.col("v").alias("bindingType")).alias("printTypeAnalysis"),
    )
    found = rules()
    df = spark.createDataFrame(rows, "i int, v string").withColumn("book_condition_data", condition)
    got = {r.i: r for r in df.select("i", *[found[rule].alias(rule) for rule in DOMAINS]).collect()}
    assert [(rule, v, got[i][rule]) for i, (rule, v, _) in enumerate(cases)] == cases
