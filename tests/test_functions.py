import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom import functions as X
from folioloom.plans.schemas import MAIN
from folioloom.queries import QUERIES


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "given, want",
    [("a.PNG", ".png"), ("b.tar.GZ", ".gz"), ("none", ""), (".hidden", ""), ("dir.x/file", ""), ("", "")],
)
def test_extension(spark, given, want):
    assert one(spark, X.extension_of(F.lit(given))) == want


def test_paths(spark):
    assert one(spark, X.book_of_path(F.lit("file:/books/rak-1/a b.png"))) == "rak-1"
    assert one(spark, X.name_of_path(F.lit("http://h/p/a.png?x=1#y"))) == "a.png"
    assert one(spark, X.book_of_path(F.lit("a.png"))) is None


@pytest.mark.parametrize("size, want", [((1600, 800), (800, 400)), ((10, 20), (10, 20)), ((800, 800), (800, 800)), ((1, 5000), (1, 800)), ((3000, 1), (800, 1))])
def test_fitted_size(spark, size, want):
    assert tuple(one(spark, X.fitted_size(F.lit(size[0]), F.lit(size[1])))) == want


def test_file_name_widens(spark):
    assert one(spark, X.image_file_name(F.lit("b"), F.lit(7))) == "b_img_007.webp"
    assert one(spark, X.image_file_name(F.lit("b"), F.lit(1234), ".jpg")) == "b_img_1234.jpg"


def test_base64_has_no_breaks(spark):
    import base64

    assert one(spark, X.base64_unbroken(F.lit(bytearray(range(256)) * 3))) == base64.b64encode(bytes(range(256)) * 3).decode()


@pytest.mark.parametrize("given, want", [("c1", "BARU"), (" C6 ", "BURUK"), ("baik", "BAIK"), ("c9", None), (None, None), ("", None)])
def test_condition(spark, given, want):
    assert one(spark, X.condition_of(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize("v, want", [(1.0, "very_high"), (0.9, "very_high"), (0.89, "high"), (0.5, "medium"), (0.3, "low"), (0.0, "very_low"), (-0.1, "out_of_range"), (1.01, "out_of_range"), (None, None)])
def test_band(spark, v, want):
    assert one(spark, X.confidence_band(F.lit(v).cast("double"))) == want


@pytest.mark.parametrize("v, digits, x, want", [("978-602-03-1234-5", 13, False, True), ("978", 13, False, False), ("080442957X", 10, False, False), ("080442957X", 10, True, True), (None, 13, False, None)])
def test_isbn(spark, v, digits, x, want):
    assert one(spark, X.isbn_ok(F.lit(v).cast("string"), digits, x)) == want


SMALL = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])


@pytest.mark.parametrize(
    "reply, ok, k",
    [
        ('{"k": 1, "s": "a, }"}', True, 1),
        ('```json\n{"k": 2,}\n```', True, 2),
        ('text before {"k": 3 /* c */, "s": "x"} and after', True, 3),
        ('{"k": 4, // note\n "s": "b"}', True, 4),
        ("{k: 5, 's': 'q'}", True, 5),
        ("garbage", False, None),
        ("", False, None),
        (None, False, None),
        ("[1, 2]", False, None),
        ('{"k": 1', False, None),
        ("{}", True, None),
    ],
)
def test_lenient_json(spark, reply, ok, k):
    got = spark.createDataFrame([(reply,)], "r string").select(X.lenient_json("r", SMALL).alias("x")).first().x
    assert got.ok is ok
    assert (got.record.k if got.record else None) == k


def test_strict_text_is_not_repaired(spark):
    got = spark.createDataFrame([('{"k": 1, "s": "a, }"}',)], "r string").select(X.lenient_json("r", SMALL).alias("x")).first().x
    assert got.record.s == "a, }"


def test_nested_record(spark):
    reply = '{"title": {"title_in_latin_script": "Laut"}, "language": ["id"], "authors": [{"author_in_latin_script": "A"}], "published_year": 1999, "confidence": 0.8}'
    got = spark.createDataFrame([(reply,)], "r string").select(X.lenient_json("r", MAIN).alias("x")).first().x
    assert got.ok and got.record.title.title_in_latin_script == "Laut" and got.record.published_year == 1999


def test_ascii_safe_decides_as_the_pattern(spark):
    texts = ["", "a b\n", "\x00\x7f", "é", "a\n\u0080", "日本", "\U0001f600", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(X.ascii_safe("t").alias("x"), F.col("t").rlike(r"^[\x00-\x7F]*$").alias("y")).collect()
    assert [r.x for r in rows] == [r.y for r in rows] == [True, True, True, False, False, False, False, None]


def test_ascii_query_runs_the_operator(spark, small, monkeypatch):
    monkeypatch.setattr(X, "ascii_safe", lambda value: F.lit("the operator"))
    assert QUERIES["ascii_safe"](spark, small).first().is_ascii == "the operator"
