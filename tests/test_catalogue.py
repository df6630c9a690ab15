"""Folders to catalogue, with stub providers and pass-through codecs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from folioloom.operators.assembly import catalogue
from folioloom.operators.images import ImageConfig, PassThroughCodec, PillowCodec, explode_pages, gather_images, process_images, wrapped_images
from folioloom.operators.metrics import image_sizes, observed, record_counts
from folioloom.operators.quality import check
from folioloom.plans.flow import build_catalogue
from folioloom.plans.prompts import render
from folioloom.plans.providers import EXPONENTIAL, FirstOf, ProviderError, Registry, ReplayProvider, Request, RetryPolicy, Retrying, RoundRobin, StubProvider
from folioloom.plans.schemas import ANALYSES, CATALOGUE
from folioloom.sources.folders import Settings, SourceConfig, any_case_glob, list_folders, load_contents, load_root, scan_root, select_sources, supported_files, unsupported_books
from folioloom.sources.sinks import image_files, prepare_folder, read_catalogue, save_images, save_json, write_catalogue
from folioloom.streaming.ingest import each_batch, new_files


def put(root, name, data=b"x"):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture
def books(tmp_path):
    root = tmp_path / "books"
    put(root, "mixed/b.PNG", b"bb")
    put(root, "mixed/a.png", b"a")
    put(root, "mixed/notes.txt")
    put(root, "mixed/sub/c.png")
    put(root, "pdf/doc.pdf", b"/Type /Page\n" * 3)
    put(root, "pdf/x.jpg")
    put(root, "text/only.txt")
    put(root, "zero/z.png", b"")
    (root / "empty").mkdir()
    put(root, "file.png")
    return root


ANSWERS = {
    "raw_analysis": {"coverPageDescription": "blue", "colophonPageDescription": ""},
    "book_condition_data": {"Condition": "c3", "PrintType": "pt2", "physicalObservations": [{"imageNumber": 1, "severityLevel": "minor"}, {"imageNumber": 2, "severityLevel": "awful"}]},
    "book_content_hints": {"bookBlurbText": "no blurb text available", "bookNERData": ["Ana"], "nerCandidates": ["Ana"], "isFiction": True, "bookGenre": ["poetry"]},
    "book_main_data": {"title": {"title_in_origin_script": "Laut", "title_in_indonesian": "Laut"}, "language": ["Indonesian"], "script": ["Latin"], "authors": [{"author_in_latin_script": "Budi"}], "isbn_13": "978-602-03-1234-5", "published_year": 1999, "confidence": 0.85},
    "book_pub_and_dist_details": {"publisher_name": {"original_script": "Gramedia"}, "confidence": 1.5, "image_count": 2, "roleDistinction": {"publisherIdentified": True, "editorIdentified": False, "distributorIdentified": False}},
}


def answer(request):
    return json.dumps(ANSWERS[request.analysis])


def test_listing_and_rejects(spark, books):
    names = ["mixed", "pdf", "text", "zero", "empty", "file.png", "gone"]
    files, rejects = list_folders(spark, [str(books / n) for n in names])
    assert {(r.book_id, r.reason) for r in rejects.collect()} == {("empty", "no_files"), ("file.png", "not_a_directory"), ("gone", "not_found")}
    assert {(r.book_id, r.name) for r in files.collect()} == {("mixed", "b.PNG"), ("mixed", "a.png"), ("mixed", "notes.txt"), ("pdf", "doc.pdf"), ("pdf", "x.jpg"), ("text", "only.txt"), ("zero", "z.png")}
    assert [r.book_id for r in unsupported_books(files).collect()] == ["text"]
    chosen = select_sources(files).orderBy("book_id", "idx").collect()
    assert [(r.book_id, r.idx, r.name, r.kind) for r in chosen] == [("mixed", 0, "a.png", "image"), ("mixed", 1, "b.PNG", "image"), ("pdf", 0, "doc.pdf", "pdf"), ("zero", 0, "z.png", "image")]


def test_scan_root_is_not_recursive(spark, books):
    got = {(r.book_id, r.name) for r in supported_files(scan_root(spark, str(books))).collect()}
    assert ("mixed", "c.png") not in got and ("mixed", "b.PNG") in got and ("pdf", "doc.pdf") in got


def test_load_root(spark, books):
    assert any_case_glob((".x1",)) == "*{.[xX]1}"
    got = {(r.book_id, r.idx, r.name, bytes(r.content)) for r in load_root(spark, str(books)).collect()}
    assert {(b, i, n) for b, i, n, _ in got} == {("mixed", 0, "a.png"), ("mixed", 1, "b.PNG"), ("pdf", 0, "doc.pdf")}
    assert ("mixed", 1, "b.PNG", b"bb") in got


def test_source_config():
    assert SourceConfig((), (".PDF",)).pdfs == (".pdf",)
    assert ".webp" in SourceConfig().supported and SourceConfig((".X",)).images == (".x",)


def test_settings(tmp_path):
    f = tmp_path / ".env"
    f.write_text("# c\nFOLIOLOOM_API_KEY='k'\nFOLIOLOOM_MODEL=m\nOTHER=1\n")
    s = Settings.load(str(f), {"FOLIOLOOM_MODEL": "n"})
    assert (s.api_key, s.extra) == ("k", {"model": "n"})


def test_images_and_policies(spark, books):
    files, _ = list_folders(spark, [str(books / n) for n in ("mixed", "pdf", "zero")])
    pictures = process_images(load_contents(spark, select_sources(files)), codec=PassThroughCodec()).cache()
    drop = {r.book_id: r for r in gather_images(pictures, files, "drop").collect()}
    fail = {r.book_id: r for r in gather_images(pictures, files, "fail").collect()}
    assert drop["mixed"].images_data == [b"a", b"bb"] and drop["pdf"].n_images == 3
    assert fail["zero"].images_status == "failed" and fail["zero"].n_images == 0 and "could not be read" in fail["zero"].errors[0]
    assert drop["zero"].images_status == "partial"
    sizes = {r.book_id: r for r in image_sizes(gather_images(pictures, files, "drop")).collect()}
    assert (sizes["mixed"].binary_bytes, sizes["mixed"].base64_chars) == (3, 8)
    media = {r.book_id: r.media for r in wrapped_images(gather_images(pictures, files, "drop")).collect()}
    assert [m.base64 for m in media["mixed"]] == ["YQ==", "YmI="]


def test_missing_codec_is_an_error_on_the_row(spark, books):
    try:
        import PIL  # noqa: F401

        pytest.skip("Pillow is here")
    except ImportError:
        pass
    files, _ = list_folders(spark, [str(books / "mixed")])
    rows = process_images(load_contents(spark, select_sources(files)), codec=PillowCodec()).collect()
    assert {r.status for r in rows} == {"failed"} and "Pillow" in rows[0].error


def test_image_config():
    with pytest.raises(ValueError):
        ImageConfig(resampling="SHARP")
    assert ImageConfig(resampling="bicubic")


def test_explode_pages(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0)], "p string, n_pages long")
    assert [(r.p, r.page) for r in explode_pages(df).collect()] == [("a", 0), ("a", 1)]


def test_many_images_widen_names(spark):
    df = spark.range(1001).select(F.lit("b").alias("book_id"), F.col("id").alias("idx"), F.lit(b"x").alias("data"))
    names = {r.file_name for r in image_files(df).collect()}
    assert "b_img_001.webp" in names and "b_img_1001.webp" in names


def test_end_to_end(spark, books, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def counted(request):
        # One file a call: the executors' calls are counted across processes.
        import uuid

        (calls / f"{request.book_id}-{request.analysis}-{uuid.uuid4().hex}").touch()
        return answer(request)

    out, folders = tmp_path / "catalogue", [str(books / n) for n in ("mixed", "pdf", "gone")]
    records, rejects = build_catalogue(spark, folders, StubProvider(counted), str(tmp_path / "stages"), str(out), str(tmp_path / "images"), str(tmp_path / "json"), codec=PassThroughCodec())
    assert {r.book_id for r in records.collect()} == {"mixed", "pdf"} and [r.book_id for r in rejects.collect()] == ["gone"]
    assert len(os.listdir(calls)) == 10  # five a book, whatever is read afterwards
    row = read_catalogue(spark, str(out)).filter("book_id = 'mixed'").first()
    assert row.published_year == 1999 and row.book_condition_summary == "BAIK" and row.print_type == "PAPERBACK" and row.isbns.isbn_13.startswith("978")
    assert row.images_data == [b"a", b"bb"] and row.book_title.title_in_origin_script == "Laut" and row.translators is None
    assert sorted(os.listdir(tmp_path / "images" / "mixed")) == ["mixed_img_001.webp", "mixed_img_002.webp"]
    stored = json.loads((tmp_path / "json" / "mixed" / "mixed_book_main_data.json").read_text())
    assert stored["published_year"] == 1999 and stored["isbn_10"] is None
    flags = check(records).filter("book_id = 'mixed'").first()
    assert flags.ok_isbn_13 and flags.ok_indonesian_title and flags.ok_one_observation_per_image and flags.ok_two_images and flags.ok_roles
    assert flags.ok_publishing_confidence is False and flags.ok_severity is False
    # The sentinel is a right answer, and no blurb.
    assert flags.ok_blurb is True and flags.has_blurb is False
    assert flags.main_band == "high" and flags.publishing_band == "out_of_range" and flags.n_broken >= 2
    counts = record_counts(records).filter("book_id = 'mixed'").first()
    assert (counts.n_genres, counts.n_names, counts.n_authors, counts.has_cover, counts.has_colophon) == (1, 1, 1, True, False)
    # A second run over the same books leaves one row each.
    write_catalogue(records, str(out))
    assert read_catalogue(spark, str(out)).groupBy("book_id").count().filter("count > 1").count() == 0
    assert read_catalogue(spark, str(out)).columns == CATALOGUE.names
    watched, seen = observed(records, "run")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 2 and seen.get["not_ok_raw_analysis"] == 0


@pytest.mark.parametrize("broken", list(ANALYSES))
def test_fallbacks(spark, books, tmp_path, broken):
    def failing(request):
        if request.analysis == broken:
            raise RuntimeError("no answer")
        return answer(request)

    records, _ = build_catalogue(spark, [str(books / "mixed")], StubProvider(failing), str(tmp_path / "stages"), codec=PassThroughCodec())
    row = records.first()
    assert row[f"{broken}_status"] == "fallback" and "no answer" in row[f"{broken}_error"]
    assert all(row[f"{n}_status"] == "success" for n in ANALYSES if n != broken)
    want = {
        "book_condition_data": lambda r: r.book_condition_summary is None and r.print_type is None,
        "raw_analysis": lambda r: r.raw_analysis.coverPageDescription == "" and r.raw_analysis.otherPageDescriptions == "",
        "book_content_hints": lambda r: r.book_blurb_text is None and r.bookNERData == [] and r.book_genre == [] and r.isFiction is False,
        "book_main_data": lambda r: r.book_title is None and r.authors == [] and r.language_data.languages == [] and r.published_year is None,
        "book_pub_and_dist_details": lambda r: r.publisher_name is None and r.distributor_location is None,
    }
    assert want[broken](row)


def test_unreadable_reply_is_a_fallback(spark, books, tmp_path):
    records, _ = build_catalogue(spark, [str(books / "mixed")], StubProvider(lambda r: "sorry" if r.analysis == "book_main_data" else answer(r)), str(tmp_path / "s"), codec=PassThroughCodec())
    assert "no readable JSON" in records.first().book_main_data_error


def test_assembly_only_reads_what_is_asked(spark):
    empty = spark.createDataFrame([], CATALOGUE)
    gathered = empty.select("book_id", "images_data", *ANALYSES)
    assert catalogue(gathered).columns[:23] == CATALOGUE.names


def test_upsert_replaces_only_given_books(spark, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame([(b,) + (None,) * 22 for b, _ in pairs], CATALOGUE).withColumn("published_year", F.when(F.col("book_id") == pairs[0][0], F.lit(pairs[0][1]).cast("long")))

    path = str(tmp_path / "t")
    write_catalogue(rows(("a", 1), ("b", None)), path, buckets=2)
    write_catalogue(rows(("a", 2), ("c", None)), path, buckets=2)
    assert {(r.book_id, r.published_year) for r in read_catalogue(spark, path).collect()} == {("a", 2), ("b", None), ("c", None)}
    with pytest.raises(ValueError):
        write_catalogue(rows(("a", 2)), path, mode="twice")


def test_save_images_replaces_folder(spark, tmp_path):
    df = spark.createDataFrame([("b", 0, bytearray(b"1")), ("b", 1, bytearray(b"2"))], "book_id string, idx long, data binary")
    save_images(df, str(tmp_path))
    save_images(df.filter("idx = 0"), f"file://{tmp_path}")
    assert os.listdir(tmp_path / "b") == ["b_img_001.webp"]


def test_json_keeps_letters(spark, tmp_path):
    df = spark.createDataFrame([("b", "é ü 書")], "book_id string, t string").select("book_id", F.struct("t").alias("record"))
    save_json(df, "raw_analysis", str(tmp_path))
    assert "é ü 書" in (tmp_path / "b" / "b_raw_analysis.json").read_text("utf-8")
    prepare_folder(spark, str(tmp_path / "x" / "y"))
    assert (tmp_path / "x" / "y").is_dir()


class Flaky:
    def __init__(self, failures):
        self.left = failures

    def reply(self, request):
        if self.left:
            self.left -= 1
            raise RuntimeError("later")
        return "ok"


def test_providers():
    request = Request("raw_analysis", "b", "p")
    waits = []
    assert Retrying(Flaky(2), EXPONENTIAL, waits.append).reply(request) == "ok" and waits == [0.3, 0.45]
    with pytest.raises(RuntimeError):
        Retrying(Flaky(3), EXPONENTIAL, waits.append).reply(request)
    assert RetryPolicy(12, 300, 1.5).delays_ms()[-1] == 10_000
    assert FirstOf((Flaky(9), StubProvider(lambda r: "second"))).reply(request) == "second"
    with pytest.raises(ProviderError):
        FirstOf((Flaky(9),)).reply(request)
    turns = RoundRobin((StubProvider(lambda r: "a"), StubProvider(lambda r: "b")))
    got = {b: turns.reply(Request("raw_analysis", b, "p")) for b in map(str, range(40))}
    assert set(got.values()) == {"a", "b"} and got == {b: turns.reply(Request("x", b, "p")) for b in got}
    with pytest.raises(ProviderError):
        ReplayProvider({}).reply(request)
    registry = Registry()
    registry.add("one", StubProvider(lambda r: "1"))
    registry.build("chain", {"kind": "fallback", "of": ["one"], "retry": "constant"})
    assert registry.get("chain").reply(request) == "1"
    with pytest.raises(ValueError):
        registry.get("none")


def test_prompts(spark):
    df = spark.createDataFrame([(2, "n"), (0, None)], "n int, notes string")
    a, b = [r.p for r in df.select(render("book_main_data", F.col("n"), F.col("notes")).alias("p")).collect()]
    assert "Image 2 of 2" in a and "\nn\n" in a and "Image 1" not in b and "Notes of" not in b and '"published_year": integer or null' in b


def test_stream_picks_up_new_files(spark, books, tmp_path):
    seen = tmp_path / "seen"

    def keep(batch, number):
        batch.select("book_id", "name").write.mode("append").parquet(str(seen))

    for _ in range(2):
        each_batch(new_files(spark, str(books)), keep, str(tmp_path / "state")).awaitTermination(60)
    got = sorted((r.book_id, r.name) for r in spark.read.parquet(str(seen)).collect())
    assert ("mixed", "a.png") in got and len(got) == len(set(got)) and all(b != "text" for b, _ in got)
