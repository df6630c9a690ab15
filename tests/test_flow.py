"""Books that fail, books without pictures, odd names, runs that are cut off, and codecs against stand-in libraries."""

import json
import os
import sys
import types

import pytest
from pyspark.sql import functions as F
from test_catalogue import ANSWERS, answer, put

from folioloom.operators import quality
from folioloom.operators.extraction import call_model
from folioloom.operators.images import ImageConfig, PassThroughCodec, PillowCodec
from folioloom.operators.metrics import stage_memory
from folioloom.operators.quality import check, rules
from folioloom.plans import flow
from folioloom.plans.flow import build_catalogue
from folioloom.plans.prompts import render
from folioloom.plans.providers import HttpProvider, RoundRobin, StubProvider
from folioloom.plans.schemas import ANALYSES, BINDINGS, CATALOGUE, COVERS, READABILITY, TEMPERATURE, URGENCY
from folioloom.sources.folders import Settings, list_folders, literal_glob, load_contents, load_root, scan_root, select_sources
from folioloom.sources.sinks import read_catalogue, save_images, table_buckets, write_catalogue
from folioloom.streaming.ingest import each_batch, new_files


class Counted:
    """Answers, and leaves one file a call: the executors' calls are counted across processes."""

    def __init__(self, folder, broken=()):
        self.folder, self.broken = str(folder), tuple(broken)
        os.makedirs(self.folder, exist_ok=True)

    def reply(self, request):
        import uuid

        with open(f"{self.folder}/{request.book_id}-{request.analysis}-{request.temperature}-{uuid.uuid4().hex}", "w"):
            pass
        if request.analysis in self.broken:
            raise RuntimeError("down")
        return answer(request)

    def calls(self):
        return sorted(tuple(n.rsplit("-", 3)[:2]) for n in os.listdir(self.folder))


@pytest.fixture
def shelf(tmp_path):
    root = tmp_path / "shelf"
    put(root, "good/a.png", b"a")
    put(root, "good/b.png", b"bb")
    put(root, "nopages/doc.pdf", b"%PDF without pages")
    put(root, "bad/a.png", b"a")
    put(root, "bad/b.png", b"")
    return root


def test_book_without_pages_stays_and_failed_book_is_not_asked(spark, shelf, tmp_path):
    asked = Counted(tmp_path / "calls")
    out = str(tmp_path / "catalogue")
    folders = [str(shelf / n) for n in ("good", "nopages", "bad")]
    records, rejects = build_catalogue(spark, folders, asked, str(tmp_path / "s"), out, str(tmp_path / "images"), codec=PassThroughCodec())
    rows = {r.book_id: r for r in records.collect()}
    assert set(rows) == {"good", "nopages", "bad"}
    assert rows["nopages"].images_data == [] and rows["nopages"].images_status == "empty" and rows["nopages"].raw_analysis_status == "success"
    assert rows["bad"].images_status == "failed" and rows["bad"].n_failed == 1 and rows["bad"].raw_analysis_status == "missing" and rows["bad"].raw_analysis is None
    assert len(asked.calls()) == 10 and not any(c[0].startswith("bad") for c in asked.calls())
    assert [(r.book_id, r.reason.split(":")[0]) for r in rejects.collect()] == [("bad", "images_failed")]
    assert {r.book_id for r in read_catalogue(spark, out).collect()} == {"good", "nopages"}
    assert sorted(os.listdir(tmp_path / "images")) == ["good", "nopages"] and os.listdir(tmp_path / "images" / "nopages") == []


def test_policy_drop_keeps_the_book(spark, shelf, tmp_path):
    asked = Counted(tmp_path / "calls")
    records, rejects = build_catalogue(spark, [str(shelf / "bad")], asked, str(tmp_path / "s"), codec=PassThroughCodec(), policy="drop")
    row = records.first()
    assert row.images_data == [b"a"] and row.images_status == "partial" and row.raw_analysis_status == "success" and len(asked.calls()) == 5 and rejects.count() == 0
    assert all(f"-{TEMPERATURE}-" in n for n in os.listdir(asked.folder))


def test_root_as_source(spark, shelf, tmp_path):
    records, _ = build_catalogue(spark, str(shelf), Counted(tmp_path / "calls"), str(tmp_path / "s"), codec=PassThroughCodec())
    rows = {r.book_id: r.images_data for r in records.collect()}
    assert rows["good"] == [b"a", b"bb"] and rows["nopages"] == []


def test_a_failed_book_keeps_its_earlier_record(spark, shelf, tmp_path):
    out = str(tmp_path / "c")
    put(shelf, "bad/b.png", b"fine")
    build_catalogue(spark, [str(shelf / "bad")], Counted(tmp_path / "calls"), str(tmp_path / "s"), out, codec=PassThroughCodec())
    put(shelf, "bad/b.png", b"")
    build_catalogue(spark, [str(shelf / "bad")], Counted(tmp_path / "calls"), str(tmp_path / "s"), out, codec=PassThroughCodec())
    assert read_catalogue(spark, out).first().images_data == [b"a", b"fine"]


def test_a_run_that_goes_on_does_not_pay_twice(spark, shelf, tmp_path):
    log, folders = str(tmp_path / "log"), [str(shelf / n) for n in ("good", "nopages")]
    first = Counted(tmp_path / "one", broken=("book_main_data",))
    records, _ = build_catalogue(spark, folders, first, str(tmp_path / "s1"), codec=PassThroughCodec(), log=log)
    assert {r.book_main_data_status for r in records.collect()} == {"fallback"} and len(first.calls()) == 10
    second = Counted(tmp_path / "two")
    records, _ = build_catalogue(spark, folders, second, str(tmp_path / "s2"), codec=PassThroughCodec(), log=log)
    assert {a for _, a in second.calls()} == {"book_main_data"} and len(second.calls()) == 2
    assert all(r[f"{n}_status"] == "success" for r in records.collect() for n in ANALYSES)
    third = Counted(tmp_path / "three")
    build_catalogue(spark, folders, third, str(tmp_path / "s3"), codec=PassThroughCodec(), log=log)
    assert third.calls() == []


ODD = ["x#1", "y?2", "z[3]", "w{4}", "v*5", "u%236", "t 7", "s(8)"]


def test_names_are_no_patterns(spark, tmp_path):
    root = tmp_path / "odd [root]"
    for name in ODD:
        put(root, f"{name}/cover[1].png", name.encode())
        put(root, f"{name}/b#?{{}}%.png", b"b")
    want = {(n, f, c) for n in ODD for f, c in (("cover[1].png", n.encode()), ("b#?{}%.png", b"b"))}
    listed, rejects = list_folders(spark, [str(root / n) for n in ODD])
    assert rejects.count() == 0
    one_by_one = {(r.book_id, r.name, bytes(r.content)) for r in load_contents(spark, select_sources(listed)).collect()}
    below = {(r.book_id, r.name, bytes(r.content)) for r in load_root(spark, str(root)).collect()}
    assert one_by_one == below == want
    assert {(r.book_id, r.name) for r in scan_root(spark, str(root)).collect()} == {(n, f) for n, f, _ in want}
    assert literal_glob("a[b]*") == "a\\[b\\]\\*"
    seen = tmp_path / "seen"
    each_batch(new_files(spark, str(root)), lambda b, i: b.select("book_id", "name").write.mode("append").parquet(str(seen)), str(tmp_path / "state")).awaitTermination(60)
    assert {(r.book_id, r.name) for r in spark.read.parquet(str(seen)).collect()} == {(n, f) for n, f, _ in want}


def rows(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "b string, y long")
    return df.select(*[(F.col("b") if n == "book_id" else F.col("y") if n == "published_year" else F.lit(None).cast(CATALOGUE[n].dataType)).alias(n) for n in CATALOGUE.names])


def held(spark, path):
    return sorted((r.book_id, r.published_year) for r in read_catalogue(spark, path).collect())


def test_upsert_keeps_the_buckets_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_catalogue(rows(spark, *[(f"b{i}", 1) for i in range(8)]), path, buckets=8)
    write_catalogue(rows(spark, *[(f"b{i}", 2) for i in range(8)]), path)
    assert table_buckets(spark, path) == 8 and held(spark, path) == [(f"b{i}", 2) for i in range(8)]
    write_catalogue(rows(spark, ("b9", 3)), path, mode="append")
    assert table_buckets(spark, path) == 8 and len(held(spark, path)) == 9
    write_catalogue(rows(spark, ("b9", 4)), path, mode="overwrite", buckets=2)
    assert table_buckets(spark, path) == 2 and held(spark, path) == [("b9", 4)]
    os.remove(f"{path}/_buckets")
    with pytest.raises(ValueError, match="buckets"):
        write_catalogue(rows(spark, ("b9", 5)), path)


def test_repeated_and_missing_keys_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    for given in ([("a", 1), ("a", 2), ("b", 1)], [(None, 1)]):
        with pytest.raises(ValueError, match="book_id"):
            write_catalogue(rows(spark, *given), path)
    assert not os.path.exists(path)


def test_an_upsert_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch):
    from folioloom.sources import sinks

    path = str(tmp_path / "t")
    write_catalogue(rows(spark, ("a", 1), ("b", 1)), path, buckets=2)
    finish = sinks._replay
    monkeypatch.setattr(sinks, "_replay", lambda spark, path: None)
    write_catalogue(rows(spark, ("a", 2)), path)  # ends before the new buckets have taken their place
    assert held(spark, path) == [("a", 1), ("b", 1)]
    monkeypatch.setattr(sinks, "_replay", finish)
    write_catalogue(rows(spark, ("c", 1)), path)
    assert held(spark, path) == [("a", 2), ("b", 1), ("c", 1)] and not os.path.exists(f"{path}._pending")
    os.makedirs(f"{path}._pending/bucket=0")  # one that hadn't written its buckets yet
    write_catalogue(rows(spark, ("c", 2)), path)
    assert held(spark, path) == [("a", 2), ("b", 1), ("c", 2)]


def test_unknown_stores_are_errors(spark, tmp_path):
    images = spark.createDataFrame([("b", 0, bytearray(b"1"))], "book_id string, idx long, data binary")
    with pytest.raises(Exception):
        save_images(images, "nosuch://store/out")
    assert not os.path.exists("nosuch:")
    save_images(images, str(tmp_path / "o"))
    save_images(images.limit(0), str(tmp_path / "o"), books=images.select("book_id"))
    assert os.listdir(tmp_path / "o" / "b") == []


def test_replies_that_are_no_text(spark):
    books = spark.createDataFrame([("a", None, "p")], "book_id string, images_data array<binary>, prompt_raw_analysis string")
    got = call_model(books, ("raw_analysis",), StubProvider(lambda r: {"a": 1})).first()
    assert got.reply is None and got.call_error == "TypeError: the reply is no text but dict"


def test_blurb_rules(spark):
    kind = CATALOGUE["book_content_hints"].dataType
    cases = {"a": "no blurb text available", "b": "A story.", "c": None, "d": " "}
    df = spark.createDataFrame(list(cases.items()), "book_id string, t string")
    given = F.struct(*[(F.col("t") if f.name == "bookBlurbText" else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.fields])
    df = df.select(*[(F.col("book_id") if n == "book_id" else given if n == "book_content_hints" else F.lit(None).cast(CATALOGUE[n].dataType)).alias(n) for n in CATALOGUE.names])
    got = {r.book_id: (r.ok_blurb, r.has_blurb, r.n_broken) for r in check(df).collect()}
    assert got == {"a": (True, False, 0), "b": (True, True, 0), "c": (False, False, 1), "d": (False, False, 1)}


def test_rule_names(spark):
    assert tuple(rules(countries=("Indonesia",))) == quality.RULES


def test_prompts_name_the_domains(spark):
    p = spark.range(1).select(render("book_condition_data", F.lit(1)).alias("p")).first().p
    assert all(v in p for domain in (READABILITY, URGENCY, COVERS, BINDINGS) for v in domain)


def test_settings_make_a_provider():
    made = Settings.load(None, {"FOLIOLOOM_API_KEY": "k", "FOLIOLOOM_URL": "http://x", "FOLIOLOOM_MODEL": "m"}).provider()
    assert made == HttpProvider("http://x", "m", "k")
    with pytest.raises(ValueError, match="url and model"):
        Settings.load(None, {}).provider()


def test_command_line(spark, shelf, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(flow, "PillowCodec", PassThroughCodec, raising=False)
    monkeypatch.setattr(flow, "process_images", lambda sources, config, codec: __import__("folioloom.operators.images", fromlist=["x"]).process_images(sources, config, PassThroughCodec()))
    flow.main([str(shelf / "good"), "--stages", str(tmp_path / "s"), "--images", str(tmp_path / "i")])
    assert sorted(os.listdir(tmp_path / "i" / "good")) == ["good_img_001.webp", "good_img_002.webp"]
    monkeypatch.setattr(Settings, "provider", lambda self: StubProvider(answer))
    flow.main([str(shelf / "good"), "--stages", str(tmp_path / "s"), "--out", str(tmp_path / "c"), "--json", str(tmp_path / "j")])
    assert read_catalogue(spark, str(tmp_path / "c")).first().published_year == ANSWERS["book_main_data"]["published_year"]
    assert json.loads((tmp_path / "j" / "good" / "good_raw_analysis.json").read_text())["coverPageDescription"] == "blue"
    with pytest.raises(SystemExit):
        flow.main([str(shelf / "good"), "--stages", "s"])


def test_stage_memory(spark):
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    seen = stage_memory(spark)
    assert seen and all(mb >= 0 for _, _, mb in seen)


def test_round_robin_is_even():
    turns = [RoundRobin((None, None, None)).turn(f"book-{i}") for i in range(600)]
    assert all(150 < turns.count(k) < 250 for k in range(3))


class Picture:
    def __init__(self, log, mode, size):
        self.log, self.mode, (self.width, self.height) = log, mode, size

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.log.append("closed")

    def convert(self, mode):
        self.log.append(("convert", self.mode, mode))
        return Picture(self.log, mode, (self.width, self.height))

    def copy(self):
        return Picture(self.log, self.mode, (self.width, self.height))

    def thumbnail(self, size, resample):
        self.log.append(("thumbnail", size, resample))
        self.width, self.height = min(self.width, size[0]), min(self.height, size[1])

    def save(self, out, **options):
        self.log.append(("save", options))
        out.write(b"W" + self.mode.encode())


@pytest.fixture
def libraries(monkeypatch):
    """Modules that record what is asked of Pillow and PyMuPDF; the libraries themselves aren't installed here."""
    log = []
    image = types.SimpleNamespace(
        open=lambda f: Picture(log, "RGBA" if f.read() == b"alpha" else "RGB", (1600, 400)),
        frombytes=lambda mode, size, data: log.append(("frombytes", mode, size, data)) or Picture(log, mode, size),
        Resampling={"LANCZOS": "lanczos", "BICUBIC": "bicubic"},
    )

    class Document(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *_: log.append("closed")

    page = lambda i: types.SimpleNamespace(get_pixmap=lambda dpi: types.SimpleNamespace(width=10 * i, height=20, samples=f"p{i}@{dpi}"))
    monkeypatch.setitem(sys.modules, "PIL", types.SimpleNamespace(Image=image))
    monkeypatch.setitem(sys.modules, "fitz", types.SimpleNamespace(open=lambda stream, filetype: Document(page(i) for i in range(1, 1 + len(stream)))))
    return log


def test_pillow_codec(libraries):
    got = list(PillowCodec().pictures(b"alpha", False, ImageConfig()))
    assert got == [(b"WRGB", 800, 400)]
    assert libraries == [("convert", "RGBA", "RGB"), ("thumbnail", (800, 800), "lanczos"), ("save", {"format": "WEBP", "quality": 85, "method": 4}), "closed"]
    libraries.clear()
    list(PillowCodec().pictures(b"rgb", False, ImageConfig(max_width=50, max_height=60, quality=9, webp_method=1, resampling="bicubic")))
    assert libraries == [("thumbnail", (50, 60), "bicubic"), ("save", {"format": "WEBP", "quality": 9, "method": 1}), "closed"]


def test_pdf_pages(libraries):
    got = list(PillowCodec().pictures(b"xx", True, ImageConfig(pdf_dpi=99)))
    assert [size for _, *size in got] == [[10, 20], [20, 20]]
    assert [x for x in libraries if x[0] == "frombytes"] == [("frombytes", "RGB", (10, 20), "p1@99"), ("frombytes", "RGB", (20, 20), "p2@99")]
    assert list(PillowCodec().pictures(b"", True, ImageConfig())) == []


def test_fitted_size_equals_the_library(spark):
    """Where Pillow is installed, its own thumbnails."""
    image = pytest.importorskip("PIL.Image")
    from folioloom.functions import fitted_size

    sizes = [(w, h) for w in (1, 7, 640, 801, 1234, 3000) for h in (1, 9, 800, 999, 2001)]
    got = spark.createDataFrame(sizes, "w int, h int").select("w", "h", fitted_size("w", "h").alias("s")).collect()
    for r in got:
        picture = image.new("RGB", (r.w, r.h))
        picture.thumbnail((800, 800))
        assert (r.s.width, r.s.height) == picture.size
