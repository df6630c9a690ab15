"""Listing and loading by the executors, against Spark's own readers."""

import os

from pyspark.sql import functions as F
from test_catalogue import put

from folioloom import queries
from folioloom.operators import images
from folioloom.sources.folders import in_book_of, list_folders, literal_glob, load_contents, load_files, load_root, scan_root
from folioloom.sources.stores import address_of


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_list_of_files_on_the_driver(spark, tmp_path, small):
    for i in range(3):
        put(tmp_path, f"b{i}/a.png", b"x%d" % i)
    folders = spark.range(4).select(F.concat(F.lit(f"{tmp_path}/b"), F.col("id").cast("string")).alias("f"))
    files, rejects = list_folders(spark, folders)
    loaded = load_contents(spark, files)
    assert {(r.book_id, r.path, bytes(r.content)) for r in loaded.collect()} == {(f"b{i}", f"file:{tmp_path}/b{i}/a.png", b"x%d" % i) for i in range(3)}
    assert [(r.book_id, r.folder, r.reason) for r in rejects.collect()] == [("b3", f"{tmp_path}/b3", "not_found")]
    for df in (loaded, load_root(spark, str(tmp_path)), queries.QUERIES["saved_images"](spark, small), queries.QUERIES["saved_records"](spark, small)):
        assert "binaryFile" not in plan(df)


def test_scan_is_that_of_sparks_reader(spark, tmp_path):
    for name in ("a/x.png", "a/.x.png", "a/_x.png", "a/_k=v.png", "a/zero.png", "a/sub/y.png", "_under/x.png", ".dot/x.png", "sp ace/é%20.png", "file.png"):
        put(tmp_path, name, b"" if "zero" in name else name.encode())
    os.symlink(tmp_path / "a", tmp_path / "link")
    read = spark.read.format("binaryFile").load(f"{literal_glob(str(tmp_path))}/*").filter(in_book_of("path", str(tmp_path)))
    want = {(r.path, r.length, bytes(r.content)) for r in read.collect()}
    for root in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        assert {(r.path, r.length, bytes(r.content)) for r in load_files(spark, root).collect()} == want
    assert {(r.path, r.length) for r in scan_root(spark, str(tmp_path)).collect()} == {w[:2] for w in want}


class Direct:
    """A table whose Python functions are handed out instead of run."""

    def select(self, *columns):
        return self

    def mapInPandas(self, run, schema):
        return run


def test_pictures_leave_python_in_few_frames(monkeypatch):
    import pandas as pd

    made = []
    kind = pd.DataFrame
    rows = [("b", i, "p", "image", b"x" * (i % 5) if i % 7 else None) for i in range(2500)]
    held = kind(rows, columns=["book_id", "idx", "path", "kind", "content"])
    run = images.process_images(Direct(), codec=images.PassThroughCodec())
    monkeypatch.setattr(images.pd, "DataFrame", lambda *a, **b: made.append(1) or kind(*a, **b))
    found = list(run([held[:1200], held[1200:]]))
    assert len(made) == 3 and sum(map(len, found)) == 2500
    got = {r.idx: (r.status, r.data) for f in found for r in f.itertuples()}
    assert got == {i: ("ok", b"x" * (i % 5)) if i % 7 and i % 5 else ("failed", None) for i in range(2500)}
    # Frames end by bytes too, also within one file of many pages.
    monkeypatch.setattr(images, "BATCH_BYTES", 30)
    pdf = kind({"book_id": ["b"], "idx": [2**60 + 1], "path": ["p"], "kind": ["pdf"], "content": [b"/Type /Page\n" * 9]})
    assert [len(f) for f in run([pdf])] == [1] * 9


def test_addresses():
    at = lambda p, base="file:": address_of(p, base, "/here")
    assert [at(p) for p in ("/a//b/", "file:/a/b", "file:///a/b", "c", "s3://k/a/")] == ["file:/a/b", "file:/a/b", "file:/a/b", "file:/here/c", "s3://k/a"]
    assert at("/a", "hdfs://h:1") == "hdfs://h:1/a"
