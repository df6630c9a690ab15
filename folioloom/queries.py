"""Registered queries of the catalogue engine, and DuckDB SQL for each.

The test tables hold no books, so each query runs an operator of the library on
tables that stand in for them: ``conversations`` are the ordered images of a book
(conv_id the book, turn the place, text the bytes), ``documents`` the raw
records, ``labels`` an analysis that only some books have, ``pages.url`` file
paths, ``events.props`` model replies, ``events.value`` / 100 confidences. Model
replies come from stub providers that answer from the request. All queries read
whole tables and return scalars.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom import functions as X
from folioloom.operators.assembly import catalogue, gather
from folioloom.operators.extraction import call_model, decode_replies, not_done, raw_notes
from folioloom.operators.images import PassThroughCodec, explode_pages, gather_images, process_images, wrapped_images
from folioloom.operators.metrics import disk_sizes, image_sizes, observed, record_counts
from folioloom.operators.quality import RULES, agreement_ok, check, in_domain, rules
from folioloom.operators.search import nearest
from folioloom.plans.flow import Stages, two_phases
from folioloom.plans.prompts import TASKS, WITH_NOTES, describe_type, image_lines, render
from folioloom.plans.providers import CONSTANT, EXPONENTIAL, FirstOf, Registry, Retrying, StubProvider
from folioloom.plans.schemas import ANALYSES, CATALOGUE, CONDITION_ALIASES
from folioloom.plans.standins import FailingFirst, Member, Named, answer_of_request
from folioloom.sources.folders import book_types, list_folders, load_contents, load_files, load_root, select_sources, unsupported_books
from folioloom.sources.sinks import image_files, json_files, latest_per_key, read_catalogue, save_images, save_json, write_catalogue, written_twice

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name], ORACLE[name] = f, sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as a listing of files: a system turn is a PDF, a user turn an image, an assistant turn a note."""
    c = table(spark, sf_dir, "conversations")
    ext = F.when(F.col("role") == "system", ".PDF").when(F.col("role") == "user", ".Png").otherwise(".txt")
    name = F.concat(F.format_string("%09d", "turn"), ext)
    book = F.col("conv_id").cast("string")
    return c.select(book.alias("book_id"), F.concat(F.lit("/books/"), book, F.lit("/"), name).alias("path"), name.alias("name"), F.octet_length("text").cast("long").alias("length"), "conv_id", "turn", "role")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files of a query, in the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="folioloom-")
    return f"{root.rstrip('/')}/folioloom/{name}-{uuid.uuid4().hex}"


def _pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as decoded pictures in long form."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("book_id"), F.col("turn").alias("idx"), F.lit(0).cast("long").alias("page"), F.col("text").cast("binary").alias("data"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, each with its labels where it has some (``of`` is null where not)."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("of"), "quality", "toxic")
    return table(spark, sf_dir, "documents").join(labels, F.col("doc_id") == F.col("of"), "left")


def _record(schema: T.StructType, **values) -> Column:
    """A record with the given fields; the others are null."""
    return F.struct(*[(values[f.name].cast(f.dataType) if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _analysis(rows: DataFrame, book, record) -> DataFrame:
    return rows.select(book.cast("string").alias("book_id"), record.alias("record"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"))


@query(
    "catalog_records",
    """
    WITH i AS (SELECT conv_id, count(*) AS n_images, CAST(sum(length(text)) AS BIGINT) AS total_chars FROM conversations GROUP BY conv_id)
    SELECT i.conv_id AS book_id, i.n_images, i.total_chars, d.lang, CASE l.quality WHEN 1 THEN 'BAIK' WHEN 0 THEN 'BURUK' END AS condition,
      CASE WHEN l.doc_id IS NULL THEN 'fallback' ELSE 'success' END AS status
    FROM i JOIN documents d ON d.doc_id = i.conv_id LEFT JOIN labels l ON l.doc_id = i.conv_id""",
)
def catalog_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per book: its gathered images, its raw record, and the condition with a status where the analysis is missing."""
    raw = _analysis(table(spark, sf_dir, "documents"), F.col("doc_id"), _record(ANALYSES["raw_analysis"], coverPageDescription=F.col("lang")))
    letter = X.condition_of(F.when(F.col("quality") == 1, "c3").when(F.col("quality") == 0, "c6"))
    condition = _analysis(table(spark, sf_dir, "labels"), F.col("doc_id"), _record(ANALYSES["book_condition_data"], Condition=letter))
    images = gather_images(_pictures(spark, sf_dir))
    others = {n: raw.select("book_id", F.lit(None).cast(ANALYSES[n]).alias("record"), "status", "error") for n in ANALYSES if n not in ("raw_analysis", "book_condition_data")}
    records = catalogue(gather(images.select("book_id", "images_data"), {"raw_analysis": raw, "book_condition_data": condition} | others)).filter("raw_analysis_status = 'success'")
    chars = F.aggregate(F.transform("images_data", lambda d: F.length(F.decode(d, "utf-8")).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    status = F.when(F.col("book_condition_data_status") == "missing", "fallback").otherwise("success")
    return records.select(F.col("book_id").cast("long").alias("book_id"), F.size("images_data").cast("long").alias("n_images"), chars.alias("total_chars"), F.col("raw_analysis.coverPageDescription").alias("lang"), F.col("book_condition_summary").alias("condition"), status.alias("status"))


@query(
    "path_parts",
    """
    SELECT page_id, list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -1) AS name, list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -2) AS book_id,
      regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages""",
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.name_of_path("url").alias("name"), X.book_of_path("url").alias("book_id"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"))


@query(
    "extension_filter",
    """
    WITH n AS (SELECT page_id, list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -1) AS name FROM pages)
    SELECT page_id, lower(regexp_extract(name, '[^/.](\\.[^./]+)$', 1)) AS extension FROM n WHERE lower(regexp_extract(name, '[^/.](\\.[^./]+)$', 1)) IN ('.html', '.pdf')""",
)
def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = X.extension_of(X.name_of_path("url"))
    return table(spark, sf_dir, "pages").select("page_id", ext.alias("extension")).filter(F.col("extension").isin(".html", ".pdf"))


@query(
    "book_data_type",
    """
    SELECT CAST(conv_id AS VARCHAR) AS book_id, CASE WHEN bool_or(role = 'system') THEN 'pdf' WHEN bool_or(role = 'user') THEN 'images' ELSE 'others' END AS data_type
    FROM conversations GROUP BY conv_id""",
)
def book_data_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_types(_files(spark, sf_dir))


@query(
    "source_selection",
    """
    WITH t AS (SELECT conv_id, turn, role, bool_or(role = 'system') OVER (PARTITION BY conv_id) AS has_pdf FROM conversations)
    SELECT CAST(conv_id AS VARCHAR) AS book_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx, CASE WHEN has_pdf THEN 'pdf' ELSE 'image' END AS kind,
      printf('%09d', turn) || CASE WHEN has_pdf THEN '.PDF' ELSE '.Png' END AS name
    FROM t WHERE CASE WHEN has_pdf THEN role = 'system' ELSE role = 'user' END""",
)
def source_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_sources(_files(spark, sf_dir)).select("book_id", "idx", "kind", "name")


@query(
    "unsupported_books",
    "SELECT CAST(conv_id AS VARCHAR) AS book_id FROM conversations GROUP BY conv_id HAVING NOT bool_or(role = 'system' OR (role = 'user' AND conv_id % 3 <> 0))",
)
def books_without_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books with files, none of them supported; the images of every third book are notes here."""
    note = F.col("role").eqNullSafe("user") & (F.col("conv_id") % 3 == 0)
    files = _files(spark, sf_dir).withColumn("name", F.when(note, F.regexp_replace("name", "Png$", "txt")).otherwise(F.col("name")))
    return unsupported_books(files).select("book_id")


@query(
    "page_explode",
    "SELECT conv_id, unnest(range(CAST(max(turn) AS BIGINT))) AS page FROM conversations GROUP BY conv_id",
)
def page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A PDF with as many pages as its last turn says; none for 0."""
    files = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").alias("n_pages"))
    return explode_pages(files).select("conv_id", "page")


@query(
    "ordered_pack",
    """
    SELECT conv_id, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes, md5(string_agg(text, '|' ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id""",
)
def ordered_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = gather_images(_pictures(spark, sf_dir))
    digest = F.md5(F.array_join(F.transform("images_data", lambda d: F.decode(d, "utf-8")), "|").cast("binary"))
    sizes = image_sizes(images).select("book_id", "binary_bytes")
    return images.join(sizes, "book_id").select(F.col("book_id").cast("long").alias("conv_id"), F.col("n_images").alias("n"), F.col("binary_bytes").alias("n_bytes"), digest.alias("digest"))


@query(
    "image_file_names",
    "SELECT CAST(conv_id AS VARCHAR) AS book_id, printf('%s_img_%03d.webp', CAST(conv_id AS VARCHAR), row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS file_name, md5(text) AS digest FROM conversations",
)
def image_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_files(_pictures(spark, sf_dir)).select("book_id", "file_name", F.md5("data").alias("digest"))


@query(
    "image_stage",
    """
    WITH i AS (SELECT conv_id, count(*) FILTER (role <> 'system') AS n_ok, count(*) FILTER (role = 'system') AS n_bad FROM conversations GROUP BY conv_id),
    b AS (SELECT doc_id AS book_id FROM documents UNION SELECT conv_id FROM conversations)
    SELECT CAST(b.book_id AS VARCHAR) AS book_id, coalesce(n_bad, 0) AS n_failed, CASE WHEN n_bad > 0 THEN 'failed' WHEN coalesce(n_ok, 0) = 0 THEN 'empty' ELSE 'ok' END AS strict_status,
      CASE WHEN n_bad > 0 THEN 0 ELSE coalesce(n_ok, 0) END AS strict_images, CASE WHEN n_bad > 0 THEN 'partial' WHEN coalesce(n_ok, 0) = 0 THEN 'empty' ELSE 'ok' END AS lenient_status, coalesce(n_ok, 0) AS lenient_images,
      CASE WHEN n_bad > 0 THEN 'FileNotFoundError: the file could not be read' END AS first_error
    FROM b LEFT JOIN i ON i.conv_id = b.book_id""",
)
def image_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files through the codec and gathered by book under both policies; system turns can't be read, and documents without a conversation are books without pictures."""
    c = table(spark, sf_dir, "conversations")
    book = F.col("conv_id").cast("string")
    sources = c.select(book.alias("book_id"), F.col("turn").alias("idx"), F.concat(book, F.lit("/"), F.col("turn")).alias("path"), F.lit("image").alias("kind"), F.when(F.col("role") != "system", F.col("text").cast("binary")).alias("content"))
    pictures = process_images(sources, codec=PassThroughCodec())
    books = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("book_id")).union(c.select(book))
    strict = gather_images(pictures, books, "fail").select("book_id", "n_failed", F.col("images_status").alias("strict_status"), F.col("n_images").alias("strict_images"), F.try_element_at("errors", F.lit(1)).alias("first_error"))
    lenient = gather_images(pictures, books, "drop").select("book_id", F.col("images_status").alias("lenient_status"), F.col("n_images").alias("lenient_images"))
    return strict.join(lenient, "book_id")


@query(
    "image_sizes",
    """
    SELECT CAST(conv_id AS VARCHAR) AS book_id, count(*) AS n_images, CAST(sum(strlen(text)) AS BIGINT) AS binary_bytes, CAST(sum(length(to_base64(encode(text)))) AS BIGINT) AS base64_chars, round(sum(strlen(text))::DOUBLE / 1048576, 9) AS binary_mb
    FROM conversations GROUP BY conv_id""",
)
def sizes_of_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_sizes(gather_images(_pictures(spark, sf_dir))).withColumn("binary_mb", F.round("binary_mb", 9))


@query(
    "wrapped_images",
    "SELECT CAST(conv_id AS VARCHAR) AS book_id, count(*) AS n_media, md5(string_agg('image/webp,' || to_base64(encode(text)), '|' ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id",
)
def media_of_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wrapped_images(gather_images(_pictures(spark, sf_dir)))
    joined = F.array_join(F.transform("media", lambda m: F.concat_ws(",", m["mime"], m["base64"])), "|")
    return rows.select("book_id", F.size("media").cast("long").alias("n_media"), F.md5(joined.cast("binary")).alias("digest"))


@query(
    "saved_images",
    """
    WITH n AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE strlen(text) > 0)
    SELECT CAST(conv_id AS VARCHAR) AS book_id, i - 1 AS idx, printf('%s_img_%03d.webp', CAST(conv_id AS VARCHAR), i) AS name, CAST(strlen(text) AS BIGINT) AS length, md5(text) AS digest, true AS same FROM n""",
)
def saved_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images saved a folder a book (twice: the second time replaces the first), and the folders loaded again, below their root and one by one."""
    out = _scratch(spark, "images")
    images = _pictures(spark, sf_dir).filter(F.octet_length("data") > 0)
    save_images(images, out)
    save_images(images, out)
    below = load_root(spark, out).select("book_id", "idx", "name", "length", F.md5("content").alias("digest"))
    listed, _ = list_folders(spark, images.select(F.concat(F.lit(f"{out}/"), "book_id").alias("folder")).distinct())
    one_by_one = load_contents(spark, select_sources(listed)).select("book_id", "idx", F.md5("content").alias("again"))
    return below.join(one_by_one, ["book_id", "idx"], "full").withColumn("same", F.col("digest") == F.col("again")).drop("again")


@query(
    "folder_rejects",
    """
    WITH b AS (SELECT DISTINCT conv_id, conv_id % 4 AS k FROM conversations)
    SELECT CASE k WHEN 1 THEN 'gone' WHEN 2 THEN printf('%s_img_001.webp', CAST(conv_id AS VARCHAR)) ELSE CAST(conv_id AS VARCHAR) END AS book_id,
      CASE k WHEN 0 THEN 'no_files' WHEN 1 THEN 'not_found' WHEN 2 THEN 'not_a_directory' END AS reason FROM b WHERE k < 3""",
)
def folder_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every four books one has an empty folder, one a folder that isn't there, one a file for a folder; the fourth is fine."""
    out = _scratch(spark, "folders")
    books = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("book_id"), "conv_id").distinct()
    images = books.filter("conv_id % 4 <> 0").select("book_id", F.lit(0).alias("idx"), F.lit(b"x").alias("data"))
    save_images(images, out, books=books.select("book_id"))
    place = F.concat("book_id", F.when(F.col("conv_id") % 4 == 1, "/gone").when(F.col("conv_id") % 4 == 2, F.concat(F.lit("/"), X.image_file_name("book_id", F.lit(1)))).otherwise(""))
    _, rejects = list_folders(spark, books.select(F.concat(F.lit(f"{out}/"), place).alias("folder")))
    return rejects.select("book_id", "reason")


@query(
    "saved_records",
    """
    SELECT CAST(doc_id AS VARCHAR) AS book_id, CAST(doc_id AS VARCHAR) || '_raw_analysis.json' AS name, lang AS cover, source AS back, true AS has_null FROM documents""",
)
def saved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records saved as a JSON file a book and analysis, and the files read again."""
    out = _scratch(spark, "json")
    d = table(spark, sf_dir, "documents")
    save_json(_analysis(d, F.col("doc_id"), _record(ANALYSES["raw_analysis"], coverPageDescription=F.col("lang"), backCoverDescription=F.col("source"))), "raw_analysis", out)
    files = load_files(spark, out)
    body = F.decode("content", "utf-8")
    return files.select(X.book_of_path("path").alias("book_id"), X.name_of_path("path").alias("name"), F.get_json_object(body, "$.coverPageDescription").alias("cover"), F.get_json_object(body, "$.backCoverDescription").alias("back"), body.rlike('"otherPageDescriptions" *: *null').alias("has_null"))


@query(
    "upserted_catalogue",
    "SELECT CAST(doc_id AS VARCHAR) AS book_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS published_year, source AS cover FROM documents",
)
def upserted_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue written once, every third book again with another year, and read."""
    out = _scratch(spark, "catalogue")
    d = table(spark, sf_dir, "documents")
    raw = _record(ANALYSES["raw_analysis"], coverPageDescription=F.col("source"))

    def rows(year: int) -> DataFrame:
        given = {"book_id": F.col("doc_id").cast("string"), "published_year": F.lit(year).cast("long"), "raw_analysis": raw}
        return d.select(*[given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in CATALOGUE.fields])

    write_catalogue(rows(1), out, buckets=4)
    write_catalogue(rows(2).filter("cast(book_id as bigint) % 3 = 0"), out)
    return read_catalogue(spark, out).select("book_id", "published_year", F.col("raw_analysis.coverPageDescription").alias("cover"))


@query(
    "extraction_flow",
    """
    WITH b AS (SELECT conv_id AS k, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS size FROM conversations GROUP BY conv_id)
    SELECT CAST(k AS VARCHAR) AS book_id, CASE WHEN k % 7 = 0 THEN 'fallback' ELSE 'success' END AS raw_status, CASE WHEN k % 7 = 0 THEN 'ProviderError: no notes' END AS raw_error, CASE WHEN k % 7 = 0 THEN '' ELSE printf('%d images of %d bytes', n, size) END AS cover,
      CASE CAST(n % 6 AS INTEGER) WHEN 0 THEN 'BARU' WHEN 1 THEN 'SANGAT_BAIK' WHEN 2 THEN 'BAIK' WHEN 3 THEN 'CUKUP_BAIK' WHEN 4 THEN 'DITERIMA' ELSE 'BURUK' END AS condition, 'PAPERBACK' AS print_type,
      n AS n_names, n % 2 = 0 AS is_fiction, '0.8' AS blurb, CASE WHEN k % 11 = 0 THEN 'fallback' ELSE 'success' END AS main_status,
      CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 7 = 0 THEN '' ELSE printf('%d images of %d bytes', n, size) END END AS title, CASE WHEN k % 11 <> 0 THEN CAST(1900 + n AS BIGINT) ELSE -1 END AS year, CASE WHEN k % 11 <> 0 THEN CAST(k AS VARCHAR) END AS isbn_13,
      CASE WHEN k % 11 = 0 THEN 0 ELSE -1 END AS n_languages, CASE WHEN k % 13 = 0 THEN 'TypeError: the reply is no text but NoneType' END AS publishing_error, CASE WHEN k % 13 <> 0 THEN n ELSE -1 END AS image_count, CASE WHEN k % 13 <> 0 THEN 'P' END AS publisher, n AS n_images
    FROM b""",
)
def extraction_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five analyses in their two phases, decoded with fallbacks, gathered and put into catalogue records."""
    stages = Stages(spark, _scratch(spark, "flow"))
    images = stages(gather_images(_pictures(spark, sf_dir)), "images")
    done = two_phases(images.select("book_id", "images_data", "n_images"), StubProvider(answer_of_request), stages)
    r = catalogue(gather(images.select("book_id", "images_data"), done))
    return r.select(
        "book_id",
        F.col("raw_analysis_status").alias("raw_status"),
        F.col("raw_analysis_error").alias("raw_error"),
        F.col("raw_analysis.coverPageDescription").alias("cover"),
        F.col("book_condition_summary").alias("condition"),
        "print_type",
        F.size("bookNERData").cast("long").alias("n_names"),
        F.col("isFiction").alias("is_fiction"),
        F.col("book_blurb_text").alias("blurb"),
        F.col("book_main_data_status").alias("main_status"),
        F.col("book_title.title_in_origin_script").alias("title"),
        F.coalesce("published_year", F.lit(-1).cast("long")).alias("year"),
        F.col("isbns.isbn_13").alias("isbn_13"),
        F.coalesce(F.size("language_data.languages"), F.lit(-1)).alias("n_languages"),
        F.col("book_pub_and_dist_details_error").alias("publishing_error"),
        F.coalesce("book_pub_and_dist_details.image_count", F.lit(-1).cast("long")).alias("image_count"),
        F.col("publisher_name.romanized").alias("publisher"),
        F.size("images_data").cast("long").alias("n_images"),
    )


def _prompt_sql(analysis: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    notes = f" || {quoted('Notes of an earlier look at the same photographs:')} || chr(10) || 'n' || conv_id || chr(10) || chr(10)" if analysis in WITH_NOTES else ""
    form = f"{quoted('Answer with one JSON object of this form:')} || chr(10) || {quoted(describe_type(ANALYSES[analysis]))}"
    return f"SELECT conv_id, '{analysis}' AS analysis, md5({quoted(TASKS[analysis])} || chr(10) || chr(10) || lines || chr(10) || chr(10){notes} || {form}) AS digest FROM l"


@query(
    "rendered_prompts",
    "WITH l AS (SELECT conv_id, string_agg(printf('Image %d of %d', i, n), chr(10) ORDER BY i) AS lines FROM (SELECT conv_id, count(*) AS n, unnest(range(1, count(*) + 1)) AS i FROM conversations GROUP BY conv_id) GROUP BY conv_id) "
    + " UNION ALL ".join(_prompt_sql(a) for a in ANALYSES),
)
def rendered_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prompt of each analysis of each book, with notes and the record type where they belong."""
    books = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("notes", F.concat(F.lit("n"), F.col("conv_id").cast("string")))
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("analysis"), F.md5(render(a, F.col("n"), F.col("notes")).cast("binary")).alias("digest")) for a in ANALYSES])).alias("p")
    return books.select("conv_id", each).select("conv_id", "p.analysis", "p.digest")


@query("books_to_ask", "SELECT CAST(doc_id AS VARCHAR) AS book_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def books_to_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, done = (table(spark, sf_dir, n).select(F.col("doc_id").cast("string").alias("book_id")) for n in ("documents", "labels"))
    return not_done(books, done)


@query(
    "record_counts",
    """
    SELECT CAST(d.doc_id AS VARCHAR) AS book_id, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 2 END AS n_genres, len(string_split(d.text, ' ')) AS n_names, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS n_authors,
      coalesce(d.lang <> '', false) AS has_cover, coalesce(l.toxic = 1, false) AS has_colophon FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def counts_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir)
    raw = _record(ANALYSES["raw_analysis"], coverPageDescription=F.col("lang"), colophonPageDescription=F.when(F.col("toxic") == 1, "c").when(F.col("toxic") == 0, ""))
    authors = F.when(F.col("quality") == 1, F.array(F.lit("a"))).when(F.col("quality") == 0, F.array().cast("array<string>"))
    return record_counts(d.select(F.col("doc_id").cast("string").alias("book_id"), F.when(F.col("of").isNotNull(), F.array(F.lit("x"), F.lit("y"))).alias("book_genre"), F.split("text", " ").alias("bookNERData"), authors.alias("authors"), raw.alias("raw_analysis")))


@query("observed_run", "SELECT count(*) AS n_rows, count(*) FILTER (l.doc_id IS NULL) AS not_ok FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def observed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that a run fills in while it goes."""
    rows, seen = observed(_documents(spark, sf_dir).select("doc_id", F.when(F.col("of").isNull(), "fallback").otherwise("success").alias("raw_status")), f"run-{uuid.uuid4().hex}")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], seen.get["not_ok_raw"])], "n_rows long, not_ok long")


@query(
    "thumbnail_dims",
    """
    WITH s AS (SELECT doc_id, n_chars % 3000 + 1 AS w, (n_chars * 7) % 2000 + 1 AS h, (n_chars % 3000 + 1)::DOUBLE / ((n_chars * 7) % 2000 + 1)::DOUBLE AS a FROM documents),
    r AS (SELECT *, CAST(floor(800.0::DOUBLE * a) AS BIGINT) AS w0, CAST(ceil(800.0::DOUBLE * a) AS BIGINT) AS w1, CAST(floor(800.0::DOUBLE / a) AS BIGINT) AS h0, CAST(ceil(800.0::DOUBLE / a) AS BIGINT) AS h1 FROM s),
    o AS (SELECT *, abs(a - w0::DOUBLE / 800.0::DOUBLE) AS ow0, abs(a - w1::DOUBLE / 800.0::DOUBLE) AS ow1, CASE WHEN h0 = 0 THEN 0.0::DOUBLE ELSE abs(a - 800.0::DOUBLE / h0::DOUBLE) END AS oh0, CASE WHEN h1 = 0 THEN 0.0::DOUBLE ELSE abs(a - 800.0::DOUBLE / h1::DOUBLE) END AS oh1 FROM r)
    SELECT doc_id, CASE WHEN w <= 800 AND h <= 800 THEN w WHEN 1.0::DOUBLE >= a THEN greatest(CASE WHEN ow1 < ow0 THEN w1 ELSE w0 END, 1) ELSE 800 END AS width,
      CASE WHEN w <= 800 AND h <= 800 THEN h WHEN 1.0::DOUBLE >= a THEN 800 ELSE greatest(CASE WHEN oh1 < oh0 THEN h1 ELSE h0 END, 1) END AS height FROM o""",
)
def thumbnail_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = X.fitted_size(F.col("n_chars") % 3000 + 1, (F.col("n_chars") * 7) % 2000 + 1)
    return table(spark, sf_dir, "documents").select("doc_id", size.alias("s")).select("doc_id", "s.width", "s.height")


@query("base64_encode", "SELECT conv_id, turn, to_base64(encode(text)) AS b64, length(to_base64(encode(text))) AS n_chars FROM conversations")
def base64_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    b64 = X.base64_unbroken(F.col("text").cast("binary"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", b64.alias("b64")).withColumn("n_chars", F.length("b64").cast("long"))


@query(
    "size_metrics",
    """
    SELECT CAST(conv_id AS VARCHAR) AS book_id, count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS disk_bytes, round(sum(strlen(text))::DOUBLE / 1048576, 9) AS disk_mb,
      string_agg(DISTINCT CASE role WHEN 'system' THEN '.pdf' WHEN 'user' THEN '.png' ELSE '.txt' END, ' ' ORDER BY CASE role WHEN 'system' THEN '.pdf' WHEN 'user' THEN '.png' ELSE '.txt' END) AS extensions
    FROM conversations GROUP BY conv_id""",
)
def size_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disk_sizes(_files(spark, sf_dir)).withColumn("disk_mb", F.round("disk_mb", 9))


@query(
    "presence_flags",
    """
    SELECT d.doc_id, coalesce(d.text <> '', false) AS has_text, l.doc_id IS NOT NULL AS has_label, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 + CAST(l.toxic AS BIGINT) END AS n_flags
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def presence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("of"), F.when(F.col("toxic") == 1, F.array(F.lit("quality"), F.lit("toxic"))).otherwise(F.array(F.lit("quality"))).alias("flags"))
    joined = table(spark, sf_dir, "documents").join(flags, F.col("doc_id") == F.col("of"), "left")
    return joined.select("doc_id", X.present("text").alias("has_text"), F.col("of").isNotNull().alias("has_label"), F.coalesce(F.size("flags").cast("long"), F.lit(0).cast("long")).alias("n_flags"))


@query("extension_sets", "SELECT conv_id, string_agg(DISTINCT role, ' ' ORDER BY role) AS roles, count(DISTINCT role) AS n_roles FROM conversations GROUP BY conv_id")
def extension_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("s"))
    return rows.select("conv_id", F.array_join("s", " ").alias("roles"), F.size("s").cast("long").alias("n_roles"))


@query("json_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, true AS ok, CAST(json_extract(props, '$.k') AS BIGINT) AS k_fenced FROM events")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies decoded as they are, and again inside a fence with a comment and a trailing comma."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    fenced = F.concat(F.lit("Here it is:\n```json\n"), F.regexp_replace("props", r"\}$", ", // note\n}"), F.lit("\n```"))
    rows = table(spark, sf_dir, "events").select("event_id", F.explode(F.array(X.lenient_json("props", schema))).alias("a"), fenced.alias("fenced"))
    rows = rows.select("event_id", "a", F.explode(F.array(X.lenient_json("fenced", schema))).alias("b"))
    return rows.select("event_id", F.col("a.record.k").alias("k"), (F.col("a.ok") & F.col("b.ok")).alias("ok"), F.col("b.record.k").alias("k_fenced"))


@query(
    "enum_decode",
    """
    SELECT doc_id, CASE lang WHEN 'en' THEN 'BARU' WHEN 'de' THEN 'SANGAT_BAIK' WHEN 'fr' THEN 'BURUK' END AS condition, CASE lang WHEN 'en' THEN 'HARDCOVER' WHEN 'de' THEN 'FOTOKOPI' END AS print_type FROM documents""",
)
def enum_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias = F.when(F.col("lang") == "en", "c1").when(F.col("lang") == "de", " C2 ").when(F.col("lang") == "fr", "buruk").otherwise("c9")
    kind = F.when(F.col("lang") == "en", "pt1").when(F.col("lang") == "de", "Fotokopi").otherwise("pt")
    return table(spark, sf_dir, "documents").select("doc_id", X.condition_of(alias).alias("condition"), X.print_type_of(kind).alias("print_type"))


@query("double_write_compat", "SELECT doc_id, 2 * count(*) AS n FROM documents GROUP BY doc_id")
def double_write_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_twice(table(spark, sf_dir, "documents").select("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "single_write_idempotent",
    "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1",
)
def single_write_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query(
    "raw_to_json",
    "SELECT CAST(d.doc_id AS VARCHAR) AS book_id, CAST(to_json({'id': d.doc_id, 'source': d.source, 'quality': l.quality}) AS VARCHAR) AS notes FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def raw_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(F.col("doc_id").alias("id"), "source", "quality")
    return raw_notes(_analysis(_documents(spark, sf_dir), F.col("doc_id"), record))


@query("prompt_render", "SELECT conv_id, string_agg(printf('Image %d of %d', i, n), chr(10) ORDER BY i) AS prompt FROM (SELECT conv_id, count(*) AS n, unnest(range(1, count(*) + 1)) AS i FROM conversations GROUP BY conv_id) GROUP BY conv_id")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", image_lines(F.col("n")).alias("prompt"))


@query("phase_eligibility", "SELECT conv_id FROM conversations WHERE role = 'user' INTERSECT SELECT conv_id FROM conversations WHERE role = 'assistant'")
def phase_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books that both analyses of the first phase have a row for: one pass and one shuffle instead of an intersection of two scans."""
    seen = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "user").alias("a"), F.bool_or(F.col("role") == "assistant").alias("b"))
    return seen.filter("a and b").select("conv_id")


@query(
    "fallback_defaults",
    """
    SELECT d.doc_id, l.doc_id IS NULL AS is_fallback, CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 1 THEN 'BAIK' ELSE 'BURUK' END AS condition,
      CASE WHEN l.doc_id IS NULL THEN '' ELSE d.source END AS cover, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS n_names, CASE WHEN l.doc_id IS NULL THEN false ELSE l.toxic = 1 END AS is_fiction,
      CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS n_languages, CASE WHEN l.doc_id IS NULL THEN NULL ELSE d.lang END AS publisher
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def fallback_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of all five analyses decoded; where a document has no labels the call failed, and each analysis gives its default."""
    d = _documents(spark, sf_dir)
    replies = {
        "book_condition_data": F.struct(F.when(F.col("quality") == 1, "c3").otherwise("c6").alias("Condition")),
        "raw_analysis": F.struct(F.col("source").alias("coverPageDescription")),
        "book_content_hints": F.struct(F.array("source").alias("bookNERData"), (F.col("toxic") == 1).alias("isFiction")),
        "book_main_data": F.struct(F.array("lang").alias("language")),
        "book_pub_and_dist_details": F.struct(F.struct(F.col("lang").alias("original_script")).alias("publisher_name")),
    }
    there = F.col("of").isNotNull()
    rows = None
    for name, reply in replies.items():
        calls = d.select(F.col("doc_id").cast("string").alias("book_id"), F.when(there, F.to_json(reply)).alias("reply"), F.when(~there, "no answer").alias("call_error"))
        one = decode_replies(calls, name).select("book_id", F.col("record").alias(name), F.col("status").alias(f"{name}_status"))
        rows = one if rows is None else rows.join(one, "book_id")
    failed = [F.col(f"{name}_status") == "fallback" for name in replies]
    return rows.select(
        F.col("book_id").cast("long").alias("doc_id"),
        F.forall(F.array(*failed), lambda x: x).alias("is_fallback"),
        F.col("book_condition_data.Condition").alias("condition"),
        F.col("raw_analysis.coverPageDescription").alias("cover"),
        F.size("book_content_hints.bookNERData").alias("n_names"),
        F.col("book_content_hints.isFiction").alias("is_fiction"),
        F.size("book_main_data.language").alias("n_languages"),
        F.col("book_pub_and_dist_details.publisher_name.original_script").alias("publisher"),
    )


@query(
    "isbn_check",
    """
    WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][0-9-]+')) AS digits FROM documents)
    SELECT doc_id, digits, regexp_matches(replace(digits, '-', ''), '^[0-9]{13}$') AS isbn_13, regexp_matches(replace(digits, '-', ''), '^[0-9]{10}$') AS isbn_10,
      regexp_matches(replace(digits, '-', '') || 'X', '^[0-9]{9}[0-9Xx]$') AS isbn_10_with_x, coalesce(TRY_CAST(digits AS BIGINT) BETWEEN 1000 AND 9999, false) AS is_year
    FROM d""",
)
def isbn_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of digits and hyphens of every text."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9][0-9-]+"), F.lit(0))).alias("digits"))
    year = F.coalesce(F.col("digits").try_cast("bigint").between(1000, 9999), F.lit(False))
    return rows.select("doc_id", "digits", X.isbn_ok("digits", 13).alias("isbn_13"), X.isbn_ok("digits", 10).alias("isbn_10"), X.isbn_ok(F.concat("digits", F.lit("X")), 10, final_x=True).alias("isbn_10_with_x"), year.alias("is_year"))


@query(
    "confidence_band",
    """
    WITH e AS (SELECT event_id, value / 100 AS v FROM events)
    SELECT event_id, CASE WHEN v < 0 OR v > 1 THEN 'out_of_range' WHEN v >= 0.9::DOUBLE THEN 'very_high' WHEN v >= 0.7::DOUBLE THEN 'high' WHEN v >= 0.5::DOUBLE THEN 'medium' WHEN v >= 0.3::DOUBLE THEN 'low' WHEN v >= 0 THEN 'very_low' END AS band,
      v BETWEEN 0 AND 1 AS in_range FROM e""",
)
def confidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value") / 100
    return table(spark, sf_dir, "events").select("event_id", X.confidence_band(v).alias("band"), v.between(0, 1).alias("in_range"))


@query(
    "domain_checks",
    """
    SELECT event_id, event_type IN ('click', 'view', 'purchase') AS in_domain,
      CAST(CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN 0 WHEN 'purchase' THEN 6 ELSE -1 END AS BIGINT) AS severity_rank FROM events""",
)
def domain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("event_type") == "click", "Major").when(F.col("event_type") == "view", "none").when(F.col("event_type") == "purchase", " critical").otherwise("awful")
    return table(spark, sf_dir, "events").select("event_id", in_domain(F.col("event_type"), ("click", "view", "purchase")).alias("in_domain"), F.coalesce(X.severity_rank(word).cast("long"), F.lit(-1).cast("long")).alias("severity_rank"))


@query(
    "image_number_range",
    """
    SELECT conv_id, count(*) AS n, min(turn) + 1 AS first_number, max(turn) + 1 AS last_number, max(turn) = count(*) - 1 AND min(turn) = 0 AS numbers_ok FROM conversations GROUP BY conv_id""",
)
def image_number_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("book_id")).agg(F.collect_list(F.col("turn") + 1).alias("numbers"))
    kind = CATALOGUE["book_condition_data"].dataType
    observed_images = F.transform("numbers", lambda i: _record(kind["physicalObservations"].dataType.elementType, imageNumber=i))
    rows = gather_images(_pictures(spark, sf_dir)).join(seen, "book_id").select("book_id", "n_images", "numbers", "images_data", _record(kind, physicalObservations=observed_images).alias("book_condition_data"), *[F.lit(None).cast(ANALYSES[n]).alias(n) for n in ("book_main_data", "book_pub_and_dist_details")])
    return rows.select(F.col("book_id").cast("long").alias("conv_id"), F.col("n_images").alias("n"), F.array_min("numbers").alias("first_number"), F.array_max("numbers").alias("last_number"), rules()["image_numbers"].alias("numbers_ok"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as catalogue records whose fields keep or break the rules by doc_id."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    kinds = {n: CATALOGUE[n].dataType for n in ("book_main_data", "book_pub_and_dist_details", "book_condition_data", "book_content_hints")}
    item = lambda n, field, **v: F.array(_record(kinds[n][field].dataType.elementType, **v))
    own = lambda n, field, **v: _record(kinds[n][field].dataType, **v)
    digits = F.lpad(k.cast("string"), 10, "0")
    main = _record(
        kinds["book_main_data"],
        isbn_13=F.when(k % 3 == 0, F.concat(F.lit("978-"), digits)).when(k % 3 == 1, digits),
        isbn_10=F.when(k % 3 == 0, digits).when(k % 3 == 1, F.concat(F.lit("123456789"), F.lit("X"))),
        published_year=k * 7,
        confidence=k.cast("double") / 500,
        title=own("book_main_data", "title", title_in_latin_script=F.when(k % 5 == 0, "\u00e9t\u00e9").otherwise("ete"), title_in_origin_script=F.lit("a"), title_in_indonesian=F.when(k % 4 == 0, "A ").otherwise("b")),
        language=F.when(k % 2 == 0, F.array(F.lit("Indonesian"))).otherwise(F.array(F.lit("French"))),
        translator=F.when(k % 3 == 0, item("book_main_data", "translator", translators_in_latin_script=F.lit("T"))),
        extractionEvidence=item("book_main_data", "extractionEvidence", imageNumber=k % 5, confidence=F.when(k % 4 == 0, "sure").otherwise("High "), textType=F.when(k % 2 == 0, "Translator name").otherwise("title")),
        dataComparisons=item("book_main_data", "dataComparisons", fromImages=F.col("lang"), fromNotes=F.lit("EN "), agreement=k % 2 == 0),
    )
    pub = _record(
        kinds["book_pub_and_dist_details"],
        confidence=k.cast("double") / 100 - 1,
        image_count=k % 6,
        publisher_name=F.when(k % 2 == 0, own("book_pub_and_dist_details", "publisher_name", original_script=F.lit("P"))),
        distributor_name=F.when(k % 3 == 0, own("book_pub_and_dist_details", "distributor_name", original_script=F.when(k % 4 == 0, "p ").otherwise("q"))),
        publisher_location=own("book_pub_and_dist_details", "publisher_location", country=F.when(k % 3 == 0, "Indonesia").otherwise("Indonesie")),
        roleDistinction=own("book_pub_and_dist_details", "roleDistinction", publisherIdentified=k % 2 == 0, editorIdentified=F.lit(False), distributorIdentified=k % 5 == 0),
    )
    cond = _record(
        kinds["book_condition_data"],
        physicalObservations=item("book_condition_data", "physicalObservations", imageNumber=F.lit(1), severityLevel=F.when(k % 6 == 0, "awful").otherwise("Minor"), readabilityImpact=F.when(k % 5 == 0, "none").otherwise("No impact")),
        conditionAnalysis=own("book_condition_data", "conditionAnalysis", preservationUrgency=F.when(k % 2 == 0, "routine care: dust").otherwise("urgent")),
        printTypeAnalysis=own("book_condition_data", "printTypeAnalysis", coverMaterial=F.when(k % 3 == 0, "plastic").otherwise("paper, worn"), bindingType=F.when(k % 4 == 0, "glued").otherwise("perfect binding (glued)")),
    )
    names = F.array(F.lit("a"), F.when(k % 2 == 0, "a").otherwise("b"))
    hints = _record(kinds["book_content_hints"], bookBlurbText=F.when(k % 3 == 0, "No blurb text available").when(k % 3 == 1, F.col("source")), bookNERData=names, nerCandidates=F.when(k % 3 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))))
    images = F.transform(F.sequence(F.lit(1), F.greatest((k % 4).cast("int"), F.lit(1))), lambda i: F.lit(b"x"))
    return d.select(
        k.cast("string").alias("book_id"), images.alias("images_data"), main.alias("book_main_data"), pub.alias("book_pub_and_dist_details"), cond.alias("book_condition_data"), hints.alias("book_content_hints"),
        X.condition_of(F.when(k % 7 == 0, "c9").otherwise("c2")).alias("book_condition_summary"), F.when(k % 7 == 0, "BOOK").otherwise("PAPERBACK").alias("print_type"),
    )


@query(
    "record_checks",
    """
    WITH r AS (SELECT doc_id AS k, lang, source, lpad(CAST(doc_id AS VARCHAR), 10, '0') AS digits, greatest(doc_id % 4, 1) AS n, doc_id::DOUBLE / 500 AS c, doc_id::DOUBLE / 100 - 1 AS p FROM documents),
    f AS (SELECT CAST(k AS VARCHAR) AS book_id,
      CASE k % 3 WHEN 0 THEN length(digits) = 10 WHEN 1 THEN false END AS ok_isbn_13, CASE k % 3 WHEN 0 THEN length(digits) = 10 WHEN 1 THEN false END AS ok_isbn_10, CASE k % 3 WHEN 0 THEN length(digits) = 10 WHEN 1 THEN true END AS ok_isbn_10_with_x,
      k * 7 BETWEEN 1000 AND 9999 AS ok_year, c BETWEEN 0 AND 1 AS ok_main_confidence, p BETWEEN 0 AND 1 AS ok_publishing_confidence, k % 4 <> 0 AS ok_text_confidence, k % 6 <> 0 AS ok_severity, k % 5 <> 0 AS ok_readability,
      k % 2 = 0 AS ok_urgency, k % 3 <> 0 AS ok_cover, k % 4 <> 0 AS ok_binding, k % 5 BETWEEN 1 AND n AS ok_image_numbers, n = 1 AS ok_one_observation_per_image, k % 6 = n AS ok_image_count, k % 5 <> 0 AS ok_latin_is_ascii,
      (coalesce(lower(trim(lang)), '') = 'en') = (k % 2 = 0) AS ok_agreement, k % 2 <> 0 AS ok_names_distinct, k % 2 = 0 OR k % 3 <> 0 AS ok_names_from_candidates, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN coalesce(trim(source) <> '', false) ELSE false END AS ok_blurb,
      CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN k % 4 <> 0 END AS ok_distributor_is_other, CASE WHEN k % 3 = 0 THEN k % 2 = 0 END AS ok_translator_has_evidence, CASE WHEN k % 2 = 0 THEN k % 4 = 0 END AS ok_indonesian_title,
      CASE WHEN k % 7 <> 0 THEN true END AS ok_condition, k % 7 <> 0 AS ok_print_type, (k % 3 = 0) = (k % 5 = 0) AS ok_roles, n >= 2 AS ok_two_images, k % 3 = 0 AS ok_country,
      k % 3 = 1 AND coalesce(trim(source) <> '', false) AS has_blurb,
      CASE WHEN c < 0 OR c > 1 THEN 'out_of_range' WHEN c >= 0.9::DOUBLE THEN 'very_high' WHEN c >= 0.7::DOUBLE THEN 'high' WHEN c >= 0.5::DOUBLE THEN 'medium' WHEN c >= 0.3::DOUBLE THEN 'low' ELSE 'very_low' END AS main_band,
      CASE WHEN p < 0 OR p > 1 THEN 'out_of_range' WHEN p >= 0.9::DOUBLE THEN 'very_high' WHEN p >= 0.7::DOUBLE THEN 'high' WHEN p >= 0.5::DOUBLE THEN 'medium' WHEN p >= 0.3::DOUBLE THEN 'low' ELSE 'very_low' END AS publishing_band FROM r)
    SELECT book_id, has_blurb, main_band, publishing_band, """
    + ", ".join(f"coalesce(CAST(ok_{name} AS VARCHAR), 'none') AS ok_{name}" for name in RULES)
    + ", CAST("
    + " + ".join(f"CASE WHEN ok_{name} THEN 0 WHEN ok_{name} IS NULL THEN 0 ELSE 1 END" for name in RULES)
    + """ AS BIGINT) AS n_broken FROM f""",
)
def record_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data rules over a record of each document; a flag that has nothing to look at is 'none'."""
    flags = check(_checked(spark, sf_dir), countries=("Indonesia",))
    return flags.withColumns({f"ok_{name}": F.coalesce(F.col(f"ok_{name}").cast("string"), F.lit("none")) for name in RULES}).withColumn("has_blurb", F.coalesce("has_blurb", F.lit(False)))


@query("ascii_safe", "SELECT doc_id, strlen(text) = length(text) AS is_ascii FROM documents")
def ascii_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.ascii_safe("text").alias("is_ascii"))


@query("ascii_safe_pattern", "SELECT item_id, regexp_full_match(text, '[\\x00-\\x7F]*', 's') AS is_ascii FROM benchmark")
def ascii_safe_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", X.ascii_safe("text").alias("is_ascii"))


@query(
    "evidence_agreement",
    "SELECT l.doc_id, l.quality, l.toxic, (trim(lower(b.text)) = trim(lower(d.text))) = (l.quality = 1) AS flag_ok FROM labels l JOIN benchmark b ON b.item_id = l.doc_id JOIN documents d ON d.doc_id = l.doc_id",
)
def evidence_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("item"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = labels.join(items, "doc_id").join(docs, "doc_id")
    return rows.select("doc_id", "quality", "toxic", agreement_ok(F.col("item"), F.col("text"), F.col("quality") == 1).alias("flag_ok"))


@query(
    "ner_dedup",
    "SELECT doc_id, len(string_split(text, ' ')) AS n_candidates, len(list_distinct(string_split(text, ' '))) AS n_names, len(list_distinct(string_split(text, ' '))) = len(string_split(text, ' ')) AS is_distinct FROM documents",
)
def ner_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = ANALYSES["book_content_hints"]
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("c")).select("doc_id", "c", _record(kind, bookNERData=F.col("c")).alias("book_content_hints"))
    return rows.select("doc_id", F.size("c").cast("long").alias("n_candidates"), F.size(F.array_distinct("c")).cast("long").alias("n_names"), rules()["names_distinct"].alias("is_distinct"))


def _retrying(policy) -> Retrying:
    flaky = FailingFirst()
    return Retrying(flaky, policy, flaky.wait)


def _asked(books: DataFrame, provider) -> DataFrame:
    """(book_id, reply, call_error) of a provider for ``books`` (book_id, prompt)."""
    rows = books.select("book_id", F.lit(None).cast("array<binary>").alias("images_data"), F.col("prompt").alias("prompt_raw_analysis"))
    return call_model(rows, ("raw_analysis",), provider).drop("analysis")


@query(
    "retry_schedule",
    """
    WITH b AS (SELECT DISTINCT conv_id, conv_id % 5 AS f FROM conversations)
    SELECT CAST(conv_id AS VARCHAR) AS book_id, 'constant' AS policy, CASE WHEN f <= 3 THEN printf('%d tries, %d ms', f + 1, f * 200) END AS reply, CASE WHEN f > 3 THEN 'ProviderError: later' END AS call_error FROM b
    UNION ALL SELECT CAST(conv_id AS VARCHAR), 'exponential', CASE WHEN f <= 2 THEN printf('%d tries, %d ms', f + 1, CASE f WHEN 0 THEN 0 WHEN 1 THEN 300 ELSE 750 END) END, CASE WHEN f > 2 THEN 'ProviderError: later' END FROM b""",
)
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers that fail up to four times, under both retry policies."""
    books = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("book_id"), (F.col("conv_id") % 5).cast("string").alias("prompt")).distinct()
    each = [_asked(books, _retrying(p)).withColumn("policy", F.lit(name)) for name, p in (("constant", CONSTANT), ("exponential", EXPONENTIAL))]
    return each[0].unionByName(each[1]).select("book_id", "policy", "reply", "call_error")


@query("round_robin", "SELECT CASE ('0x' || substr(md5(CAST(conv_id AS VARCHAR)), 1, 8))::BIGINT % 3 WHEN 0 THEN 'first' WHEN 1 THEN 'second' ELSE 'third' END AS client, count(DISTINCT conv_id) AS n_books FROM conversations GROUP BY 1")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books spread over three providers of a registry."""
    registry = Registry()
    for name in ("first", "second", "third"):
        registry.add(name, Named(name))
    turns = registry.build("turns", {"kind": "round_robin", "of": ["first", "second", "third"]})
    books = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("book_id"), F.lit("p").alias("prompt")).distinct()
    return _asked(books, turns).groupBy(F.col("reply").alias("client")).agg(F.count(F.lit(1)).alias("n_books"))


@query(
    "fallback_chain",
    """
    SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'label' END, b.text, d.source) AS answer, CASE WHEN l.quality = 1 THEN 1 WHEN b.text IS NOT NULL THEN 2 ELSE 3 END AS answered_by
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id""",
)
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of three providers; each has an answer only if the prompt holds one for it."""
    first = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "label").alias("a"))
    second = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("b"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(first, "doc_id", "left").join(second, "doc_id", "left")
    books = rows.select(F.col("doc_id").cast("string").alias("book_id"), F.to_json(F.struct("a", "b", "source")).alias("prompt"))
    answers = _asked(books, FirstOf(tuple(Member(i, key) for i, key in enumerate(("a", "b", "source"))))).select("book_id", F.from_json("reply", "answered_by int, answer string").alias("r"))
    return answers.select(F.col("book_id").cast("long").alias("doc_id"), "r.answer", "r.answered_by")


@query(
    "json_file_names",
    """
    SELECT CAST(doc_id AS VARCHAR) AS book_id, CAST(doc_id AS VARCHAR) || '_book_condition_data.json' AS file_name,
      json_extract_string(to_json({'Condition': CASE lang WHEN 'en' THEN 'BARU' END, 'PrintType': source}), '$.Condition') AS condition, source AS print_type, lang <> 'en' OR lang IS NULL AS has_null FROM documents""",
)
def json_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(X.condition_of(F.when(F.col("lang") == "en", "c1")).alias("Condition"), F.col("source").alias("PrintType"))
    files = json_files(_analysis(table(spark, sf_dir, "documents"), F.col("doc_id"), record), "book_condition_data")
    body = F.decode("data", "utf-8")
    return files.select("book_id", "file_name", F.get_json_object(body, "$.Condition").alias("condition"), F.get_json_object(body, "$.PrintType").alias("print_type"), body.contains("null").alias("has_null"))


@query(
    "condition_ranks",
    "SELECT CASE quality WHEN 1 THEN 'BAIK' ELSE 'BURUK' END AS condition, CASE quality WHEN 1 THEN 3 ELSE 6 END AS rank, count(*) AS n FROM labels GROUP BY quality",
)
def condition_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    condition = X.condition_of(F.when(F.col("quality") == 1, "c3").otherwise("c6"))
    return per.select(condition.alias("condition"), F.array_position(F.array(*[F.lit(v) for v in CONDITION_ALIASES.values()]), condition).cast("int").alias("rank"), "n")


_SEARCH_SQL = """
    WITH p AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]) * list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])) AS s
      FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, vec_id, round(s, 4) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, vec_id) AS n FROM p) WHERE n <= 5"""


@query("vector_topk", _SEARCH_SQL)
@query("vector_search", _SEARCH_SQL)
def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search over vectors, an extension: the 5 most similar of all vectors to every row whose vec_id is divisible by 20, exact. Registered under two names."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).withColumn("similarity", F.round("similarity", 4))
