"""Model extraction: prompt, call, decode, with a status for every row.

The call is the only step in Python. What it returns is written to a stage table
before anything else reads it, as a call costs money and its answer may differ
the next time: joins and branches then read the table and never call again.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions import condition_of, lenient_json, print_type_of
from folioloom.plans.prompts import render
from folioloom.plans.providers import Provider, Request
from folioloom.plans.schemas import ANALYSES, FALLBACKS

REPLIES = "book_id string, analysis string, reply string, call_error string"


def fallback_record(analysis: str) -> Column:
    """What an analysis gives when it fails, as a typed literal."""
    schema = ANALYSES[analysis]
    return F.from_json(F.lit(json.dumps(dict(FALLBACKS[analysis]))), schema) if FALLBACKS[analysis] else F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def call_model(books: DataFrame, analyses: tuple[str, ...], provider: Provider, temperature: float = 0.0) -> DataFrame:
    """(book_id, analysis, reply, call_error) for each book of ``books`` (book_id, images_data, prompt_<analysis>) and analysis with a prompt.

    A book's calls run side by side, so its pictures go to Python once for all of
    them. A null prompt isn't asked. An error, or a reply that isn't a text, is a
    row and never a failed task. Spark bounds a batch by its bytes, so a batch of
    many pictures has few books.
    """

    def run(batches):
        with ThreadPoolExecutor(len(analyses)) as pool:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    pictures = tuple(("image/webp", bytes(d)) for d in (row.images_data if row.images_data is not None else ()))

                    def one(analysis, row=row, pictures=pictures):
                        try:
                            reply = provider.reply(Request(analysis, row.book_id, getattr(row, f"prompt_{analysis}"), pictures, temperature))
                            if not isinstance(reply, str):
                                raise TypeError(f"the reply is no text but {type(reply).__name__}")
                            return row.book_id, analysis, reply, None
                        except Exception as error:
                            return row.book_id, analysis, None, f"{type(error).__name__}: {error}"

                    asked = [a for a in analyses if getattr(row, f"prompt_{a}") is not None]
                    yield pd.DataFrame(list(pool.map(one, asked)), columns=["book_id", "analysis", "reply", "call_error"])

    return books.select("book_id", "images_data", *[f"prompt_{a}" for a in analyses]).mapInPandas(run, REPLIES)


def decode_replies(replies: DataFrame, analysis: str) -> DataFrame:
    """(book_id, record, status, error): the reply as a typed record, or the analysis's fallback with the reason."""
    schema: T.StructType = ANALYSES[analysis]
    # One evaluation of the parser for its four uses.
    read = replies.select("book_id", "call_error", F.explode(F.array(lenient_json("reply", schema))).alias("r"))
    good = F.col("call_error").isNull() & F.col("r.ok")
    record = F.col("r.record")
    if analysis == "book_condition_data":
        record = record.withField("Condition", condition_of(F.col("r.record.Condition"))).withField("PrintType", print_type_of(F.col("r.record.PrintType")))
    error = F.when(F.col("call_error").isNotNull(), F.col("call_error")).when(~F.col("r.ok"), "the reply holds no readable JSON object")
    return read.select("book_id", F.when(good, record).otherwise(fallback_record(analysis)).alias("record"), F.when(good, "success").otherwise("fallback").alias("status"), error.alias("error"))


def ask(books: DataFrame, analyses: tuple[str, ...], provider: Provider, stage, notes: bool = False, temperature: float = 0.0, log: str | None = None) -> DataFrame:
    """Replies of ``analyses`` for all ``books`` (book_id, images_data, n_images, notes if asked for): called once each, staged.

    ``stage`` is a function (df, name) that writes a table and reads it again. With
    ``log``, the path of a table of replies, what it holds of earlier runs isn't
    asked again, and new replies are added to it before anything reads them.
    """
    spark = books.sparkSession
    prompted = books.withColumns({f"prompt_{a}": render(a, F.col("n_images"), F.col("notes") if notes else None) for a in analyses})
    if log is None:
        return stage(call_model(prompted, analyses, provider, temperature), f"replies-{analyses[0]}")
    schema = T.StructType.fromDDL(REPLIES)
    held = spark.read.schema(schema).parquet(log) if _has_rows(spark, log) else spark.createDataFrame([], schema)
    good = held.filter(F.col("call_error").isNull() & F.col("analysis").isin(*analyses)).groupBy("book_id", "analysis").agg(F.max("reply").alias("reply"))
    good = stage(good.select("book_id", "analysis", "reply", F.lit(None).cast("string").alias("call_error")), f"known-{analyses[0]}")
    known = good.groupBy("book_id").agg(F.collect_set("analysis").alias("known"))  # at most the analyses
    left = prompted.join(known, "book_id", "left")
    left = left.withColumns({f"prompt_{a}": F.when(F.coalesce(F.array_contains("known", a), F.lit(False)), None).otherwise(F.col(f"prompt_{a}")) for a in analyses})
    todo = not_done(left, known.filter(F.size("known") == len(analyses)))
    asked = stage(call_model(todo, analyses, provider, temperature), f"replies-{analyses[0]}")
    asked.write.mode("append").parquet(log)
    return good.join(books.select("book_id"), "book_id", "left_semi").unionByName(asked)


def _has_rows(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def extract(books: DataFrame, analyses: tuple[str, ...], provider: Provider, stage, notes: bool = False, temperature: float = 0.0, log: str | None = None) -> dict[str, DataFrame]:
    """Several analyses of all ``books``, by name: asked side by side, decoded, staged."""
    replies = ask(books, analyses, provider, stage, notes, temperature, log)
    return {a: stage(decode_replies(replies.filter(F.col("analysis") == a), a), a) for a in analyses}


def not_done(books: DataFrame, done: DataFrame) -> DataFrame:
    """Books that have no row in ``done`` yet; filtered before the call, as nothing is pushed below it."""
    return books.join(done.select("book_id"), "book_id", "left_anti")


def raw_notes(raw: DataFrame) -> DataFrame:
    """(book_id, notes): the raw record as JSON with nulls kept, for the prompts of the second phase."""
    return raw.select("book_id", F.to_json("record", {"ignoreNullFields": "false"}).alias("notes"))
