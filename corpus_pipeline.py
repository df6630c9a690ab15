"""The corpus pipeline: five stages from the table of documents to token files.

Each stage is a function of (spark, docs, sf_dir); it works on all rows that its
predecessor kept and, but for the last, returns the columns of ``docs``, whatever
their names. The tables that a stage writes for itself are in
``spark.checkpoint.dir``. A stage's result is to be written before the next stage
begins, as ``run`` does: what it was computed from goes then, unless ``docs``
still reads it. Token files stay.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from folioloom.llm import decontamination, language_id, mixing, near_dedup, token_files
from folioloom.llm.common import drop_paths, drop_staged, read_table, stage, stage_path, staged_since


class _Left(threading.local):
    """What earlier stages of this thread's run have written for themselves."""

    def __init__(self):
        self.paths: list[str] = []


_left = _Left()


def tidy(apply: Callable) -> Callable:
    """A stage that first deletes what earlier stages have left, and notes what it leaves itself."""

    @wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _left.paths = drop_staged(docs, _left.paths)
        mark = len(staged_since())
        out = apply(spark, docs, sf_dir)
        _left.paths = _left.paths + staged_since(mark)
        return out

    return run_stage


@tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID by rank-order profiles; texts without letters, or unlike every learned language, go.

    Profiles are learned from the rows with lang that aren't held out; lang of a row
    plays no part in its own fate. Null and empty texts have no letters and go. Very
    long texts count whole. Equal distances give the first language by code point;
    either way the row stays. Repeated rows share their fate. Without any row with
    lang nothing can be told, and all rows go. An empty table stays empty.
    """
    return language_id.keep_identified(docs, language_id.learned(docs))


@tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup; of each group the row with the smallest doc_id stays. Five-word shingles, similarity from 0.8.

    Null and empty texts are linked with nothing and stay. Very long texts are
    compared whole. A null doc_id counts as the largest. Of repeated rows of the
    smallest doc_id exactly one stays. An empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


@tidy
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination; documents with a window of a benchmark item go.

    Null and empty texts have no windows and stay; very long ones are scanned whole.
    Null, empty and repeated items change nothing; without items all rows stay.
    Repeated rows share their fate. An empty table stays empty.
    """
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


@tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights; documents are repeated or left out so that sources come near their targets.

    A null source is a source, the last one. Null and empty texts have no words;
    very long ones are counted whole. Rows with the same doc_id and as many words
    are taken alike. A source without words is left out. An empty table stays empty.
    """
    return mixing.mix_sources(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens and the crc32 of the ids of every document of the mix.

    Null and empty texts give the end id alone. Very long texts are one row of ids.
    Rows are in the order of doc_id, null first, and then of their texts; every copy
    of a repeated row has its own ids. An empty table gives files without rows.
    """
    _left.paths = drop_staged(docs, _left.paths)
    out = stage_path(spark, "pipeline-tokens")
    token_files.write_token_files(docs, out)
    return token_files.token_digests(spark, out)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", tokenize),
]

#: Language ID and the near-duplicate search aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is written and read again for the next, and goes when the next one is written."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
        drop_paths(spark, before)
        before = staged_since()[-1:]
    out = STAGES[-1][1](spark, docs, sf_dir)
    drop_paths(spark, before)  # the last stage's result is staged
    return out
