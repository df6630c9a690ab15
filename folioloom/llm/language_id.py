"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters, words
padded with a boundary) of a language, most frequent first. A document is given
the language whose profile is nearest by out-of-place distance: the sum, over
the document's own most frequent n-grams, of how far each stands from its place
in the profile, or a fixed penalty where the profile lacks it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, release, slices, stage

#: n-grams of a profile, and the penalty for one that a profile lacks.
PROFILE = 300
#: Documents per language that profiles are learned from, as an expected number of a hash sample; whole texts of them are read.
TRAIN_DOCS = 4000
#: Least score of a document that the pipeline keeps.
LEAST_SCORE = 0.25
#: Characters whose n-grams are made together.
SPAN = 1 << 18
#: The answer for a text without letters.
UNDETERMINED = "und"

_BOUNDARY = 1
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str):
    """Codes of all letter n-grams of ``text``, lower case: 18 bits a place, the boundary of a word is 1.

    Yields the n-grams that end in each span of SPAN characters, so memory doesn't
    depend on how long the text is; the last two places go on to the next span.
    """
    text = text.lower()
    line = np.full(1, _BOUNDARY, np.uint64)
    for a in range(0, len(text) + 1, SPAN):
        part = text[a : a + SPAN]
        points = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        # One boundary between words, one at either end.
        more = np.full(len(points) + (a + SPAN > len(text)), _BOUNDARY, np.uint64)
        more[: len(points)] = np.where(letters()[points], points & np.uint32(0x3FFFF), np.uint32(_BOUNDARY))
        before = len(line)
        line = np.concatenate([line, more])
        keep = np.ones(len(line), bool)
        keep[before:] = (line[before:] != _BOUNDARY) | (line[before - 1 : -1] != _BOUNDARY)
        line = line[keep]
        word = line != _BOUNDARY
        two = (line[:-1] << np.uint64(18)) | line[1:]
        three = (two[:-1] << np.uint64(18)) | line[2:]
        new_two, new_three = max(0, before - 1), max(0, before - 2)
        yield np.concatenate([line[before:][word[before:]], two[new_two:], three[new_three:][word[1:-1][new_three:]]])
        line = line[-2:]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of a text in ascending order, and how often each is there."""
    parts = []
    for codes in ngrams(text):
        parts.append(np.unique(codes, return_counts=True))
        if len(parts) == 8:
            parts = [_summed(parts)]
    return parts[0] if len(parts) == 1 else _summed(parts)


def ranked(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent of ascending codes, most frequent first, equal ones by code."""
    if len(codes) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")][:most]


class Profiles:
    """Profiles of all languages, ready for distances."""

    def __init__(self, ranks: dict[str, list[int]]):
        self.langs = sorted(ranks)
        self.codes = np.unique(np.array(sorted({c for r in ranks.values() for c in r}), np.uint64))
        #: Place of each known code in each profile, PROFILE * 2 where it lacks; the last row is for unknown codes.
        self.place = np.full((len(self.codes) + 1, len(self.langs)), 2 * PROFILE, np.int32)
        for j, lang in enumerate(self.langs):
            self.place[np.searchsorted(self.codes, np.array(ranks[lang], np.uint64)), j] = np.arange(len(ranks[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; the score is 1 for the profile's own order and 0 where the profile has none of the n-grams."""
        codes, counts = counted(text or "")
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        own = ranked(codes, counts)
        at = np.searchsorted(self.codes, own)
        at[at >= len(self.codes)] = len(self.codes) - 1
        at = np.where(self.codes[at] == own, at, len(self.codes))
        far = np.minimum(np.abs(self.place[at] - np.arange(len(own))[:, None]), PROFILE).sum(0)
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (PROFILE * len(own)))


def learn_profiles(training: DataFrame, per_lang: int = TRAIN_DOCS) -> Profiles:
    """Profiles of all languages in ``training`` (doc_id, text, lang).

    From a hash sample of expected ``per_lang`` documents of each language, whole
    texts; rows without lang are left out. Counts are summed per task before they
    are shuffled; what comes to the driver is one profile per language.
    """
    known = training.filter("lang is not null").select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = stage(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "of"), "op4-langs")
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("language")), F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = known.join(sizes, F.col("lang") == F.col("of")).filter(draw < F.lit(float(per_lang)) / F.col("n")).select("lang", "text")

    def count(batches):
        seen: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    parts = seen.setdefault(lang, [])
                    parts.append(counted(text))
                    if len(parts) >= 64:
                        parts[:] = [_summed(parts)]
        for lang, parts in seen.items():
            codes, counts = _summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "code", "n"])
        release()

    totals = sample.mapInArrow(count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = totals.withColumn("rank", rank).filter(F.col("rank") <= PROFILE)
    profiles = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("p")).collect()
    return Profiles({r.lang: [x.code for x in r.p] for r in profiles})


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(codes)).astype(np.int64)


def identify(docs: DataFrame, profiles: Profiles) -> Column:
    """A column ``struct<lang_pred, score>`` over the column text of ``docs``.

    Null texts and texts without letters give 'und' and 0. Very long texts count
    whole, in spans. Equal distances give the language first by code point. Without
    any profile all texts are 'und'. Repeated rows are identified each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(texts: pa.Array) -> pa.Array:
        out = [shared.value.predict(t) for a, b in slices(texts) for t in texts.slice(a, b - a).to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["lang_pred", "score"])

    return F.arrow_udf(predict, "struct<lang_pred string, score double>").asNondeterministic()(F.col("text").cast("string"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is never learned from: crc32(doc_id as text) mod 3 is 1; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learned(docs: DataFrame, per_lang: int = TRAIN_DOCS) -> Profiles:
    return learn_profiles(docs.filter(~held_out()), per_lang)


def keep_identified(docs: DataFrame, profiles: Profiles, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is determined with at least the score ``least``."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    found = packed.select("row", identify(packed, profiles).alias("f"))
    return found.filter((F.col("f.lang_pred") != UNDETERMINED) & (F.col("f.score") >= least)).select("row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", held_out().alias("held_out"), identify(docs, learned(docs)).alias("f")).select("doc_id", "held_out", "f.lang_pred", "f.score")


QUERIES = {"op4_language_id": op4_language_id}
ORACLE: dict[str, str] = {}
