"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so, each chunk gets a verified
identifier, and two texts are equal when their ordered identifier lists are.
Whole documents never move: the only text that is shuffled is each distinct
chunk of a task, once, to verify its identifier.

Identifier: ``xxhash64`` of the chunk. Chunks with the same hash but other bytes
(a few hundred are expected among 10^11 chunks) are found by grouping on
``(hash, chunk)``; only texts that hold such a hash take the exact path, in
which the hash is exchanged for the place of the chunk among its namesakes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, stage, text_or_empty

#: The cutter: least and most characters of a chunk, and the content that ends one. About one word gap in 40
#: is a cut, so that two texts with a common passage fall back into step soon after it begins.
CHUNK_MIN, CHUNK_MAX = 256, 8192
CUT = r"(?<=[dhs])[ \n](?=[aotwlg])"


def chunks_of(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX, cut: str = CUT) -> Column:
    """The chunks of ``text`` in order; joined they give the text again. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most - 1}}}?{cut}|.{{1,{most}}}"), F.lit(0))


def hash_of(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def exact_dedup(docs: DataFrame, hash_fn: Callable[[Column], Column] = hash_of, least: int = CHUNK_MIN, most: int = CHUNK_MAX, cut: str = CUT) -> DataFrame:
    """One row per row of ``docs``, with the class of its text.

    Returns doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Null text counts as empty, and all empty texts are one group. Of equal texts
    the row with the largest doc_id stays (a null doc_id is the smallest); of
    repeated rows with that doc_id exactly one is kept. Where all doc_ids of a
    group are null, keep_id is null and one row is kept. An empty table gives an
    empty result; other columns of ``docs`` are not read.
    """
    recipes, clashes = _recipes(docs, hash_fn, least, most, cut)
    if clashes is not None:
        recipes = stage(_verified(docs, recipes, clashes, hash_fn, least, most, cut), "op1-verified")
    order = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))
    groups = stage(
        recipes.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"), F.max_by("uid", order).alias("keep_uid")).filter("group_size > 1"),
        "op1-groups",
    )
    # A plain join of two scans: adaptive execution splits the recipe of a hot group.
    joined = recipes.join(groups, "recipe", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
        "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"),
    )


def _recipes(docs: DataFrame, hash_fn, least: int, most: int, cut: str) -> tuple[DataFrame, DataFrame | None]:
    """Staged (uid, doc_id, text_sha256, recipe), and the chunks whose hash stands for more than one content, if any."""
    text = text_or_empty()
    recipes = stage(
        docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), F.transform(chunks_of(text, least, most, cut), hash_fn).alias("recipe")),
        "op1-recipes",
    )
    contents = docs.select(F.explode(chunks_of(text, least, most, cut)).alias("chunk")).select(hash_fn(F.col("chunk")).alias("h"), "chunk").groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
    # Only hashes go on from here; the contents of a clash are fetched again if there is one.
    clashing = stage(contents.groupBy("h").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("h"), "op1-clashes")
    if clashing.isEmpty():
        return recipes, None
    return recipes, clashing


def _verified(docs: DataFrame, recipes: DataFrame, clashing: DataFrame, hash_fn, least: int, most: int, cut: str) -> DataFrame:
    """Recipes in which each clashing hash is followed by the rank of its chunk's content among those of that hash."""
    text = text_or_empty()  # its sha256 and doc_id only lead back to the row here; texts are compared by their recipes
    rows = docs.select(F.sha2(text, 256).alias("text_sha256"), F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(chunks_of(text, least, most, cut)).alias("pos", "chunk")).withColumn("h", hash_fn(F.col("chunk")))
    rows = rows.join(clashing, "h", "left_semi")
    # The place of a content among its namesakes: how many distinct ones are smaller; namesakes of one hash are few.
    names = rows.select("h", "chunk").distinct()
    order = names.alias("a").join(names.alias("b"), (F.col("a.h") == F.col("b.h")) & (F.col("b.chunk") < F.col("a.chunk")), "left").groupBy(F.col("a.h").alias("h"), F.col("a.chunk").alias("chunk")).agg(F.count("b.chunk").alias("place"))
    places = rows.join(order, ["h", "chunk"]).select("text_sha256", "doc_id", "pos", "place").distinct()
    per_text = places.groupBy("text_sha256", "doc_id").agg(F.array_sort(F.collect_set(F.struct("pos", "place"))).alias("places"))
    fixed = recipes.join(per_text, (recipes.text_sha256 == per_text.text_sha256) & recipes.doc_id.eqNullSafe(per_text.doc_id), "left").select(
        recipes.uid, recipes.doc_id, recipes.text_sha256, recipes.recipe, per_text.places
    )
    added = F.flatten(F.transform(F.coalesce("places", F.array()), lambda p: F.array(p["pos"].cast("long"), p["place"])))
    return fixed.select("uid", "doc_id", "text_sha256", F.concat("recipe", F.array(F.lit(-1).cast("long")), added).alias("recipe"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("n_chunks")


OP1_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM cut
"""

QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLE = {"op1_exact_dedup": OP1_SQL}
