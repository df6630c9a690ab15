"""Mixing sources to target weights, in DataFrame functions only.

Words are summed per source (with partial sums, so that a hot source sends one
row per task) and turned into repetition rates. Each document is emitted
floor(rate) times, and once more where the hash of (seed, doc_id) lies below the
cut of its source. A cut at the fraction itself would be a plain Bernoulli draw,
which scatters: with 50 documents a source by a third of its target. So the cut is
put where the words below it, in the order of the hash, come to the fraction of
the source's words. Documents go by tiers of their share of the source, the
largest first, each tier with a cut of its own that makes up for what the tiers
before it missed. In the first tier the document at the cut is drawn with the
probability that keeps the expected words exact, in the others the cut is the
nearest, so a source ends within half a document of its smallest tier.

Everything is a pure function of the seed and the table, so reruns and lost tasks
agree, and no text moves: the cuts are found on (source, hash, size) alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, stage, text_or_empty

#: Fixed values of the production mix: weights that sources get in turn, times that a source may be repeated, seed.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Tiers: a document with more than 1 / 16 of its source's words is in the first, with more than 1 / 256 in the second, else in the last.
TIERS = (16, 256)
#: Bits of the hash of a document, and of its first part, by which the words of a source are summed before any are sorted.
HASH_BITS, FIRST_BITS = 48, 12
#: Spelled without braces or backslash classes: a run of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def ranked(rows: DataFrame, order: Column, name: str) -> DataFrame:
    """``rows`` with their place in a global order, from 0: sorted within range partitions and numbered from where each begins, so no task holds all rows."""
    placed = stage(rows.repartitionByRange(order).withColumn("part", F.spark_partition_id()), name)
    held = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    begins = held.select(F.col("part").alias("of"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    own = placed.withColumn("own", F.row_number().over(W.partitionBy("part").orderBy(order)))
    return own.join(F.broadcast(begins), F.col("part") == F.col("of")).withColumn("rank", F.col("before") + F.col("own") - 1).drop("part", "of", "before", "own")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows with source and size; one row per source, null is one.

    Sources by code point, null last, get the weights in turn. The total of all
    sizes is shared by weight; where a share is above ``most`` times the source's
    size it stops there and the excess is shared again among the others. Each round
    of that is one sum over the sources, until none is above. All sources empty:
    all targets 0. An empty table has no sources.
    """
    per = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), F.col("source").asc_nulls_last(), "op6-sources")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    per = per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    total, all_weight = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    stopped, level = (0, 0), 0.0
    while all_weight > stopped[1]:
        level = float(total - stopped[0]) / float(all_weight - stopped[1])
        above = per.filter(F.col("cap").cast("double") < F.lit(level) * F.col("weight")).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if tuple(above) == stopped:
            break
        stopped = tuple(above)
    return per.select("source", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def hash_of(key: Column) -> Column:
    """HASH_BITS bits of the md5 of a text as a number."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def doc_hash(doc_id: Column, seed: str) -> Column:
    """The hash by which a document is drawn; a null doc_id draws as the text 'null'."""
    return hash_of(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def words_of_text() -> Column:
    return F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")


def tier() -> Column:
    first, second = (F.col("size") * n > F.col("source_size") for n in TIERS)
    return F.when(first, 0).when(second, 1).otherwise(2)


def source_cuts(sized: DataFrame, targets: DataFrame, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``targets`` with rate and the cuts of the tiers: a document gets one copy more where its hash is below the cut of its tier."""
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size").cast("double"))).otherwise(F.lit(0.0))
    cuts = targets.withColumn("rate", rate).withColumn("frac", F.col("rate") - F.floor("rate")).withColumn("due", F.lit(0.0))
    drawn = cuts.filter("frac > 0").select(F.col("source").alias("of"), "source_size")
    docs = sized.filter("size > 0").join(drawn, F.col("source").eqNullSafe(F.col("of"))).select("source", "h", "size", tier().alias("tier"))
    # One pass: of the first tiers a source has fewer than 256 rows; of the last one the words are summed by the first part of the hash, before the rows of one such part are sorted.
    first = F.shiftright("h", HASH_BITS - FIRST_BITS)
    held = stage(docs.groupBy("source", "tier", F.when(F.col("tier") < len(TIERS), F.col("h")).otherwise(first).alias("h")).agg(F.sum("size").alias("s")), "op6-sums")
    for n in range(len(TIERS)):
        cuts = _cut(cuts, held.filter(F.col("tier") == n).select("source", "h", "s", F.lit(0).cast("long").alias("base")), n, seed)
    last = docs.filter(F.col("tier") == len(TIERS))
    of_source = W.partitionBy("source")
    sums = held.filter(F.col("tier") == len(TIERS)).select("source", F.col("h").alias("b"), "s").withColumn("through", F.sum("s").over(of_source.orderBy("b"))).withColumn("all", F.sum("s").over(of_source))
    want = cuts.select(F.col("source").alias("of"), "frac", "due")
    sums = sums.join(want, F.col("source").eqNullSafe(F.col("of"))).withColumn("wanted", F.col("due") + F.col("frac") * F.col("all").cast("double")).filter("wanted > 0")
    crossed = sums.filter(F.col("through").cast("double") >= F.col("wanted")).groupBy("of").agg(F.min("b").alias("cross"), (F.min_by("through", "b") - F.min_by("s", "b")).alias("base"), F.first("wanted").alias("wanted"))
    near = last.withColumn("b", first).join(crossed, F.col("source").eqNullSafe(F.col("of")) & (F.col("b") == F.col("cross")))
    edge = _nearest(near.groupBy("source", "h").agg(F.sum("size").alias("s"), F.first("base").alias("base"), F.first("wanted").alias("wanted")))
    # Where more is due than the last tier has, all of it is taken.
    none, end = F.lit(0).cast("long"), F.lit(1 << HASH_BITS).cast("long")
    all_taken = sums.filter("through = all and through < wanted").groupBy("of").agg(end.alias("whole"))
    out = cuts.join(edge.select(F.col("source").alias("edge_of"), "cut"), F.col("source").eqNullSafe(F.col("edge_of")), "left").join(all_taken, F.col("source").eqNullSafe(F.col("of")), "left")
    return out.select("source", "source_size", "target", "rate", "cut_0", "cut_1", F.coalesce("cut", "whole", none).alias("cut_2"))


def _nearest(rows: DataFrame) -> DataFrame:
    """(source, cut, taken) from (source, h, s, base, wanted): the cut whose words, beyond ``base``, are nearest to ``wanted``; the lower one of two."""
    c = (F.col("base") + F.sum("s").over(W.partitionBy("source").orderBy("h"))).cast("double")
    past = rows.withColumn("c", c).filter("c >= wanted").groupBy("source").agg(F.min("h").alias("h"), F.min_by("c", "h").alias("c"), F.min_by("s", "h").cast("double").alias("s"), F.first("wanted").alias("wanted"))
    over = F.col("c") - F.col("wanted") < F.col("wanted") - (F.col("c") - F.col("s"))
    return past.select("source", (F.col("h") + over.cast("long")).alias("cut"), F.when(over, F.col("c")).otherwise(F.col("c") - F.col("s")).alias("taken"))


def _cut(cuts: DataFrame, rows: DataFrame, n: int, seed: str) -> DataFrame:
    """``cuts`` with the cut of tier ``n``, and in ``due`` the words that the tiers so far have missed."""
    of_source = W.partitionBy("source")
    want = cuts.select(F.col("source").alias("of"), "frac", "due")
    rows = rows.join(want, F.col("source").eqNullSafe(F.col("of"))).withColumn("all", F.sum("s").over(of_source).cast("double")).withColumn("wanted", F.col("due") + F.col("frac") * F.col("all"))
    per = rows.groupBy(F.col("source").alias("of")).agg(F.first("all").alias("all"), F.first("wanted").alias("wanted"))
    if n == 0:
        draw = hash_of(F.concat_ws(":", F.lit(seed), F.lit("source"), F.col("source"))).cast("double") / F.lit(float(1 << HASH_BITS))
        s, c = F.col("s").cast("double"), F.sum("s").over(of_source.orderBy("h")).cast("double")
        marked = rows.withColumn("c", c).withColumn("t", (F.col("c") <= F.col("wanted")) | ((F.col("c") - s < F.col("wanted")) & (draw < (F.col("wanted") - (F.col("c") - s)) / s)))
        found = marked.filter("t").groupBy("source").agg((F.max("h") + 1).alias("cut"), F.sum("s").cast("double").alias("taken"))
    else:
        found = _nearest(rows.filter("wanted > 0").select("source", "h", "s", "base", "wanted"))
    per = per.join(found, F.col("of").eqNullSafe(F.col("source")), "left").drop("source")
    whole = F.lit(1 << HASH_BITS).cast("long")
    taken_all = F.col("cut").isNull() & (F.col("wanted") > F.col("all"))
    per = per.select("of", F.when(taken_all, whole).otherwise(F.coalesce("cut", F.lit(0).cast("long"))).alias(f"cut_{n}"), (F.col("wanted") - F.when(taken_all, F.col("all")).otherwise(F.coalesce("taken", F.lit(0.0)))).alias("left_over"))
    out = cuts.join(per, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    return stage(out.withColumn("due", F.coalesce("left_over", "due")).withColumn(f"cut_{n}", F.coalesce(f"cut_{n}", F.lit(0).cast("long"))).drop("left_over"), f"op6-cuts-{n}")


def sized_rows(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Staged (id, source, size, h) of each row of ``docs``: all that the plan is made from."""
    return stage(docs.select(F.col("doc_id").alias("id"), F.col("source").cast("string").alias("source"), words_of_text().alias("size"), doc_hash(F.col("doc_id"), seed).alias("h")), "op6-sizes")


def plan_of(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Staged (source, source_size, target, rate, cut_0, cut_1, cut_2), one row per source."""
    return stage(source_cuts(sized, stage(source_targets(sized, weights, most), "op6-targets"), most, seed), "op6-cuts")


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Each row of ``docs`` as struct ``row`` with source, size, source_size, target, rate and copies (0 to ``most``).

    Null and empty texts have size 0; very long ones are counted whole. Rows with
    the same doc_id and size draw alike. A source without words has target 0 and
    rate 0. Columns of ``docs`` with the names used here can't clash, as they stay
    inside ``row``. An empty table gives an empty plan.
    """
    plan = plan_of(sized_rows(docs, seed), weights, most, seed)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"), words_of_text().alias("size"), doc_hash(F.col("doc_id"), seed).alias("h"))
    return with_copies(packed, plan)


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    # One row per source; Spark broadcasts the plan where its size on disk is below its threshold, and shuffles otherwise.
    joined = rows.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    cut = F.when(tier() == 0, F.col("cut_0")).when(tier() == 1, F.col("cut_1")).otherwise(F.col("cut_2"))
    return joined.withColumn("copies", F.floor("rate") + (F.col("h") < cut).cast("long")).drop("h", "cut_0", "cut_1", "cut_2")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    plan = mix_plan(docs, weights, most, seed).filter("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sized_rows(read_table(spark, sf_dir, "documents"))
    return with_copies(sized, plan_of(sized)).select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  ('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT AS h FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS BIGINT) AS weight, source_size * 3 AS cap FROM per),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM weighed WINDOW b AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight), 0.0) AS target FROM leveled),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM targets),
r AS (SELECT d.*, t.source_size, t.target, t.rate, t.rate - floor(t.rate) AS frac, CASE WHEN d.size * {TIERS[0]} > t.source_size THEN 0 WHEN d.size * {TIERS[1]} > t.source_size THEN 1 ELSE 2 END AS tier
  FROM d JOIN rated t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT coalesce('s' || source, '') AS k, tier, h, any_value(source) AS source, any_value(frac) AS frac, CAST(sum(size) AS BIGINT) AS s FROM r WHERE size > 0 AND frac > 0 GROUP BY coalesce('s' || source, ''), tier, h),
run AS (SELECT *, (sum(s) OVER (PARTITION BY k, tier ORDER BY h))::DOUBLE AS c, (sum(s) OVER (PARTITION BY k, tier))::DOUBLE AS al FROM g),
w0 AS (SELECT *, 0.0::DOUBLE + frac * al AS wanted FROM run WHERE tier = 0),
t0 AS (SELECT k, coalesce(max(CASE WHEN t THEN h + 1 END), 0) AS cut, any_value(wanted) - coalesce(sum(CASE WHEN t THEN s END), 0)::DOUBLE AS due FROM (
  SELECT *, c <= wanted OR (c - s::DOUBLE < wanted AND ('0x' || substr(md5(concat_ws(':', '{SEED}', 'source', source)), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE < (wanted - (c - s::DOUBLE)) / s::DOUBLE) AS t FROM w0) GROUP BY k),
w1 AS (SELECT run.*, coalesce(due, 0.0::DOUBLE) + frac * al AS wanted FROM run LEFT JOIN t0 USING (k) WHERE tier = 1),
e1 AS (SELECT k, min(h) AS h, min_by(c, h) AS c, min_by(s, h)::DOUBLE AS s FROM w1 WHERE wanted > 0 AND c >= wanted GROUP BY k),
t1 AS (SELECT k, CASE WHEN h IS NOT NULL THEN h + CASE WHEN c - wanted < wanted - (c - s) THEN 1 ELSE 0 END WHEN wanted > al THEN 281474976710656 ELSE 0 END AS cut,
  wanted - CASE WHEN h IS NOT NULL THEN CASE WHEN c - wanted < wanted - (c - s) THEN c ELSE c - s END WHEN wanted > al THEN al ELSE 0.0::DOUBLE END AS due
  FROM (SELECT k, any_value(wanted) AS wanted, any_value(al) AS al FROM w1 GROUP BY k) LEFT JOIN e1 USING (k)),
w2 AS (SELECT run.*, coalesce(t1.due, t0.due, 0.0::DOUBLE) + frac * al AS wanted FROM run LEFT JOIN t0 USING (k) LEFT JOIN t1 USING (k) WHERE tier = 2),
e2 AS (SELECT k, min(h) AS h, min_by(c, h) AS c, min_by(s, h)::DOUBLE AS s FROM w2 WHERE wanted > 0 AND c >= wanted GROUP BY k),
t2 AS (SELECT k, CASE WHEN h IS NOT NULL THEN h + CASE WHEN c - wanted < wanted - (c - s) THEN 1 ELSE 0 END WHEN wanted > al THEN 281474976710656 ELSE 0 END AS cut
  FROM (SELECT k, any_value(wanted) AS wanted, any_value(al) AS al FROM w2 GROUP BY k) LEFT JOIN e2 USING (k)),
cut AS (SELECT k, 0 AS tier, cut FROM t0 UNION ALL SELECT k, 1, cut FROM t1 UNION ALL SELECT k, 2, cut FROM t2)
SELECT r.doc_id, r.size, r.source_size, r.target, CAST(r.size * (floor(r.rate) + CASE WHEN r.h < coalesce(cut.cut, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r LEFT JOIN cut ON coalesce('s' || r.source, '') = cut.k AND r.tier = cut.tier
"""

QUERIES = {"op6_mix_sources": op6_mix_sources}
ORACLE = {"op6_mix_sources": OP6_SQL}
