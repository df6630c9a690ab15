"""Exact dedup and source mixing against plain versions."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioloom.llm.exact_dedup import chunks_of, exact_dedup
from folioloom.llm.mixing import mix_plan, mix_sources, source_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, recipe int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "clash", 1) for i, t, s in rows], DOCS)


LONG = "".join(f"word{i % 977} hands of{i} as well\n" for i in range(20_000))
CASES = [(5, "a", "x"), (9, "a", "x"), (9, "a", "x"), (2, None, "y"), (3, "", None), (None, "a", "x"), (7, LONG, "x"), (8, LONG, "z"), (6, LONG + " ", "z"), (1, "A", "x"), (None, "only", "x"), (None, "only", "y"), (11, "x" * 30_000, "y"), (12, "x" * 30_001, "y")]


def check_exact(rows, got):
    by = defaultdict(list)
    for i, t, _ in rows:
        by[t or ""].append(i)
    assert len(got) == len(rows)
    for text, ids in by.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        most = max((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in mine} == {most} and {r.group_size for r in mine} == {len(ids)} and len(mine) == len(ids)
        assert [r.doc_id for r in mine if r.kept] == [most]


def test_exact_dedup(spark):
    check_exact(CASES, exact_dedup(docs(spark, CASES)).collect())


@pytest.mark.parametrize("weak", [lambda c: F.length(c).cast("long"), lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(2)).cast("long")])
def test_equal_hashes_of_other_chunks_are_told_apart(spark, weak):
    rows = CASES + [(20, "b", "x"), (21, "c", "x"), (22, "c", "x"), (23, LONG.replace("977", "978", 1), "x"), (24, LONG.replace("word5 ", "wordX ", 1), "q")]
    check_exact(rows, exact_dedup(docs(spark, rows), hash_fn=weak).collect())


def test_chunks_join_to_the_text_and_fall_into_step(spark):
    texts = [LONG, "y" + LONG, "", "é" * 9000, "\n" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(chunks_of(F.col("t")).alias("c")).collect()
    assert ["".join(r.c) for r in got] == texts
    assert got[0].c[5:] == got[1].c[5:] and len(got[0].c) > 100


def test_empty_table(spark):
    assert exact_dedup(docs(spark, [])).collect() == [] and mix_sources(docs(spark, [])).collect() == [] and mix_plan(docs(spark, [])).collect() == []


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cap, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        share = left / total
        for s in free:
            target[s] += share * weight[s]
        left = 0.0
        for s in list(free):
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1, None: 50}, {"a": 1, "b": 1000, "c": 0, "d": 3, "e": 5, "é": 7}, {"a": 10}, {"a": 0, "b": 0}, {f"s{i}": (i * 37) % 11 for i in range(40)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_mix(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 4}" if i % 9 else None) for i in range(2000)] + [(7, "dup dup", "s1")] * 3 + [(None, "n", "s2"), (5000, None, "s3")]
    plan = mix_plan(docs(spark, rows)).collect()
    assert len(plan) == len(rows) and all(0 <= r.copies <= 3 for r in plan)
    near = defaultdict(lambda: [0, 0.0])
    for r in plan:
        near[r.source][0] += len((r.row.text or "").split()) * r.copies
        near[r.source][1] = r.target
        assert r.copies in (int(r.rate), int(r.rate) + 1)
    assert all(abs(a - b) <= 0.2 * b for a, b in near.values())
    key = lambda r: (r.doc_id or -1, r.text or "")
    a, b = (sorted(map(key, mix_sources(docs(spark, rows).repartition(n)).collect())) for n in (1, 3))
    assert a == b and len(a) == sum(r.copies for r in plan)
    assert mix_sources(docs(spark, rows)).columns == docs(spark, rows).columns
