"""Search over vectors."""

import math

import __spark_entry__
from pyspark.sql import functions as F

from folioloom.operators import search


def test_every_twentieth_vector_is_answered(spark, small):
    ids = {r.vec_id for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id").collect()}
    got = __spark_entry__.queries()["vector_search"](spark, small).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {i: 5 for i in ids if i % 20 == 0}


def test_many_blocks_ties_and_no_direction(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 48)  # three vectors of two numbers
    rows = [(i, [math.cos(i % 7), math.sin(i % 7)]) for i in range(60)] + [(60, [0.0, 0.0]), (61, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in search.nearest(df, F.col("vec_id") % 20 == 0, 3).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.similarity))

    def want(i):
        cos = lambda j: round(math.cos(i % 7 - j % 7), 6)
        return sorted(sorted((j for j in range(60) if j != i), key=lambda j: (-cos(j), j))[:3])

    assert {i: sorted(j for j, _ in got[i]) for i in (0, 20, 40)} == {i: want(i) for i in (0, 20, 40)}
    assert sorted(got[60]) == [(0, None), (1, None), (2, None)]


def test_pairs_come_in_batches_of_few_bytes(spark, monkeypatch):
    run = search._best(2)
    seen = spark.sparkContext.accumulator(0)

    def watched(k):
        def count(batches):
            def each():
                for batch in batches:
                    if batch.nbytes > 200_000:
                        seen.add(1)
                    yield batch

            yield from run(each())

        return count

    monkeypatch.setattr(search, "BLOCK_BYTES", 16_000)
    monkeypatch.setattr(search, "BATCH_BYTES", 100_000, raising=False)
    monkeypatch.setattr(search, "_best", watched)
    df = spark.range(0, 4000, 1, 2).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * i) for i in range(1, 9)]).alias("embedding"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    assert search.nearest(df, F.col("vec_id") % 4 == 0, 2).count() == 2000
    assert seen.value == 0 and spark.conf.get(key) == before


def test_answers_hold_no_batch():
    import numpy as np
    import pyarrow as pa

    held, ids, e = [], np.arange(4), np.random.default_rng(1).random((4, 2))

    def batches():
        before = pa.total_allocated_bytes()
        for i in range(6):
            yield pa.RecordBatch.from_pydict({"q_block": [f"q{i}"], "q_ids": [ids.tobytes()], "q_e": [e.tobytes()], "ids": [ids.tobytes()], "e": [e.tobytes()], "pad": [bytes(1 << 20)]})
            held.append(pa.total_allocated_bytes() - before)

    assert sum(b.num_rows for b in search._best(3)(batches())) == 6 * 12
    assert max(held) < 3 << 20
