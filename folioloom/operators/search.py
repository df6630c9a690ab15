"""Exact search over vectors: the most similar rows of a table for each of many asked rows.

Both sides are packed into blocks of bounded bytes; each pair of blocks is one
matrix product. A task keeps the best of each asked row over all its pairs, so
pairs of vectors are never rows of a table. Pairs go to Python in batches of a
few blocks, which are read where they lie.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of a block's vectors.
BLOCK_BYTES = 256 << 10
#: Bytes of a batch of pairs; a worker holds two.
BATCH_BYTES = 4 << 20
#: Decimals to which similarities are compared; equal ones go by vec_id.
TIES = 9


def _pack(batches):
    """Batches of (vec_id, e) as blocks: a name, the ids in order, the numbers one after the other."""
    for batch in batches:
        e = pa.array(batch.column("e"))
        lengths = {n for n in e.value_lengths().to_pylist() if n}
        if len(lengths) > 1:
            raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
        d = lengths.pop() if lengths else 0
        whole = np.zeros((len(e), d))
        there = np.array([bool(n) for n in e.value_lengths().to_pylist()], bool)
        if d:
            whole[there] = e.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        step = max(1, BLOCK_BYTES // (8 * max(1, d)))
        for a in range(0, len(ids), step):
            order = a + np.argsort(ids[a : a + step], kind="stable")
            yield pa.RecordBatch.from_pydict({"block": [uuid.uuid4().hex], "ids": [ids[order].astype(np.int64).tobytes()], "e": [whole[order].tobytes()]})


def _blocks(vectors: DataFrame, prefix: str) -> DataFrame:
    packed = vectors.filter("vec_id is not null").mapInArrow(_pack, "block string, ids binary, e binary")
    return packed.select(*[F.col(c).alias(prefix + c) for c in packed.columns])


def _first(k: int, row: np.ndarray, s: np.ndarray, vec_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of each row, by similarity to TIES decimals and then by vec_id."""
    order = np.lexsort((vec_id, -np.round(s, TIES), row))
    row, s, vec_id = row[order], s[order], vec_id[order]
    begins = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - begins < k
    return row[keep], s[keep], vec_id[keep]


def _similar(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of all pairs; -inf where one has no direction."""
    if q.shape[1] != v.shape[1]:
        if q.any() and v.any():
            raise ValueError(f"vectors of different lengths: {sorted((q.shape[1], v.shape[1]))}")
        return np.full((len(q), len(v)), -np.inf)
    with np.errstate(all="ignore"):
        s = (q @ v.T) / np.sqrt(np.outer((q * q).sum(1), (v * v).sum(1)))
    return np.where(np.isfinite(s), s, -np.inf)


def _numbers(value: pa.Scalar, kind) -> np.ndarray:
    """The numbers of a binary value, without a copy."""
    return np.frombuffer(value.as_buffer(), kind)


def _best(k: int):
    def run(batches):
        asked, kept = {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                q_block, q_ids, q_e, ids, e = (batch.column(name)[i] for name in ("q_block", "q_ids", "q_e", "ids", "e"))
                q_block, q_ids, ids = q_block.as_py(), _numbers(q_ids, np.int64), _numbers(ids, np.int64)
                s = _similar(_numbers(q_e, float).reshape(len(q_ids), -1), _numbers(e, float).reshape(len(ids), -1))
                other = q_ids[:, None] != ids[None]
                near = np.where(other, np.round(s, TIES), -np.inf)
                least = np.partition(near, len(ids) - min(k, len(ids)), axis=1)[:, len(ids) - min(k, len(ids))]
                row, col = np.nonzero((near >= least[:, None]) & other)
                found = row, s[row, col], ids[col]
                if q_block in kept:
                    found = tuple(np.concatenate(pair) for pair in zip(kept[q_block], found, strict=True))
                else:
                    asked[q_block] = q_ids.copy()  # a view would keep its whole batch
                kept[q_block] = _first(k, *found)
        for name, (row, s, vec_id) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(asked[name][row]), pa.array(vec_id), pa.array(s, mask=np.isneginf(s))], ["query_id", "vec_id", "s"])

    return run


@contextmanager
def _small_batches(spark: SparkSession):
    """Within it, jobs send batches of at most about BATCH_BYTES to Python workers, or what the session asks for if that is less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if not (before and 0 < int(re.sub(r"\D", "", before) or 0) <= BATCH_BYTES):
        spark.conf.set(key, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _staged(found: DataFrame) -> DataFrame:
    """``found`` in ``spark.checkpoint.dir``, made with small batches; without such a folder it is left as it is, with batches of the session's size."""
    spark = found.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return found
    path = f"{shared.rstrip('/')}/folioloom/nearest-{uuid.uuid4().hex}"
    with _small_batches(spark):
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def nearest(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """(query_id, vec_id, similarity): the ``k`` rows of ``vectors`` (vec_id, embedding) of the greatest cosine to each row that ``asked`` holds for.

    All rows but those with the same vec_id compete. Vectors without a direction
    (null, empty, all zero) come last, with no similarity. Rows without vec_id
    are left out. The similarity isn't rounded.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    pairs = _blocks(rows, "").crossJoin(_blocks(rows.filter(asked), "q_"))
    found = _staged(pairs.mapInArrow(_best(k), "query_id long, vec_id long, s double"))
    # k rows of an asked row and task at most; the window is limited before its shuffle.
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc_nulls_last(F.round("s", TIES)), "vec_id"))
    return found.withColumn("n", best).filter(F.col("n") <= k).select("query_id", "vec_id", F.col("s").alias("similarity"))
