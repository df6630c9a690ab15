"""What the corpus operators share: staged tables, row identity, Arrow buffers.

Staged tables are written below ``spark.checkpoint.dir``, which every executor
and the driver share; a lost executor therefore loses nothing that is staged.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local master, whose executors
    are this process; on a cluster it is an error, as executors share no such folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="folioloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class _Made(threading.local):
    """Paths of the staged tables of a thread, in the order of their making: runs in other threads don't see them."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def stage_path(spark: SparkSession, name: str) -> str:
    _made.paths.append(f"{shared_dir(spark)}/folioloom/{name}-{uuid.uuid4().hex}")
    return _made.paths[-1]


def staged_since(mark: int = 0) -> list[str]:
    """Paths of tables staged after the first ``mark`` ones."""
    return _made.paths[mark:]


def read_roots(df: DataFrame) -> list[str]:
    """The folders that ``df`` reads files from, as its plan names them; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            roots = leaf.relation().location().rootPaths()
            found += [roots.apply(j).toString() for j in range(roots.size())]
    return found


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_staged(docs: DataFrame, paths: list[str]) -> list[str]:
    """Delete staged tables of steps whose results have been written, but for those that ``docs`` reads; these are returned."""
    read = {root.rpartition("/")[2] for root in read_roots(docs)}
    kept = [path for path in paths if path.rpartition("/")[2] in read]
    drop_paths(docs.sparkSession, [path for path in paths if path not in kept])
    return kept


#: Bytes of a batch that goes to a Python worker, unless the session asks for less: buffers of two batches a task lie outside the heap.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Within it, jobs send batches of at most about BATCH_BYTES to Python workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if before is not None and 0 < int(re.sub(r"\D", "", before) or 0) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(key, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage, fixes row ids, and gives later joins a plain scan, so that
    adaptive execution can split a skewed side of them.
    """
    path = stage_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string array as one byte array, and the offsets of each; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    data = array.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


#: What a worker keeps between tasks for the operator it last ran: kind -> key -> table.
_resident: dict[str, dict] = {}


def resident(kind: str, key: str, make: Callable[[str], Any]) -> Any:
    """``make(key)``, kept for later tasks of this worker; what another kind of operator has kept goes first."""
    if kind not in _resident:
        _resident.clear()
        release()
        _resident[kind] = {}
    held = _resident[kind]
    if key not in held:
        held[key] = make(key)
    return held[key]


def release() -> None:
    """Give freed memory back to the system; a worker is kept for later tasks, and what it holds counts against its executor.

    Arrow's own pools keep what is freed, so from the first call on a worker
    allocates with the C library, which gives back what it is asked to.
    """
    if pa.default_memory_pool().backend_name != "system":
        pa.default_memory_pool().release_unused()
        pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library has no such call


def slices(array: pa.Array, limit: int = 1 << 20):
    """Parts of a string array of about ``limit`` bytes each, at least one text, so that the work arrays of one part stay small."""
    if not len(array):
        return
    release()
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(array), 0), dtype=np.int64)
    begin, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    yield begin, len(array)
    release()


#: Odd multiplier of the polynomial over bytes and its inverse modulo 2**64, and the step of the window polynomial.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes that are hashed together. Words that cross the end of a span are put together from their parts.
SPAN = 1 << 19
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, n at most SPAN + 1; kept."""
    if base not in _powers:
        out = np.full(SPAN + 1, base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_class(spec: set[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[sorted(spec)] = True
    return table


#: A-Z to a-z, all else unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of words: anything but ASCII white space; and digits, letters, anything beyond ASCII.
SPACED = byte_class(set(range(256)) - {9, 10, 11, 12, 13, 32})
ALNUM = byte_class({*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)})


class Words:
    """The words of the texts of one buffer: where each begins and ends, its hash, and the words of each text.

    Works through spans of SPAN bytes, so beside the result (some 20 bytes a word)
    and three bytes a byte of text, memory doesn't depend on how long a text is.
    """

    def __init__(self, body: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        self.body = LOWER[body]
        n = len(body)
        is_word = inside[body]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        begins[edges] |= is_word[edges]
        kind = np.int32 if n < 2**31 - 1 else np.int64
        self.begin = np.flatnonzero(begins).astype(kind)
        stops = begins  # the array is used again
        stops[:] = is_word
        stops[:-1] &= ~is_word[1:]
        stops[edges - 1] |= is_word[edges - 1]
        self.end = np.flatnonzero(stops).astype(kind) + kind(1)
        #: Words of text i: first[i] to first[i + 1].
        self.first = np.searchsorted(self.begin, offsets)
        self.hash = self._hashes(n)

    def _hashes(self, n: int) -> np.ndarray:
        out = np.zeros(len(self.begin), np.uint64)
        powers, inverse = _power(_BASE, SPAN + 1), _power(_INVERSE, SPAN + 1)
        sums = np.zeros(SPAN + 1, np.uint64)
        for a in range(0, n, SPAN):
            b = min(a + SPAN, n)
            lo, hi = np.searchsorted(self.end, a, side="right"), np.searchsorted(self.begin, b, side="left")
            if lo == hi:
                continue
            part = sums[: b - a + 1]
            np.cumsum((self.body[a:b].astype(np.uint64) + np.uint64(1)) * powers[: b - a], out=part[1:])
            begin, end = np.maximum(self.begin[lo:hi], a), np.minimum(self.end[lo:hi], b)
            value = (part[end - a] - part[begin - a]) * inverse[begin - a]
            if self.begin[lo] < a:
                # Its bytes before this span are in the hash already; these come behind them.
                value[:1] *= np.array([pow(_BASE, int(a - self.begin[lo]), 2**64)], np.uint64)
            out[lo:hi] += value
        return mixed(out)

    def window_hashes(self, lengths):
        """(k, hashes) for each of ``lengths`` in ascending order: the hash of each k words in a row, whether or not they are of one text."""
        lengths, held = set(lengths), None
        for k in range(1, max(lengths, default=0) + 1):
            n = len(self.hash) - k + 1
            if n <= 0:
                held = np.zeros(0, np.uint64)
            elif k == 1:
                held = self.hash.copy()
            else:
                held = held[:n]
                held *= _STEP
                held += self.hash[k - 1 :]
            if k in lengths:
                yield k, mixed(held + np.uint64(k))

    def windows(self, k: int) -> np.ndarray:
        """The hash of each k words in a row; ``len(hash) - k + 1`` of them."""
        return next(h for _, h in self.window_hashes({k}))

    def whole(self, k: int) -> np.ndarray:
        """Whether the window that begins at each place lies in one text."""
        counts = np.diff(self.first)
        last = np.repeat(self.first[1:], counts)
        n = max(0, len(self.hash) - k + 1)
        return np.arange(n) + k <= last[:n]

    def text(self, i: int, k: int) -> bytes:
        """Words i to i + k, lower case, joined by single spaces."""
        return b" ".join(self.body[b:e].tobytes() for b, e in zip(self.begin[i : i + k].tolist(), self.end[i : i + k].tolist(), strict=True))


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long); nodes of one component have one root, which is one of them.

    Each round every node goes to the neighbour of least hash, and the edges with
    it; the number of nodes falls by a factor each round whatever the ids are. All
    tables between rounds are staged, so joins are between plain scans.
    """
    rank = lambda c: F.xxhash64(F.col(c))
    edges = stage(edges.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), name)
    roots = None
    while True:
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).union(edges.select("v", "u"))
        near = both.groupBy("a").agg(F.min_by("b", rank("b")).alias("b"))
        step = stage(near.select("a", F.when(rank("b") < rank("a"), F.col("b")).otherwise(F.col("a")).alias("m")), name)
        if roots is None:
            roots = step.select(F.col("a").alias("node"), F.col("m").alias("root"))
        else:
            roots = stage(roots.join(step, F.col("root") == F.col("a"), "left").select("node", F.coalesce("m", "root").alias("root")), name)
        moved = edges.join(step, F.col("u") == F.col("a")).select(F.col("m").alias("x"), "v").join(step, F.col("v") == F.col("a")).select("x", F.col("m").alias("y"))
        edges = stage(moved.filter("x != y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), name)
        if edges.isEmpty():
            return roots


#: Most bits of a membership bitmap; it is a filter before an exact join, so a full one costs time and no rows.
BITMAP_BITS = 1 << 28
_ROW_BITS = 15


def bit_table(members: DataFrame, hashes: Column, bits: int) -> np.ndarray:
    """One bit for each of the 64-bit ``hashes`` of ``members``, at its remainder by ``bits``, a power of two of at least 2 ** 15."""
    place = members.select(hashes.bitwiseAND(F.lit(bits - 1).cast("long")).alias("h"))
    held = place.groupBy(F.shiftright("h", _ROW_BITS).alias("row")).agg(F.bitmap_construct_agg(F.col("h").bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("long"))).alias("map")).collect()
    table, width = np.zeros(bits // 8, np.uint8), (1 << _ROW_BITS) // 8
    for r in held:
        table[int(r.row) * width : (int(r.row) + 1) * width] = np.frombuffer(bytes(r.map), np.uint8)
    return table


def bitmap(members: DataFrame, hashes: Column) -> Broadcast:
    """A broadcast table of bits, one set for each of the 64-bit ``hashes`` of ``members``; at most BITMAP_BITS / 8 bytes."""
    bits = 1 << min(BITMAP_BITS.bit_length() - 1, max(20, (16 * members.count()).bit_length()))
    return members.sparkSession.sparkContext.broadcast(bit_table(members, hashes, bits))


def in_bitmap(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes & (8 * len(table) - 1)
    return (table[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)


def within_bitmap(members: DataFrame, column: str, over: Column) -> Column:
    """Whether ``over`` may be among the values of ``members``; false only if it isn't."""
    shared = bitmap(members, F.xxhash64(F.col(column)))
    test = F.arrow_udf(lambda hashes: pa.array(in_bitmap(shared.value, np.asarray(hashes))), "boolean")
    return test.asNondeterministic()(F.xxhash64(over))
