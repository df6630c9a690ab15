"""Token ids in Parquet files: encode, write, read back.

File format: one row per document in ascending doc_id order with the columns
``part`` (number of the range partition that wrote the file), ``doc_id``,
``offset`` (ids before the document within its part), ``n_tokens`` and
``tokens`` (list of int32). Ids are dictionary encoded with delta encoding where
a chunk outgrows the dictionary, row groups and pages have a set size, and the
writer adds column and offset indexes, so that a read of a few documents or of
the metadata columns touches only their pages.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import byte_class, read_table, resident, slices, small_batches, stage, stage_path, utf8_buffer

#: Fixed values of the file format.
END_ID = 2
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "PARQUET_2_0",
}
#: Pieces of text whose ids a worker keeps before it begins a new set, of so many bytes at most; of the last set those stay that are met again.
CACHE_PIECES, CACHE_PIECE = 120_000, 48
#: Bytes of text of a range partition, from which and the input the number of partitions follows; beyond so many partitions, they grow to PART_MOST first.
PART_BYTES, PART_MOST, MANY_PARTS = 32 << 20, 1 << 30, 20_000
#: Bytes of text that are encoded together.
SLICE = 1 << 20
FILE_SCHEMA = "part int, doc_id bigint, offset bigint, n_tokens bigint, tokens array<int>"

#: Bytes that may be white space, for a tokenizer or for Python.
_SPACE = byte_class({9, 10, 11, 12, 13, 28, 29, 30, 31, 32})
_MARK = byte_class(set(b".,;:!?*&$%#|)"))
_ALNUM = byte_class({*range(48, 58), *range(65, 91), *range(97, 123)})


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Encodes with the tokenizers library, each distinct piece of text once.

    The byte-level pre-tokenizer always ends a token before a space or a line
    break that follows something else than white space, and before a mark that
    follows a letter or digit, and what it does from there on doesn't depend on
    what stands before. So texts are cut at those
    places, equal pieces of a batch are brought together by Arrow, and only pieces
    that the worker hasn't seen yet are encoded. Texts that hold the string of an
    added token are encoded whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuttable = self.tokenizer.normalizer is None and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and not getattr(self.tokenizer.pre_tokenizer, "add_prefix_space", True)
        self.width = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        for piece, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(piece)  # a character of a byte-level piece stands for a byte
        #: Kept pieces, how many ids each has, these ids in a row, and whether a piece is of the newest set.
        self.pieces = pa.array([], pa.large_binary())
        self.counts, self.ids, self.newest = np.zeros(0, np.int64), np.zeros(0, "<u4"), np.zeros(0, bool)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end_id`` behind each, and how many each has. Null counts as empty."""
        whole = np.full(len(texts), not self.cuttable)
        for t in self.added if self.cuttable else ():
            whole |= np.asarray(pa.compute.fill_null(pa.compute.match_substring(texts, t), False))
        if whole.any():
            parts = [np.array(e.ids + [end_id], "<u4") for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        body, offsets = utf8_buffer(texts)
        begins = self._cuts(body, offsets)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(body)).astype(np.int64)), pa.py_buffer(body)]).dictionary_encode()
        known, table, lengths = self._look_up(pieces.dictionary)
        # The end id is one piece more, behind the last piece of each text.
        table, lengths = np.append(table, np.uint32(end_id)), np.append(lengths, 1)
        starts = np.cumsum(lengths) - lengths
        last = np.searchsorted(begins, offsets[1:])
        which = np.insert(known[np.asarray(pieces.indices)], last, len(lengths) - 1)
        n = lengths[which]
        ends = np.cumsum(n)
        place = np.repeat((starts[which] - ends + n).astype(np.int32), n)
        place += np.arange(ends[-1], dtype=np.int32)
        return table.take(place), np.diff(ends[last + np.arange(len(last))], prepend=0)

    @staticmethod
    def _cuts(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin: at each text that isn't empty, at spaces and line breaks behind anything but white space, and at marks behind ASCII letters and digits."""
        marks = np.flatnonzero(_MARK[body[1:]] & _ALNUM[body[:-1]]) + 1
        at = np.flatnonzero((body == 32) | (body == 10))
        at = at[at > 2]
        out = np.sort(np.concatenate([at[~_behind_space(body, at)], marks, offsets[:-1][np.diff(offsets) > 0]]))
        return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out

    def _look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct pieces: the place of each in a table of pieces, the ids of that table in a row, and how many each has."""
        if np.count_nonzero(self.newest) > CACHE_PIECES:
            self.pieces, self.ids = self.pieces.filter(pa.array(self.newest)), self.ids[np.repeat(self.newest, self.counts)]
            self.counts = self.counts[self.newest]
            self.newest = np.zeros(len(self.counts), bool)
        # The pieces of this batch are hashed, and the kept ones looked up among them.
        found = pa.compute.index_in(self.pieces, value_set=pieces)
        kept = np.flatnonzero(np.asarray(found.is_valid()))
        place = np.full(len(pieces), -1, np.int64)
        place[np.asarray(found.drop_null())] = kept
        self.newest[kept] = True
        missing = np.flatnonzero(place < 0)
        if not len(missing):
            return place, self.ids, self.counts
        row, new, ids, counts = self._learn(pieces.take(pa.array(missing)))
        place[np.concatenate([missing[row], missing[~row]])] = len(self.counts) + np.arange(len(missing))
        table, lengths = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        short = np.asarray(pa.compute.binary_length(new)) <= CACHE_PIECE
        self.pieces = pa.concat_arrays([self.pieces, new.filter(pa.array(short))])
        self.ids, self.counts = np.concatenate([self.ids, ids[np.repeat(short, counts)]]), np.concatenate([self.counts, counts[short]])
        self.newest = np.concatenate([self.newest, short[short]])
        return place, table, lengths

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Encode distinct pieces: which of them stood in a row, those and then the others, the ids of all, and how many each has."""
        body, offsets = _bytes(pieces)
        first = body[offsets[:-1]]
        # Pieces that begin with white space and end without may stand in a row; the widths of the ids tell where each ends.
        row = ((first == 32) | (first == 10)) & ~_behind_space(body, offsets[1:])
        stood, others = pieces.filter(pa.array(row)), pieces.filter(pa.array(~row))
        parts, counts = [], []
        body, offsets = _bytes(stood)
        for at in range(0, len(stood), 4_000):
            ends = offsets[at : at + 4_001]
            ids = np.array(self.tokenizer.encode_batch_fast([body[ends[0] : ends[-1]].tobytes().decode()], add_special_tokens=False)[0].ids, "<u4")
            parts.append(ids)
            counts.append(np.diff(1 + np.searchsorted(np.cumsum(self.width[ids]), ends[1:] - ends[0]), prepend=0))
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in others.to_pylist()], add_special_tokens=False)]
        parts += [np.array(x, "<u4") for x in alone]
        counts.append(np.array(list(map(len, alone)), np.int64))
        return row, pa.concat_arrays([stood, others]), np.concatenate(parts), np.concatenate(counts)


def _bytes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of pieces in a row, and the offsets of each."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, 8 * pieces.offset) if len(pieces) else np.zeros(1, np.int64)
    data = pieces.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]], offsets - offsets[0]


def _behind_space(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space lies before each place of UTF-8 bytes."""
    a, b, c = body[at - 1], body[np.maximum(at - 2, 0)], body[np.maximum(at - 3, 0)]
    # White space beyond ASCII: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
    after = _SPACE[a] | ((b == 0xC2) & ((a == 0x85) | (a == 0xA0)))
    after |= (c == 0xE2) & (b == 0x80) & (((a >= 0x80) & (a <= 0x8A)) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))
    after |= ((c == 0xE2) & (b == 0x81) & (a == 0x9F)) | ((b == 0x80) & (a == 0x80) & (c == 0xE3)) | ((c == 0xE1) & (b == 0x9A) & (a == 0x80))
    return after


def encoder(path: str) -> PieceEncoder:
    return resident("encoder", path, PieceEncoder)


def write_token_files(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write the token files of ``docs`` (doc_id, text) to ``out``.

    Null text is encoded as empty and gives the end id alone. Rows are in
    ascending doc_id order, null first; rows with equal doc_id are in the order
    of their texts. Other columns are not read. An empty table gives a folder
    with the schema and no rows. Texts, not ids, are shuffled: they are the
    smaller of the two.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    crc = F.crc32(F.col("text").cast("binary"))
    if partitions is None:
        held = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        partitions = max(docs.sparkSession.sparkContext.defaultParallelism, min(-(-held // PART_BYTES), max(MANY_PARTS, -(-held // PART_MOST))))

    def encode(batches):
        enc, before = encoder(path), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids_of, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, SLICE):
                ids, counts = enc.encode(texts.slice(a, b - a), end_id)
                ends = np.cumsum(counts)
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, part, np.int32)), ids_of.slice(a, b - a), pa.array(before + ends - counts), pa.array(counts), tokens], ["part", "doc_id", "offset", "n_tokens", "tokens"])
                before += int(ends[-1])

    # The crc in the key lets repeated doc_ids lie in several partitions.
    with small_batches(docs.sparkSession):
        rows.repartitionByRange(partitions, F.col("doc_id"), crc).sortWithinPartitions("doc_id", crc, "text").mapInArrow(encode, FILE_SCHEMA).write.options(**FILE_OPTIONS).parquet(out)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of the files below ``path``; start counts the ids of all documents before.

    The place where a part begins is a running sum over one row per part, from
    the metadata columns alone; it has as many rows as the files.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    begins = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("begin"))
    return files.join(F.broadcast(begins), "part").select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "tokens")


@F.arrow_udf(T.LongType())
def ids_crc32(tokens: pa.Array) -> pa.Array:
    """Unsigned crc32 of each list of ids as little-endian unsigned 32-bit integers."""
    resident("crc32", "", lambda _: None)  # what encoding has kept in this worker may go
    offsets = np.asarray(tokens.offsets)
    flat = memoryview(np.ascontiguousarray(tokens.values, "<i4")).cast("B")
    return pa.array([zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.int64())


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files below ``path``, staged: ids go to Python in small batches."""
    return stage(read_token_files(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("tokens").alias("ids_crc32")), "token-digests")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stage_path(spark, "op3-tokens")
    write_token_files(read_table(spark, sf_dir, "documents"), out)
    return token_digests(spark, out)


QUERIES = {"op3_token_files": op3_token_files}
ORACLE: dict[str, str] = {}
