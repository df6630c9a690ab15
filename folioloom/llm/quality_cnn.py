"""Quality classifier: a convolutional network over bytes, in numpy.

Learned filters slide over all bytes of a document. The document is cut into
overlapping chunks (each is two neighbouring blocks), every filter keeps its
greatest response in each chunk, and the mean and the greatest of those over all
chunks go into one logistic unit. A filter of width w is a table of w x 256
numbers, so its response at a byte is a sum of w looked-up values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, slices, stage, utf8_buffer

#: Filters, their width in bytes, and bytes of a block; a chunk is two blocks.
FILTERS, WIDTH, BLOCK = 12, 5, 256
#: The sample of labelled rows that is learned from: an expected number by hash, and of those as many, by hash, as have so many bytes of text in all.
TRAIN_DOCS, TRAIN_BYTES = 4000, 4 << 20
EPOCHS, BATCH, RATE, SEED = 14, 64, 0.01, 7
#: Blocks whose responses are computed together.
SPAN_BLOCKS = 1024
#: A score from here on counts as good.
THRESHOLD = 0.3


class ByteNet:
    """Weights: ``table`` (width, 256, filters), ``bias`` (filters), ``out`` (2 * filters) and ``offset``."""

    def __init__(self, filters: int = FILTERS, width: int = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        # Bytes start out alike within their kind, so that rare bytes respond as their kind does.
        kind = np.array([_kind(b) for b in range(256)])
        base = rng.normal(0, 0.3, (width, kind.max() + 1, filters))
        self.table = (base[:, kind] + rng.normal(0, 0.1, (width, 256, filters))).astype(np.float32)
        self.bias = np.zeros(filters, np.float32)
        self.out = rng.normal(0, 0.1, 2 * filters).astype(np.float32)
        self.offset = np.float32(0)

    def blocks(self, padded: np.ndarray, n: int, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The greatest response of each filter in each block of one text of ``n`` bytes, and where in the text it is if ``places``.

        ``padded`` is the text and, behind it, the zeros that its last positions look
        at; an empty text has one position. (blocks, filters), at least one block.
        Long texts go through in spans of whole blocks.
        """
        width, filters = self.table.shape[0], self.table.shape[2]
        most, at = [], []
        for a in range(0, n, SPAN_BLOCKS * BLOCK):
            m = min(n - a, SPAN_BLOCKS * BLOCK)
            k = -(-m // BLOCK)
            respond = np.full((k * BLOCK, filters), -np.inf, np.float32)
            own = respond[:m]
            self.table[0].take(padded[a : a + m], axis=0, out=own)
            for j in range(1, width):
                own += self.table[j].take(padded[a + j : a + j + m], axis=0)
            by_block = respond.reshape(k, BLOCK, filters)
            most.append(by_block.max(1))
            if places:
                at.append(by_block.argmax(1) + (a + BLOCK * np.arange(k))[:, None])
        return np.concatenate(most), np.concatenate(at) if places else None

    def features(self, blocks: np.ndarray) -> np.ndarray:
        """Chunks of two neighbouring blocks each; mean and greatest of the squashed responses."""
        chunks = np.maximum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks
        on = np.tanh(np.maximum(chunks + self.bias, 0))
        return np.concatenate([on.mean(0), on.max(0)])

    def padded(self, body: np.ndarray) -> tuple[np.ndarray, int]:
        out = np.zeros(max(len(body), 1) + self.table.shape[0] - 1, np.uint8)
        out[: len(body)] = body
        return out, max(len(body), 1)

    def score(self, body: np.ndarray) -> float:
        z = float(self.features(self.blocks(*self.padded(body))[0]) @ self.out + self.offset)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradient(self, padded: np.ndarray, n: int, label: float, weight: float) -> dict[str, np.ndarray]:
        """The gradient of the weighted logistic loss at one text."""
        filters, width = self.table.shape[2], self.table.shape[0]
        blocks, places = self.blocks(padded, n, places=True)
        k = len(blocks)
        left = np.arange(max(1, k - 1))
        right = np.minimum(left + 1, k - 1)
        chunk_block = np.where(blocks[left] >= blocks[right], left[:, None], right[:, None])
        lifted = np.take_along_axis(blocks, chunk_block, 0) + self.bias
        on = np.tanh(np.maximum(lifted, 0))
        best = on.argmax(0)
        feats = np.concatenate([on.mean(0), on[best, np.arange(filters)]])
        p = 1 / (1 + np.exp(-np.clip(feats @ self.out + self.offset, -30, 30)))
        dz = (p - label) * weight
        d_on = np.repeat((dz * self.out[:filters] / len(on))[None], len(on), 0)
        d_on[best, np.arange(filters)] += dz * self.out[filters:]
        d = d_on * (1 - on**2) * (lifted > 0)
        # Only the place of the greatest response of a chunk learns.
        at = np.take_along_axis(places, chunk_block, 0)
        rows, cols = np.nonzero(d)
        seen = padded[at[rows, cols][:, None] + np.arange(width)]
        cells = (np.arange(width) * 256 + seen) * filters + cols[:, None]
        table = np.bincount(cells.ravel(), np.repeat(d[rows, cols], width), width * 256 * filters).reshape(width, 256, filters)
        return {"table": table, "bias": d.sum(0), "out": dz * feats, "offset": dz}


def _kind(b: int) -> int:
    c = chr(b)
    return 0 if c.isspace() else 1 if b >= 128 else 2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit() else 5 if c in ".,;:'\"-()" else 6


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """A net from whole texts and labels 0 or 1; both classes weigh the same. No rows: the untrained net."""
    net, rng = ByteNet(seed=seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    if not len(y):
        return net
    share = max(y.mean(), 1e-3), max(1 - y.mean(), 1e-3)
    weight = np.where(y == 1, 0.5 / share[0], 0.5 / share[1]).astype(np.float32)
    params = ["table", "bias", "out", "offset"]
    first = {p: np.zeros_like(getattr(net, p)) for p in params}
    second = {p: np.zeros_like(getattr(net, p)) for p in params}
    bodies = [net.padded(np.frombuffer(t, np.uint8)) for t in texts]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bodies))
        rate = RATE * (1 - 0.8 * epoch / max(1, epochs))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH].tolist()
            grad = {p: 0.0 for p in params}
            for i in part:
                for p, g in net.gradient(*bodies[i], y[i], weight[i]).items():
                    grad[p] = grad[p] + g
            step += 1
            for p in params:
                g = grad[p] / len(part)
                first[p] = 0.9 * first[p] + 0.1 * g
                second[p] = 0.999 * second[p] + 0.001 * g * g
                value = getattr(net, p) - rate * (first[p] / (1 - 0.9**step)) / (np.sqrt(second[p] / (1 - 0.999**step)) + 1e-6)
                setattr(net, p, np.float32(value) if p == "offset" else value.astype(np.float32))
    return net


def learn(docs: DataFrame, labels: DataFrame, docs_at_most: int = TRAIN_DOCS, bytes_at_most: int = TRAIN_BYTES) -> ByteNet:
    """A net from whole texts of a hash sample of the labelled rows.

    The sample has an expected ``docs_at_most`` rows; of these, in the order of
    their hash, those are learned from whose texts have ``bytes_at_most`` bytes
    together, so what comes to the driver is bounded (a text that is longer than
    that alone is never in the sample). Rows of either table without doc_id, and
    labels without quality, are left out. Of repeated labels of a document the
    smallest counts; null texts are empty. The sample of labels is bounded, so it
    is broadcast to the scan of the documents.
    """
    usable = labels.filter("doc_id is not null and quality is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = usable.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("quality")), F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = stage(usable.filter(draw < docs_at_most / max(n, 1)).select(F.col("doc_id").cast("long").alias("of"), "quality", draw.alias("draw")), "op8-sample")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("of"), text.alias("text"))
    sizes = rows.join(F.broadcast(sample.select("of", "draw")), "of").groupBy("of", "draw").agg(F.sum(F.octet_length("text").cast("long")).alias("size")).collect()
    total, chosen = 0, []
    for r in sorted(sizes, key=lambda r: (r.draw, r.of)):
        if total + r.size <= bytes_at_most:
            total += r.size
            chosen.append((r.of,))
    few = docs.sparkSession.createDataFrame(chosen, "of long").join(sample.select("of", "quality"), "of")
    got = rows.join(F.broadcast(few), "of").toArrow().sort_by([("of", "ascending"), ("text", "ascending")])
    return fit([t.encode() for t in got["text"].to_pylist()], got["quality"].to_pylist())


def quality_score(docs: DataFrame, net: ByteNet) -> Column:
    """Column with the score of ``text``; null counts as empty, and an empty text has a score like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(texts: pa.Array) -> pa.Array:
        out = []
        for a, b in slices(texts):
            body, offsets = utf8_buffer(texts.slice(a, b - a))
            out += [shared.value.score(body[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return pa.array(out, pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()(F.col("text").cast("string"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is never learned from: crc32(doc_id as text) mod 5 is 0; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    net = learn(docs, labels.filter(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), quality_score(docs, net).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality_cnn": op8_quality_cnn}
ORACLE: dict[str, str] = {}
