"""Benchmark decontamination: a broadcast hash set of the windows of all test items, held against every window of the corpus.

Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower
case. A window is 10 words in a row of an item; an item with fewer words, but
not none, is one window. Hits of the hash are verified word by word.

The set is a sorted array of 64-bit hashes with the place of each window among
the words of the benchmark, which are held once. Its size is known from a count
of those words before anything is collected; where it is above BROADCAST_BYTES,
the windows stay a table, a bitmap of fixed size over their hashes is broadcast
instead, and only the windows of the corpus that it lets through are joined.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import ALNUM, Words, bitmap, in_bitmap, read_table, slices, stage, utf8_buffer

#: Words of a window.
WINDOW = 10
#: Most bytes of a window set that is broadcast, as ``packed_bytes`` counts them.
BROADCAST_BYTES = 64 << 20
FOUND = "struct<n_words bigint, n_hit bigint, items array<string>, clean string>"
GRAMS = pa.list_(pa.struct([("at", pa.int64()), ("len", pa.int32()), ("h", pa.int64()), ("gram", pa.string())]))
GRAMS_TYPE = "array<struct<at bigint, len int, h bigint, gram string>>"


def packed_bytes(words: int, text: int, items: int) -> int:
    """Most bytes of a WindowSet of so many words in so many bytes of text: hash, place, begin of each word, filter bits; the words; the ids."""
    return words * (8 + 8 + 8 + 8) + text + 64 * items + (1 << 16)


class WindowSet:
    """Windows by length and hash, each with the places where items have it."""

    def __init__(self, ids: list[str | None], texts: pa.Array, k: int = WINDOW):
        self.ids = ids
        firsts, begins, blobs, rows = [0], [], [], defaultdict(list)
        at = size = 0
        for a, b in slices(texts):
            words = Words(*utf8_buffer(texts.slice(a, b - a)), ALNUM)
            lengths = (words.end - words.begin).astype(np.int64)
            begins.append(size + np.cumsum(lengths + 1) - lengths - 1)
            blob = np.full(int((lengths + 1).sum()), 32, np.uint8)
            inside = np.arange(int(lengths.sum()))
            blob[inside + np.repeat(np.arange(len(lengths)), lengths)] = words.body[inside + np.repeat(words.begin - np.cumsum(lengths) + lengths, lengths)]
            blobs.append(blob.tobytes())
            size += len(blob)
            counts = np.diff(words.first)
            for n, h in words.window_hashes({min(int(c), k) for c in counts.tolist() if c}):
                whole = np.flatnonzero(words.whole(n)[: len(h)])
                if n < k:
                    whole = whole[np.repeat(counts, counts)[whole] == n]
                rows[n].append((h[whole], at + whole))
            firsts += (at + words.first[1:]).tolist()
            at += len(lengths)
        #: Words of item i are first[i] to first[i + 1]; word w is text[begin[w] : begin[w + 1] - 1], lower case.
        self.first, self.text = np.array(firsts), b"".join(blobs)
        self.begin = np.concatenate([*begins, [size]]).astype(np.int64)
        #: Length -> sorted hashes, the first word of each window, whether all windows of that hash are the same words, filter bits.
        self.by: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, parts in rows.items():
            h, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            h, place = h[order], place[order]
            if len(h):
                self.by[n] = h, place, self._apart(n, h, place), self._bits(h)

    def window(self, place: int, n: int) -> bytes:
        return self.text[self.begin[place] : self.begin[place + n] - 1]

    def _apart(self, n: int, h: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Hashes that stand for several windows of different words, sorted: next to none."""
        same = np.flatnonzero(h[1:] == h[:-1])
        return np.unique(h[[i for i in same.tolist() if self.window(int(place[i]), n) != self.window(int(place[i + 1]), n)]])

    @staticmethod
    def _bits(h: np.ndarray) -> np.ndarray:
        """A bit per hash, many times as many bits as hashes: nearly all windows of the corpus end here."""
        size = 1 << max(16, (len(h) * 32 - 1).bit_length())
        bits = np.zeros(size // 8, np.uint8)
        low = h & np.uint64(size - 1)
        np.bitwise_or.at(bits, low >> np.uint64(3), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
        return bits

    def hits(self, words: Words):
        """(first word, length, ids of items) of each window of the texts that is one of an item."""
        for k, h in words.window_hashes(self.by):
            hashes, place, apart, bits = self.by[k]
            maybe = np.flatnonzero(bits[(h >> np.uint64(3)) & np.uint64(len(bits) - 1)] >> (h & np.uint64(7)).astype(np.uint8) & 1)
            if not len(maybe):
                continue
            maybe = maybe[words.whole(k)[maybe]]
            x = h[maybe]
            lo, hi = np.searchsorted(hashes, x, side="left"), np.searchsorted(hashes, x, side="right")
            there = np.flatnonzero(lo < hi)
            for i, a, b, one in zip(maybe[there].tolist(), lo[there].tolist(), hi[there].tolist(), (~np.isin(x[there], apart)).tolist(), strict=True):
                own = words.text(i, k)
                if one:
                    # All of them are the same words, so the first one is as good as any.
                    at = place[a:b] if self.window(int(place[a]), k) == own else ()
                else:
                    at = [p for p in place[a:b].tolist() if self.window(p, k) == own]
                if len(at):
                    yield i, k, [self.ids[j] for j in (np.searchsorted(self.first, at, side="right") - 1).tolist()]

    def scan(self, texts: pa.Array, clean: bool) -> pa.Array:
        n_words, n_hit, items, cleaned = [], [], [], []
        for a, b in slices(texts):
            part = texts.slice(a, b - a)
            body, offsets = utf8_buffer(part)
            words = Words(body, offsets, ALNUM)
            first, total = words.first, len(words.hash)
            hit = np.zeros(total + 1, np.int32)
            of: dict[int, set[str]] = defaultdict(set)
            for i, k, ids in self.hits(words):
                hit[i] += 1
                hit[i + k] -= 1
                of[int(np.searchsorted(first, i, side="right")) - 1].update(x for x in ids if x is not None)
            is_hit = np.cumsum(hit[:-1]) > 0
            hits = np.concatenate([[0], np.cumsum(is_hit)])
            n_words += np.diff(first).tolist()
            n_hit += (hits[first[1:]] - hits[first[:-1]]).tolist()
            items += [sorted(of[d]) if d in of else [] for d in range(b - a)]
            if clean:
                raw = part.to_pylist()
                for d in np.flatnonzero(hits[first[1:]] > hits[first[:-1]]).tolist():
                    raw[d] = self._without(body, offsets, words, is_hit, d)
                cleaned += raw
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(cleaned, pa.string()) if clean else pa.nulls(len(n_words), pa.string())],
            ["n_words", "n_hit", "items", "clean"],
        )

    @staticmethod
    def _without(body, offsets, words, is_hit, d: int) -> str:
        """Text d without its runs of hit words; a line break stands in for each, so that nothing new is joined."""
        out, at = [], int(offsets[d])
        i, stop = int(words.first[d]), int(words.first[d + 1])
        while i < stop:
            if not is_hit[i]:
                i += 1
                continue
            j = i
            while j < stop and is_hit[j]:
                j += 1
            out.append(body[at : words.begin[i]].tobytes())
            at = int(words.end[j - 1])
            i = j
        out.append(body[at : offsets[d + 1]].tobytes())
        return b"\n".join(out).decode("utf-8", "replace")


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW, limit: int = BROADCAST_BYTES, clean: bool = True) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with n_words, n_hit, items (sorted ids of the items found) and clean.

    ``clean`` is the text without the words that are in a hit window (null for all
    rows where it isn't asked for). Null and empty texts have no words and no hits,
    and a null text stays null. Very long texts are scanned whole, in spans. Items
    without words have no windows. Repeated items count once; the windows of an
    item without an id hit, but the item isn't named. Columns of ``docs`` stay
    inside ``row``, whatever their names. Empty tables on either side give no hits.

    The window set is broadcast only if it has at most ``limit`` bytes by the words
    that the benchmark holds; beyond that, windows are joined with a shuffle.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if packed_size(items) > limit:
        return _joined(packed, items, k, clean)
    held = items.toArrow().combine_chunks()
    texts = held.column("text").combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(held.column("item").to_pylist(), texts, k))
    # Not deterministic for the optimizer: a filter on the result must not run the scan a second time.
    scan = F.arrow_udf(lambda t: shared.value.scan(t, clean), FOUND).asNondeterministic()
    return packed.select("row", scan("text").alias("f")).select("row", "f.*")


def packed_size(items: DataFrame) -> int:
    """Bytes of the window set of ``items`` (item, text), from their counted words."""
    count = F.arrow_udf(lambda t: pa.array([n for a, b in slices(t) for n in np.diff(Words(*utf8_buffer(t.slice(a, b - a)), ALNUM).first).tolist()], pa.int64()), "bigint")
    words, text, rows = items.agg(F.sum(count("text")), F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    return packed_bytes(words or 0, text or 0, rows)


def _joined(packed: DataFrame, items: DataFrame, k: int, clean: bool) -> DataFrame:
    """The same by a join on the windows themselves, for a benchmark of any size.

    The bitmap lets all windows of items through and few others, so what is
    shuffled of the corpus is about its hits; a bitmap that is full costs time and
    no rows. Both sides of the join are staged scans: adaptive execution splits a
    window that very many documents have.
    """
    rows = stage(packed.withColumn("uid", F.monotonically_increasing_id()), "op2-rows")
    own = items.select("item", F.explode(F.arrow_udf(lambda t: _item_grams(t, k), GRAMS_TYPE)("text")).alias("g")).select("item", "g.gram", "g.len", "g.h")
    own = stage(own.distinct(), "op2-windows")
    lengths = sorted(r[0] for r in own.select("len").distinct().collect())  # at most k of them
    maybe = bitmap(own, F.col("h"))
    seen = rows.select("uid", F.explode(F.arrow_udf(lambda t: _grams(t, lengths, maybe.value), GRAMS_TYPE)("text")).alias("g")).select("uid", "g.at", "g.len", "g.gram")
    seen = stage(seen, "op2-seen")
    # A window is joined to its own distinct words first; the items of a window that many have come after, once a document.
    hits = stage(seen.join(own.select("gram").distinct(), "gram", "left_semi"), "op2-hits")
    places = hits.select("uid", F.explode(F.sequence("at", F.col("at") + F.col("len") - 1)).alias("w")).distinct().groupBy("uid").agg(F.count(F.lit(1)).alias("n_hit"), F.array_sort(F.collect_list("w")).alias("places"))
    named = hits.select("uid", "gram").distinct().join(own.filter("item is not null").select("gram", "item"), "gram").select("uid", "item").distinct().groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    joined = rows.join(places, "uid", "left").join(named, "uid", "left")
    cut = F.arrow_udf(_cut_places, "struct<n_words bigint, clean string>").asNondeterministic()("text", "places")
    return joined.select("row", "n_hit", "items", cut.alias("c")).select(
        "row", "c.n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (F.col("c.clean") if clean else F.lit(None).cast("string")).alias("clean")
    )


def _item_grams(texts: pa.Array, k: int) -> pa.Array:
    """The windows of each item."""
    out = []
    for t in texts.to_pylist():
        words = Words(*utf8_buffer(pa.array([t or ""], pa.string())), ALNUM)
        n = min(len(words.hash), k)
        out.append([{"at": i, "len": n, "h": x, "gram": words.text(i, n).decode()} for _, h in words.window_hashes({n} - {0}) for i, x in enumerate(h.view(np.int64).tolist())])
    return pa.array(out, GRAMS)


def _grams(texts: pa.Array, lengths: list[int], table: np.ndarray) -> pa.Array:
    """The windows of each text, of all ``lengths``, that the bitmap lets through."""
    out = []
    for a, b in slices(texts):
        words = Words(*utf8_buffer(texts.slice(a, b - a)), ALNUM)
        own: list[list[dict]] = [[] for _ in range(b - a)]
        for k, h in words.window_hashes(lengths):
            maybe = np.flatnonzero(in_bitmap(table, h.view(np.int64)) & words.whole(k))
            docs = np.searchsorted(words.first, maybe, side="right") - 1
            for i, d, x in zip(maybe.tolist(), docs.tolist(), h[maybe].view(np.int64).tolist(), strict=True):
                own[d].append({"at": i - int(words.first[d]), "len": k, "h": x, "gram": words.text(i, k).decode()})
        out += own
    return pa.array(out, GRAMS)


def _cut_places(texts: pa.Array, places: pa.Array) -> pa.Array:
    n_words, cleaned = [], []
    for t, at in zip(texts.to_pylist(), places.to_pylist(), strict=True):
        body, offsets = utf8_buffer(pa.array([t or ""], pa.string()))
        words = Words(body, offsets, ALNUM)
        n_words.append(len(words.hash))
        if at:
            is_hit = np.zeros(len(words.hash), bool)
            is_hit[at] = True
            t = WindowSet._without(body, offsets, words, is_hit, 0)
        cleaned.append(t)
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(cleaned, pa.string())], ["n_words", "clean"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, unchanged."""
    return decontaminate(docs, benchmark, k, clean=False).filter("n_hit = 0").select("row.*")


def clean_spans(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW) -> DataFrame:
    """All rows of ``docs``, their texts without the words of benchmark windows."""
    return decontaminate(docs, benchmark, k).withColumn("row", F.col("row").withField("text", F.col("clean"))).select("row.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = decontaminate(docs.select("doc_id", "text"), benchmark, clean=False)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {OP2_WORDS} AS w FROM benchmark),
bw AS (SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, k, array_to_string(w[i + 1 : i + k], ' ') AS gram FROM bw),
d AS (SELECT row_number() OVER () AS rid, doc_id, {OP2_WORDS} AS w FROM documents),
dg AS (SELECT rid, k, list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1 : i + k], ' ')) AS grams FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k),
dw AS (SELECT rid, k, unnest(grams) AS gram, unnest(range(len(grams))) AS i FROM dg),
hit AS (SELECT rid, dw.k, i, item FROM dw JOIN g USING (gram)),
words AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS at FROM hit) GROUP BY rid),
items AS (SELECT rid, count(item) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

QUERIES = {"op2_decontamination": op2_decontamination}
ORACLE = {"op2_decontamination": OP2_SQL}
