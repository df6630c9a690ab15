"""Token counts by a linear longest-match automaton.

Greedy word pieces: from the start of a word take the longest piece of the
vocabulary, go on behind it with the longest continuation piece, and so on. The
automaton is a trie over bytes with failure links; each link carries the number
of pieces that are popped when it is followed, so the length of a word in pieces
is a sum over at most two steps per byte and no piece is ever built.

The vocabulary is a byte-level one: pieces that begin with the mark of a space
begin a word, all others continue one. Every single byte is a continuation, so
no word is unknown.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, resident, slices
from folioloom.llm.token_files import default_tokenizer

#: Most words whose length a worker keeps, and most bytes of one; when full it starts anew.
CACHE_WORDS, CACHE_WORD = 400_000, 48


def byte_of_mark() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file as bytes; added tokens are left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    marks, added = byte_of_mark(), {t["content"] for t in spec.get("added_tokens", [])}
    return [bytes(marks[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in added]


class PieceAutomaton:
    """``count(word)`` is the number of greedy longest-match pieces of a space and ``word``."""

    def __init__(self, pieces: list[bytes]):
        begins = [p for p in pieces if p[:1] == b" "]
        goes_on = [p for p in pieces if p[:1] != b" "]
        # Two tries in one table: node 0 begins a word, node 1 stands behind a piece.
        self.next: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        depth_order: list[list[tuple[int, int, int]]] = []

        def add(root: int, piece: bytes) -> None:
            node = root
            for depth, byte in enumerate(piece):
                child = self.next[node].get(byte)
                if child is None:
                    child = self.next[node][byte] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                    while len(depth_order) <= depth:
                        depth_order.append([])
                    depth_order[depth].append((node, byte, child))
                node = child
            ends[node] = True

        for p in begins:
            add(0, p)
        for p in goes_on:
            add(1, p)
        for byte in range(256):
            if byte != 0x20:
                add(1, bytes([byte]))
        add(0, b" ")
        add(1, b" ")
        # From a node: which node to go on in when no child fits, and how many pieces that step pops; -1 from the roots.
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        for level in depth_order:
            for parent, byte, node in level:
                if ends[node]:
                    self.fail[node], self.pops[node] = 1, 1
                    continue
                at, popped = self.fail[parent], self.pops[parent]
                while at >= 0 and byte not in self.next[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.pops[node] = self.next[at][byte], popped
        self.known: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        following, fail, pops = self.next, self.fail, self.pops
        node = following[0][0x20]
        n = 0
        for byte in word:
            child = following[node].get(byte)
            while child is None:
                n += pops[node]
                node = fail[node]
                child = following[node].get(byte)
            node = child
        while node != 1:
            n += pops[node]
            node = fail[node]
        return n

    def total(self, words: list[bytes]) -> int:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        distinct = set(words)
        long = {w for w in distinct if len(w) > CACHE_WORD}
        for w in distinct.difference(known) - long:
            known[w] = self.count(w)
        if not long:
            return sum(map(known.__getitem__, words))
        return sum(self.count(w) if w in long else known[w] for w in words)


def automaton(path: str) -> PieceAutomaton:
    return resident("automaton", path, lambda p: PieceAutomaton(vocabulary(p)))


def token_counts(docs: DataFrame, vocabulary_file: str | None = None) -> DataFrame:
    """doc_id, n_words and n_pieces of each row of ``docs``.

    Words are runs of anything but ASCII white space. Null and empty texts have
    0 words and 0 pieces; very long ones are counted whole. Repeated rows are counted each; other columns are not
    read; an empty table gives an empty result.
    """
    path = vocabulary_file or default_tokenizer()

    @F.arrow_udf("struct<n_words bigint, n_pieces bigint>")
    def counted(texts: pa.Array) -> pa.Array:
        auto, words, pieces = automaton(path), [], []
        data = texts.cast(pa.binary())
        for a, b in slices(texts):
            for t in data.slice(a, b - a).to_pylist():
                w = t.split() if t else []
                words.append(len(w))
                pieces.append(auto.total(w))
        return pa.StructArray.from_arrays([pa.array(np.array(words, np.int64)), pa.array(np.array(pieces, np.int64))], ["n_words", "n_pieces"])

    return docs.select("doc_id", counted(F.col("text").cast("string")).alias("c")).select("doc_id", "c.n_words", "c.n_pieces")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


QUERIES = {"op9_token_counts": op9_token_counts}
ORACLE: dict[str, str] = {}
