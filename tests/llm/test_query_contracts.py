"""The registered queries on whole tables: against their SQL, or against plain versions of them."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from test_text_operators import plain_profile

from folioloom import llm
from folioloom.llm import chat_format, decontamination, language_id, mixing, token_files
from folioloom.llm.token_counts import vocabulary


def table(small, name):
    return pq.read_table(f"{small}/{name}.parquet").to_pylist()


def result(spark, small, name):
    frame = llm.QUERIES[name](spark, small)
    rows = [r.asDict() for r in frame.collect()]
    return frame.columns, rows


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_equals_sql(spark, duck, small, name):
    assert rows_of(llm.QUERIES[name](spark, small).toPandas()) == rows_of(duck.execute(llm.ORACLE[name]).df())


def test_windows_beyond_the_broadcast_equal_those_within(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "benchmark"))
    key = lambda f: sorted((r.row.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.clean) for r in f.collect())
    assert key(decontamination.decontaminate(docs, items)) == key(decontamination.decontaminate(docs, items, limit=0))


def test_token_files(spark, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    docs = sorted(table(small, "documents"), key=lambda r: r["doc_id"])
    want, start = [], 0
    for r, e in zip(docs, tokenizer.encode_batch([r["text"] or "" for r in docs], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        want.append({"doc_id": r["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())})
        start += len(ids)
    columns, rows = result(spark, small, "op3_token_files")
    assert columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and sorted(rows, key=lambda r: r["doc_id"]) == want


def test_language_id(spark, small):
    docs = table(small, "documents")
    held = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
    langs = sorted({r["lang"] for r in docs if r["lang"] and not held(r)})
    profiles = {k: plain_profile([r["text"] or "" for r in docs if r["lang"] == k and not held(r)], language_id.PROFILE) for k in langs}
    places = {k: {c: i for i, c in enumerate(p)} for k, p in profiles.items()}
    _, rows = result(spark, small, "op4_language_id")
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    for r in docs:
        own = plain_profile([r["text"] or ""], language_id.PROFILE)
        g = got[r["doc_id"]]
        assert g["held_out"] == held(r)
        if not own:
            assert (g["lang_pred"], g["score"]) == ("und", 0)
            continue
        far = {k: sum(min(abs(p[c] - i), 300) if c in p else 300 for i, c in enumerate(own)) for k, p in places.items()}
        best = min(langs, key=lambda k: (far[k], k))
        assert g["lang_pred"] == best and math.isclose(g["score"], 1 - far[best] / (300 * len(own)))
    known = [r for r in docs if held(r) and r["lang"]]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in known) >= 0.95 * len(known)


def test_quality(spark, small):
    docs, labels = table(small, "documents"), {r["doc_id"]: r["quality"] for r in table(small, "labels")}
    _, rows = result(spark, small, "op8_quality_cnn")
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    if good and bad:
        assert np.mean([[a > b for b in bad] for a in good]) > 0.9


def test_token_counts(spark, small):
    pieces = set(vocabulary(token_files.default_tokenizer())) | {bytes([b]) for b in range(256)}
    longest = max(map(len, pieces))

    def plain(word):
        left, n = b" " + word, 0
        while left:
            size = next(k for k in range(min(longest, len(left)), 0, -1) if left[:k] in pieces and (n == 0) == (left[:1] == b" "))
            left, n = left[size:], n + 1
        return n

    counts = Counter()
    want = []
    for r in table(small, "documents"):
        words = (r["text"] or "").encode().split()
        for w in set(words) - counts.keys():
            counts[w] = plain(w)
        want.append((r["doc_id"], len(words), sum(counts[w] for w in words)))
    _, rows = result(spark, small, "op9_token_counts")
    assert sorted(tuple(r.values()) for r in rows) == sorted(want)


def test_chat_format_round_trip(spark, small):
    """Every turn of every conversation comes back from the formatted pieces, whole and in order."""
    out = chat_format.format_conversations(spark.read.parquet(f"{small}/conversations.parquet")).collect()
    pieces = {}
    for r in sorted(out, key=lambda r: (r.span, r.piece)):
        pieces.setdefault(r.conv_id, []).extend(chat_format.turns_of(r.formatted))
    want = {}
    for r in sorted(table(small, "conversations"), key=lambda r: r["turn"]):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert pieces == want


@pytest.mark.parametrize("span", [1, 3])
def test_spans_of_turns_do_not_change_a_conversation(spark, small, monkeypatch, span):
    rows = [(1, t, "user" if t % 2 else "assistant", f"text {t}") for t in (*range(9), 7, 7)] + [(2, None, "user", "first"), (2, -5, "assistant", "second"), (None, 4, "user", "x"), (None, 90, "assistant", "y")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").unionByName(spark.read.parquet(f"{small}/conversations.parquet"))
    key = lambda f: sorted(repr(tuple(r)) for r in f.collect())
    whole = key(chat_format.read_back(chat_format.format_conversations(given)))
    monkeypatch.setattr(chat_format, "SPAN_TURNS", span)
    pieces = chat_format.format_conversations(given)
    assert key(chat_format.read_back(pieces)) == whole
    assert all(sum(r.formatted.startswith("<s>") for r in pieces.collect() if r.conv_id == c) == 1 for c in (1, 2, None))


def test_every_source_comes_near_its_target(spark):
    """Sources of 50 documents that differ by a factor of 20, as far as whole documents allow."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = [r.asDict() for r in mixing.mix_plan(docs).drop("row").collect()]
    for source in {r["source"] for r in plan}:
        own = [r for r in plan if r["source"] == source]
        taken, target = sum(r["size"] * r["copies"] for r in own), own[0]["target"]
        assert abs(taken - target) < 0.06 * target, source
        assert all(math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"]) <= 3 for r in own)
