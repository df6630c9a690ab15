"""Decontamination, near dedup, language, quality and licenses against plain versions."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import folioloom.llm.near_dedup as near
from folioloom.llm import common, decontamination, language_id, license_scan, quality_cnn

DOCS = "doc_id long, text string, lang string, source string, n_hit long, row string, uid string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7, "clash", "u") for i, t in rows], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB9 .é\t\n_日-"), max_size=15), max_size=6))
def test_words_of_a_buffer(texts):
    for inside, pattern in ((common.SPACED, r"[^\x20\x09-\x0D]+"), (common.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = common.Words(*common.utf8_buffer(pa.array(texts, pa.string())), inside)
        want = [re.findall(pattern, lower(t)) for t in texts]
        assert [[w.text(j, 1).decode() for j in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])] == want
        flat = [x for t in want for x in t]
        assert len(set(zip(flat, w.hash.tolist()))) == len(set(flat)) == len(set(w.hash.tolist()))


def test_components(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 2), (7, 7)] + [(300, x) for x in range(301, 340)]
    got = common.connected_components(spark.createDataFrame(pairs, "u long, v long"), "test-components").collect()
    by = defaultdict(set)
    for r in got:
        by[r.root].add(r.node)
    assert sorted(map(sorted, by.values())) == [[2, 5, 9], list(range(100, 161)), list(range(300, 340))]
    assert common.connected_components(spark.createDataFrame([], "u long, v long"), "test-none").collect() == []


def test_bitmap_has_no_false_negatives(spark):
    members = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    held = spark.range(5000).select("id", common.within_bitmap(members, "k", F.col("id")).alias("maybe")).collect()
    assert all(r.maybe for r in held if r.id % 7 == 0) and sum(r.maybe for r in held) < 1000


# -- decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(text, items, k=10):
    windows = defaultdict(set)
    for item, t in items:
        w = WORDS.findall(lower(t))
        for i in range(max(0, len(w) - k) + 1 if w else 0):
            windows[tuple(w[i : i + min(k, len(w))])].add(item)
    w, hit, found = WORDS.findall(lower(text)), set(), set()
    for n in {len(x) for x in windows}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found |= windows[tuple(w[i : i + n])]
    return len(w), len(hit), sorted(x for x in found if x is not None)


ITEM = "One two THREE four five six seven eight nine ten eleven twelve"
BENCH = [("1", ITEM), ("2", "short item"), ("10", "short item"), ("3", None), ("4", "..."), ("2", "short item"), (None, "no id here")]
TEXTS = [(1, "x one two three four five six seven eight nine ten y"), (2, ITEM.replace(" ", " - ")), (3, "one two three four five six seven eight nine TEN"), (4, "a short, ITEM b short item"), (5, None), (6, ""), (7, "no id here"), (8, "shortitem short"), (9, ("z " * 40_000) + ITEM), (9, "tie short item"), (None, "short item"), (11, "one two three four five six seven eight nine"), (12, "één twö " + ITEM.upper())]


@pytest.mark.parametrize("limit", [1 << 20, 3])
def test_decontamination(spark, limit):
    bench = spark.createDataFrame(BENCH, "item_id string, text string")
    got = decontamination.decontaminate(docs(spark, TEXTS), bench, limit=limit).collect()
    assert sorted((r.row.doc_id or 0, r.n_words, r.n_hit, list(r.items)) for r in got) == sorted((i or 0, *plain_hits(t, BENCH)) for i, t in TEXTS)
    clean = {(r.row.doc_id, r.row.text): r.clean for r in got}
    assert clean[5, None] is None and clean[6, ""] == "" and clean[8, "shortitem short"] == "shortitem short"
    assert all(plain_hits(c, BENCH)[1] == 0 for c in clean.values())
    assert clean[1, TEXTS[0][1]] == "x \n y"


def test_clean_documents_and_spans(spark):
    bench = spark.createDataFrame(BENCH, "item_id string, text string")
    kept = decontamination.clean_documents(docs(spark, TEXTS), bench)
    assert kept.columns == docs(spark, []).columns and sorted(r.doc_id for r in kept.collect()) == [5, 6, 8, 11]
    spans = decontamination.clean_spans(docs(spark, TEXTS), bench)
    assert spans.count() == len(TEXTS) and spans.columns == docs(spark, []).columns
    assert decontamination.decontaminate(docs(spark, []), bench).collect() == []
    nothing = decontamination.decontaminate(docs(spark, TEXTS), spark.createDataFrame([], "item_id string, text string"))
    assert {r.n_hit for r in nothing.collect()} == {0}


# -- near dedup


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain_components(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, math.inf), math.inf if d is None else d)
    return [(d, len(s), low[find(i)] if low[find(i)] < math.inf else None) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def family(seed, n, words=120, edits=8):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 5000, words)]
    out = []
    for _ in range(n):
        own = list(base)
        for p in rng.integers(0, words, rng.integers(0, edits)):
            own[p] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(own))
    return out


NEAR = [(i + 1, t) for i, t in enumerate(family(1, 60) + family(2, 9, 30, 3) + family(3, 3, 2000, 90))] + [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "One  two"), (505, "one two three"), (506, "one"), (507, "x"), (None, "one two"), (None, "nothing like it at all"), (503, "one two"), (0, family(1, 1)[0])]


@pytest.mark.parametrize("blocks", [(512, 96), (8, 5)])
@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, monkeypatch, blocks, size, percent):
    monkeypatch.setattr(near, "LIST_BLOCK", blocks[0])
    monkeypatch.setattr(near, "CLUSTER_BLOCK", blocks[1])
    got = near.near_duplicates(docs(spark, NEAR), size, percent).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(plain_components(NEAR, size, percent), key=key)
    groups = defaultdict(int)
    for r in got:
        groups[(r.component_id, r.doc_id if r.n_shingles == 0 else None)] += r.stays
    assert all(n == 1 for n in groups.values())


def test_drop_near_duplicates(spark):
    kept = near.drop_near_duplicates(docs(spark, NEAR))
    assert kept.columns == docs(spark, []).columns
    want = {c for d, n, c in plain_components(NEAR, 3, 85) if n}
    got = kept.collect()
    assert sorted((r.doc_id or -1) for r in got if shingle_set(r.text, 3)) == sorted((c or -1) for c in want)
    assert {500, 501, 502} <= {r.doc_id for r in got}
    assert near.drop_near_duplicates(docs(spark, [])).collect() == [] and near.near_duplicates(docs(spark, [])).collect() == []


def test_agreements():
    t = near.agreements(85)
    below = lambda t: sum(math.comb(near.K, i) * 0.85**i * 0.15 ** (near.K - i) for i in range(t))
    assert t == 13 and below(t) <= near.MISSED < below(t + 1)


# -- language


def test_language(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    profiles = language_id.learned(table)
    rows = [(r.doc_id, r.text, r.lang) for r in table.collect()]
    out = [(lang, profiles.predict(t)[0]) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 30 and sum(a == b for a, b in out) / len(out) > 0.95
    more = docs(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "the and of" * 9000), (5, "日本語の文章"), (None, "thing the of and")])
    got = {r.doc_id: r.f for r in more.select("doc_id", language_id.identify(more, profiles).alias("f")).collect()}
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1, 2, 3))
    assert got[None].lang_pred == "en" and all(0 <= f.score <= 1 for f in got.values()) and got[5].score < language_id.LEAST_SCORE
    kept = language_id.keep_identified(more, profiles)
    assert {r.doc_id for r in kept.collect()} == {4, None} and kept.columns == more.columns
    none = language_id.learn_profiles(docs(spark, []))
    assert none.predict("text") == ("und", 0.0)


def plain_profile(texts, most):
    counts = defaultdict(int)
    for t in texts:
        for word in re.findall(r"[^\W\d_]+", t.lower()):
            padded = f"_{word}_"
            for c in word:
                counts[c] += 1
            for n in (2, 3):
                for i in range(len(padded) - n + 1):
                    counts[padded[i : i + n]] += 1
    code = lambda g: int(sum((1 if c == "_" else ord(c)) << (18 * (len(g) - 1 - i)) for i, c in enumerate(g)))
    return [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:most]


def test_ngrams_and_ranks_equal_a_plain_count():
    for text in ("The cat, the hat.", "é É ß a", "one", "a1b", "x-y z", "Äpfel über alles " * 30):
        assert language_id.ranked(*language_id.counted(text), 50).tolist() == plain_profile([text], 50)


def test_spans_do_not_change_ngrams(monkeypatch):
    texts = ["", " ", "a", "The cat,  the hat. " * 9, "x" * 70, "ab--cd é ", "1 2 3", "wörter und ΣΑΣ"]
    whole = [[x.tolist() for x in language_id.counted(t)] for t in texts]
    for span in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "SPAN", span)
        assert [[x.tolist() for x in language_id.counted(t)] for t in texts] == whole


def test_distance_equals_a_plain_sum():
    ranks = {"a": plain_profile(["the cat sat on the mat"], 300), "b": plain_profile(["le chat est sur la table"], 300)}
    own = plain_profile(["the table"], 300)
    far = {k: sum(min(abs(r.index(c) - i), 300) if c in r else 300 for i, c in enumerate(own)) for k, r in ranks.items()}
    best = min(far, key=far.get)
    assert language_id.Profiles(ranks).predict("the table") == (best, 1 - far[best] / (300 * len(own)))


# -- quality


def test_quality(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["the", "cat", "of", "house", "and", "Sea."], 60)) for _ in range(150)]
    bad = [" ".join(x + "***" for x in rng.choice(["the", "cat", "of", "house"], 60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    labels = [(i, int(i < 150), "x") for i, _ in rows] + [(3, 1, "x"), (None, 1, "x"), (4, None, "x"), (9999, 1, "x")]
    table, marks = docs(spark, rows + [(None, "no id")]), spark.createDataFrame(labels, "doc_id long, quality int, text string")
    net = quality_cnn.learn(table.filter(F.col("doc_id") % 5 != 0), marks)
    more = docs(spark, [*rows, (-1, None), (-2, ""), (-3, "a"), (-4, "good text and the sea " * 20_000)])
    got = {r.doc_id: r.s for r in more.select("doc_id", quality_cnn.quality_score(more, net).alias("s")).collect()}
    held = [i for i, _ in rows if i % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i < 150) for i in held]) > 0.95 and all(0 <= s <= 1 for s in got.values()) and got[-1] == got[-2]
    again = quality_cnn.learn(table.filter(F.col("doc_id") % 5 != 0), marks)
    assert np.array_equal(again.table, net.table) and again.offset == net.offset
    assert quality_cnn.learn(docs(spark, []), marks).score(np.zeros(0, np.uint8)) >= 0


@pytest.mark.parametrize("n", [0, 1, 4, 255, 256, 257, 700, 256 * 4096 + 3])
def test_every_byte_is_seen(n):
    """Blocks and spans equal a plain loop over all positions."""
    net = quality_cnn.ByteNet()
    body = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    padded = np.concatenate([body, np.zeros(quality_cnn.WIDTH, np.uint8)])
    size = max(1, n)
    respond = sum(net.table[j][padded[j : j + size]] for j in range(quality_cnn.WIDTH))
    blocks = np.array([respond[a : a + quality_cnn.BLOCK].max(0) for a in range(0, size, quality_cnn.BLOCK)])
    z = net.features(blocks) @ net.out + net.offset
    assert abs(net.score(body) - 1 / (1 + math.exp(-z))) < 1e-5


@pytest.mark.parametrize("n", [0, 3, 256, 700])
def test_gradient_equals_differences(n):
    """Each weight's gradient against the change of the loss."""
    net = quality_cnn.ByteNet()
    net.bias += 0.5
    rng = np.random.default_rng(n)
    body = rng.integers(0, 256, n).astype(np.uint8)
    padded, size = net.padded(body)
    got = net.gradient(padded, size, 1.0, 2.0)
    loss = lambda: -2 * math.log(net.score(body))
    cells = [("offset", None)] + [("out", (i,)) for i in range(0, 24, 5)] + [("bias", (i,)) for i in range(0, 12, 5)]
    cells += [("table", tuple(c)) for c in np.argwhere(np.abs(got["table"]) > 1e-3)[:6].tolist()]
    for name, cell in cells:
        value, step = getattr(net, name), np.float32(1e-2)
        ends = []
        for sign in (1, -1):
            changed = np.array(value, np.float32)
            changed[() if cell is None else cell] += sign * step
            setattr(net, name, changed if cell is not None else np.float32(changed))
            ends.append(loss())
            setattr(net, name, value)
        want = (ends[0] - ends[1]) / (2 * float(step))
        assert abs(want - (got[name] if cell is None else got[name][cell])) < 0.02 + 0.05 * abs(want), (name, cell)


def test_whole_texts_are_learned_from(spark):
    """What tells the classes apart stands in one place deep inside long texts."""
    filler = "the house and the sea and the cat of the house " * 400
    rows = [(i, filler[: 9000 + 37 * i] + ("~~~~ ^^^^ " * 3 if i % 2 else "") + filler) for i in range(40)]
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    net = quality_cnn.learn(docs(spark, rows), marks)
    scores = [net.score(np.frombuffer(t.encode(), np.uint8)) for _, t in rows]
    assert min(scores[1::2]) > max(scores[::2])
    # The budget of bytes leaves rows out, never parts of rows.
    few = quality_cnn.learn(docs(spark, rows), marks, bytes_at_most=len(rows[0][1]) - 1)
    assert np.array_equal(few.table, quality_cnn.ByteNet().table)


# -- licenses


def plain_licenses(rows):
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    shingles = lambda w: [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for doc, text in rows:
        own = shingles(words(text))
        for name, body in license_scan.TEMPLATES:
            t = set(shingles(words(body)))
            span = 1 << math.ceil(math.log2(len(t)))
            at = {x for i, s in enumerate(own) if s in t for x in (i // span, i // span - 1) if x >= 0}
            for w in at:
                share = len(t & set(own[w * span : (w + 2) * span])) / len(t)
                if share >= 0.8:
                    best, n = out.get((doc, name), (0.0, 0))
                    out[doc, name] = (max(best, share), n + 1)
    return out


def test_licenses(spark):
    by = dict(reversed(license_scan.TEMPLATES))
    mit = license_scan.TEMPLATES[9][1]
    edited = " ".join("XX" if i in (3, 60) else w for i, w in enumerate(mit.split()))
    broken = " ".join("XX" if i % 4 == 0 else w for i, w in enumerate(mit.split()))
    rows = [(1, mit), (2, "lead " * 700 + edited + " tail" * 300), (3, broken), (4, None), (5, ""), (6, "MIT License."), (7, "released UNDER the mit   license"), (8, "Released under the MIT License.\n" * 40), (9, by["ISC"] + " " + by["Unlicense"]), (None, by["GPL-3.0-only"]), (7, by["CC-BY-NC-4.0"]), (10, "x " * 50_000 + by["MPL-2.0"])]
    got = {(r.doc_id, r.license): (r.containment, r.n_windows) for r in license_scan.license_scan(docs(spark, rows)).collect()}
    assert got == plain_licenses(rows) and (3, "MIT") not in got and (2, "MIT") in got and (None, "GPL-3.0-only") in got
    assert license_scan.license_scan(docs(spark, [])).collect() == []
    for bad in ((), (("short", "two words"),)):
        with pytest.raises(ValueError):
            license_scan.license_scan(docs(spark, rows), bad)


def test_sql_of_native_operators(spark, duck, small):
    from conftest import rows_of
    from folioloom import llm

    for name, sql in llm.ORACLE.items():
        assert rows_of(llm.QUERIES[name](spark, small).toPandas()) == rows_of(duck.execute(sql).df()), name


def test_hash_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
