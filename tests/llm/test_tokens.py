"""Token files, token counts and chat formats: exact round trips and plain versions."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm.chat_format import CONTROL, FORMATTED, TEMPLATE, TemplateError, compile_template, escape, fold_block, format_conversations, parse, read_back, turns_of, unescape
from folioloom.llm.common import stage_path
from folioloom.llm.token_counts import PieceAutomaton, automaton, token_counts, vocabulary
from folioloom.llm.token_files import PieceEncoder, default_tokenizer, encoder, ids_crc32, read_token_files, write_token_files

ODD = ["", "a", "\n\n a  b\n\n\nc \n d ", "x\0 y", "don't  we'll\t'so   a  b", "tail  ", "  lead", "a\x1c b \x85 c\xa0 d　 e", "<|endoftext|> a b", " ", "\n", "é\r\n x  12 34,5", "été à\nla", "word " * 50_000, "||| *** a.b,", "日本 語\n"]


def test_token_files_round_trip(spark):
    rows = [(i * 3 - 9, t, 1, 2) for i, t in enumerate(ODD)] + [(3, "tie", 1, 2), (3, "tie", 1, 2), (None, "no id", 1, 2), (100, None, 1, 2)]
    out = stage_path(spark, "test-tokens")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string, part int, tokens long"), out, partitions=3)
    got = read_token_files(spark, out).orderBy("start").collect()
    tok = encoder(default_tokenizer()).tokenizer
    order = lambda x: (x is not None, x or 0)
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=order)
    want = sorted((r[0] if r[0] is not None else -999, tok.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -999, list(r.tokens)) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    crc = {r.c for r in read_token_files(spark, out).select(ids_crc32("tokens").alias("c")).collect()}
    assert crc == {zlib.crc32(np.array(x, "<u4").tobytes()) for _, x in want}


def test_files_have_encodings_and_page_indexes(spark, small):
    import glob

    import pyarrow.parquet as pq

    out = stage_path(spark, "test-files")
    write_token_files(spark.read.parquet(f"{small}/documents.parquet"), out, partitions=2)
    files = glob.glob(out.removeprefix("file://") + "/*.parquet")
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(4)
    assert column.path_in_schema.startswith("tokens") and "RLE_DICTIONARY" in column.encodings
    assert column.has_offset_index and pq.ParquetFile(files[0]).metadata.row_group(0).column(1).has_column_index
    plan = read_token_files(spark, out).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_token_table(spark):
    out = stage_path(spark, "test-empty")
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), out)
    assert read_token_files(spark, out).collect() == [] and token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 　ab.,'sé1²日<|"), max_size=20) | st.text(max_size=12), max_size=6))
def test_pieces_encode_as_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    enc = encoder(default_tokenizer())
    ids, counts = enc.encode(pa.array(texts, pa.string()), 2) if texts else (np.zeros(0, int), np.zeros(0, int))
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_cache_begins_anew(monkeypatch):
    import folioloom.llm.token_files as T

    monkeypatch.setattr(T, "CACHE_PIECES", 5)
    enc = PieceEncoder(default_tokenizer())
    for _ in range(3):
        for t in ("one two three four five six seven", "two eight nine"):
            ids, _ = enc.encode(pa.array([t]), 2)
            assert ids.tolist() == enc.tokenizer.encode(t).ids + [2]


def test_kept_pieces_are_arrays(monkeypatch):
    import sys

    import folioloom.llm.token_files as T

    enc = PieceEncoder(default_tokenizer())
    text = "".join(f" w{i:x} é{i}　\n{i}." for i in range(30_000)) + "x" * 100 + "\x85"
    want = enc.tokenizer.encode(text).ids + [2]
    enc.encode(pa.array(["warm up"]), 2)
    before = sys.getallocatedblocks()
    for _ in range(2):
        ids, counts = enc.encode(pa.array([text, ""]), 2)
        assert ids.tolist() == [*want, 2] and counts.tolist() == [len(want), 1]
    del ids, counts
    assert sys.getallocatedblocks() - before < 5_000  # no Python objects for each of some 90,000 pieces
    # Pieces that aren't met in a whole set go, and all are still right.
    monkeypatch.setattr(T, "CACHE_PIECES", 50)
    for i in range(0, 1_000, 20):
        part = "".join(f" q{j} same" for j in range(i, i + 20)) + "　"
        assert enc.encode(pa.array([part]), 2)[0].tolist() == enc.tokenizer.encode(part).ids + [2]
    assert len(enc.pieces) == len(enc.counts) == len(enc.newest) < 150 and b" same" in enc.pieces.to_pylist()


def greedy(word: bytes, begins: set, goes_on: set) -> int:
    word, at, n = b" " + word, 0, 0
    while at < len(word):
        known = begins if at == 0 else goes_on
        at = next(j for j in range(len(word), at, -1) if word[at:j] in known)
        n += 1
    return n


def test_counts_are_greedy_longest_match(spark, small):
    pieces = set(vocabulary(default_tokenizer()))
    begins, goes_on = {p for p in pieces if p[:1] == b" "} | {b" "}, {p for p in pieces if p[:1] != b" "} | {b" "}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").limit(40).collect()] + [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "x" * 3000), (-5, "é 日本 \x1c a"), (-5, "é")]
    got = sorted(map(tuple, token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    words = [(i, (t or "").encode().split()) for i, t in rows]
    assert got == sorted((i, len(w), sum(greedy(x, begins, goes_on) for x in w)) for i, w in words)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=25), st.sets(st.binary(max_size=4).map(lambda b: b" " + bytes(x % 3 + 97 for x in b)), max_size=15), st.binary(max_size=30).map(lambda b: bytes(x % 3 + 97 for x in b)))
def test_automaton_on_any_vocabulary(goes_on, begins, word):
    own = goes_on | {bytes([b]) for b in range(256)}
    assert PieceAutomaton([*begins, *goes_on]).count(word) == greedy(word, begins | {b" "}, own)


def test_automaton_is_shared():
    assert automaton(default_tokenizer()) is automaton(default_tokenizer())


# -- chat formats

ROWS = "conv_id long, turn long, role string, text string, piece string"


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark, monkeypatch):
    said = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "tool", "[TEXT]\\."), (1, 3, None, None), (2, 5, "assistant", ""), (2, 1, "system", "<s>" * 3), (None, 0, "assistant", "null é"), (3, 0, "user", "x" * 600_000), (3, 1, "assistant", "\\" * 5), (3, 1, "assistant", "\\" * 5), (3, 0, "user", "tie")]
    said += [(4, i, "assistant" if i % 2 else "user", f"t{i}</s>") for i in range(1300)]
    by = {}
    for c, t, r, x in sorted(said, key=lambda q: (q[0] or 0, q[1], q[2] or "", q[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    out = stage_path(spark, "test-chat")
    format_conversations(spark.createDataFrame([(*r, "clash") for r in said], ROWS)).write.parquet(out)
    formatted = spark.read.schema(FORMATTED).parquet(out)
    assert formatted.filter("conv_id = 4").count() == 3 and formatted.filter("conv_id = 3").count() == 2
    got = {r.conv_id: tuple(r)[1:5] for r in read_back(formatted).collect()}
    assert got == {c: digests(t) for c, t in by.items()}
    assert format_conversations(spark.createDataFrame([], ROWS)).collect() == [] and read_back(spark.createDataFrame([], FORMATTED)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]) | st.text(max_size=4), st.lists(st.sampled_from([*CONTROL, "\\", ".", "<", "[", "/s>", " ", "x"]), max_size=8).map("".join)), min_size=1, max_size=5))
def test_any_text_survives(turns):
    render = compile_template(TEMPLATE)
    text, spans = render(first=True, messages=[{"role": r, "text": t} for r, t in turns])
    assert turns_of(text) == turns
    assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert all(c not in escape(t) for _, t in turns for c in CONTROL)


def test_templates():
    show = lambda source, **names: compile_template(source)(**names)[0]
    assert show("{% for m in xs %}{{ loop.index }}{{ m }}{% if not loop.last %},{% endif %}{% endfor %}", xs=["a", "b"]) == "1a,2b"
    assert show("{{ a['k'] ~ 'x'|upper }}{# gone #}", a={"k": 1}) == "1X"
    assert show("{% if a == 'q' or a in 'xyz' and true %}yes{% elif b %}b{% else %}no{% endif %}", a="y", b="") == "yes"
    assert show('{{ "\\n" }}{{ none }}') == "\n"
    assert fold_block(parse("{% if 1 == 2 %}a{% elif x %}b{% elif true %}c{% else %}d{% endif %}e")) == [("if", [(("name", "x"), [("text", "b")])], [("text", "c")]), ("text", "e")]
    assert fold_block(parse("a{% if not false %}b{% endif %}{{ 'c' ~ 1 }}")) == [("text", "abc1")]


@pytest.mark.parametrize("source", ["{% for x %}{% endfor %}", "{% if a %}", "{{ a b }}", "{{ a|nope }}", "{% do x %}", "{{ f() }}", "{{ 1 + }}"])
def test_bad_templates(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_sandbox():
    for source in ("{{ a.__class__ }}", "{{ ''.__class__ }}", "{{ missing }}", "{% for x in a %}{% endfor %}"):
        with pytest.raises(TemplateError):
            compile_template(source)(a="text")
