"""What the operators share: words in spans, bitmaps, shared folders, batches, memory of long texts."""

import subprocess
import sys
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioloom.llm import common
from folioloom.llm.common import ALNUM, SPACED, Words, bit_table, in_bitmap, read_roots, shared_dir, small_batches, stage, utf8_buffer

TEXTS = ["Ab c  de", "", "xx yy", "a" * 300, "hello world " * 40, None, "z", "é ß-書 x1"]


@pytest.mark.parametrize("span", [1, 2, 3, 64])
@pytest.mark.parametrize("inside", [SPACED, ALNUM])
def test_spans_do_not_change_words(monkeypatch, span, inside):
    whole = Words(*utf8_buffer(pa.array(TEXTS)), inside)
    monkeypatch.setattr(common, "SPAN", span)
    monkeypatch.setattr(common, "_powers", {})
    cut = Words(*utf8_buffer(pa.array(TEXTS)), inside)
    assert np.array_equal(whole.hash, cut.hash) and np.array_equal(whole.first, cut.first)
    for (k, a), (m, b) in zip(whole.window_hashes({1, 3}), cut.window_hashes({3, 1}), strict=True):
        assert k == m and np.array_equal(a, b) and np.array_equal(a, whole.windows(k))


def test_equal_words_have_equal_hashes_wherever_they_stand():
    w = Words(*utf8_buffer(pa.array(["one two one", "x one"])), SPACED)
    assert w.hash[0] == w.hash[2] == w.hash[4] != w.hash[1]


def test_long_text_stays_within_memory():
    """The words of 50 MB of text take less than 600 MB beside the text, and no table of that size stays."""
    code = (
        "import resource, numpy as np\n"
        "from folioloom.llm.common import Words, SPACED, _powers\n"
        "body = np.tile(np.frombuffer(b'the quick brown fox jumps ', np.uint8), 2_000_000)\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "w = Words(body, np.array([0, len(body)]), SPACED)\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024, len(w.hash), sum(x.nbytes for x in _powers.values()) >> 20)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=common.__file__.rsplit("/folioloom/", 1)[0])
    grown, words, kept = map(int, out.stdout.split())
    assert words == 10_000_000 and grown < 600 and kept < 32


def test_bit_tables(spark):
    df = spark.range(-500, 500).select((F.col("id") * 7_919_000_001).alias("h"))
    held = [r.h for r in df.collect()]
    table = bit_table(df, F.col("h"), 1 << 17)
    assert in_bitmap(table, np.array(held)).all() and 0 < np.unpackbits(table).sum() <= 1000


def test_shared_folder_must_be_named_on_a_cluster():
    conf = {}
    session = lambda master: types.SimpleNamespace(sparkContext=types.SimpleNamespace(master=master), conf=types.SimpleNamespace(get=lambda k, d: conf.get(k, d), set=conf.__setitem__))
    for master in ("yarn", "k8s://x", "spark://h:1", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("local[4]")) == conf["spark.checkpoint.dir"]
    assert shared_dir(session("yarn")) == conf["spark.checkpoint.dir"]


def test_batches_are_small_only_within(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), small_batches(spark):
        assert spark.conf.get(key) == f"{common.BATCH_BYTES}b"
        raise KeyError
    assert spark.conf.get(key) == before


def test_roots_of_a_frame(spark):
    a, b = stage(spark.range(3), "a"), stage(spark.range(3), "b")
    names = {r.rpartition("/")[2] for r in read_roots(a.join(b, "id").filter("id > 1"))}
    assert len(names) == 2 and all(n.startswith(("a-", "b-")) for n in names) and read_roots(spark.range(2)) == []
