"""The corpus pipeline on a small table with planted cases, stage by stage."""

from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from folioloom.llm.token_files import default_tokenizer, encoder
from test_text_operators import plain_components, plain_hits, shingle_set


@pytest.fixture(scope="module")
def planted(spark, small, tmp_path_factory):
    """The small tables with a text without letters, a near copy, an exact copy, a leak, a null text and a repeated row."""
    base = spark.read.parquet(f"{small}/documents.parquet")
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    own = " ".join(f"the {w} of thing and" for w in "abcdefghijklmnopqrst") + " with the hand was for it"
    rows = [
        (900_001, "123 456 !!", "en", "src0", 10),
        (900_002, own, "en", "src0", 10),
        (900_003, own + " end", "en", "src1", 10),
        (900_004, own, "en", "src1", 10),
        (900_004, own, "en", "src1", 10),
        (900_005, "Of the thing was " + next(t for _, t in items if len(t.split()) > 12) + " and for it", "en", None, 10),
        (900_006, None, None, None, None),
    ]
    path = str(tmp_path_factory.mktemp("planted"))
    base.unionByName(spark.createDataFrame(rows, base.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, planted):
    path, items = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mixing", "token_files"]

    def apply(name, given):
        out = stages[name](spark, given, path)
        kept = corpus_pipeline.stage(out, f"test-{name}")
        if name != "token_files":
            assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
        return kept, out

    known, _ = apply("language_id", docs)
    got = Counter((r.doc_id, r.text) for r in known.collect())
    gone = Counter((i, t) for i, t, _ in rows) - got
    assert {(900_001, "123 456 !!"), (900_006, None)} <= set(gone) and all(not any(c.isalpha() for c in t or "") for _, t in gone) and not got - Counter((i, t) for i, t, _ in rows)

    single, _ = apply("near_dedup", known)
    before = [(r.doc_id, r.text) for r in known.collect()]
    classes = plain_components(before, 5, 80)
    want = sorted({c for (d, n, c) in classes if n} | {d for (d, n, c) in classes if not n})
    assert sorted(r.doc_id for r in single.collect()) == want and 900_002 in want and not {900_003, 900_004} & set(want)

    clean, _ = apply("decontamination", single)
    before = [(r.doc_id, r.text) for r in single.collect()]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, t in before if not plain_hits(t, items)[1])
    assert 900_005 in {i for i, _ in before} and 900_005 not in {r.doc_id for r in clean.collect()}

    mixed, _ = apply("mixing", clean)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in clean.collect()} and max(copies.values()) <= 3

    tokens, _ = apply("token_files", mixed)
    out = sorted(tokens.collect(), key=lambda r: r.start)
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist() and Counter(r.doc_id for r in out) == copies
    tok = encoder(default_tokenizer()).tokenizer
    lengths = {r.doc_id: len(tok.encode(r.text or "").ids) + 1 for r in mixed.collect()}
    assert all(r.n_tokens == lengths[r.doc_id] for r in out)
    assert all(shingle_set(t, 5) is not None for _, t in before)
    # The whole run gives what the stages give.
    key = lambda r: (r.doc_id, r.start, r.n_tokens, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, path).collect())) == sorted(map(key, out))


def test_pipeline_is_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert [f"op{n}_" for n in range(1, 11)] == sorted({q.split("_")[0] + "_" for q in __spark_entry__.queries() if q.startswith("op")}, key=lambda q: int(q[2:-1]))


def test_empty_tables(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


CLASHING = ["row", "uid", "f", "id", "h", "size", "copies", "rate", "target", "source_size", "of", "maybe", "key", "n", "sig", "lang_pred", "score", "n_hit", "items", "clean", "part", "tokens", "TEXT2"]


def test_clashing_columns_ties_and_empty_tables(spark, planted):
    """Columns with the names that stages use inside come through unchanged; repeated rows and an empty table are no trouble."""
    path, _ = planted
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id < 60 or doc_id > 900000")
    wide = docs.unionAll(docs.filter("doc_id < 5")).withColumns({c: corpus_pipeline_column(i) for i, c in enumerate(CLASHING)})
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stage(apply(spark, wide, path), f"clash-{name}")
        assert out.columns == wide.columns
        rows = [tuple(r) for r in out.collect()]
        assert rows and not set(rows) - {tuple(r) for r in wide.collect()}
        assert corpus_pipeline.stage(apply(spark, wide.limit(0), path), f"none-{name}").count() == 0
    last = corpus_pipeline.tokenize(spark, wide, path)
    assert last.count() == wide.count() and corpus_pipeline.tokenize(spark, wide.limit(0), path).count() == 0


def corpus_pipeline_column(i):
    from pyspark.sql import functions as F

    return F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def test_run_leaves_no_table_of_a_stage(spark, planted):
    import os

    path, _ = planted
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(f"{root}/folioloom"))
    corpus_pipeline.run(spark, path).count()
    assert not [n for n in set(os.listdir(f"{root}/folioloom")) - before if n.startswith("pipeline-") and not n.startswith("pipeline-tokens")]
