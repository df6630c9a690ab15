"""Licenses that rival each other."""

from folioloom.llm.license_scan import MORE_TEMPLATES, TEMPLATES, license_scan


def test_the_best_matching_license_wins(spark):
    every = [*TEMPLATES, *MORE_TEMPLATES]
    clause = next(t for n, t in TEMPLATES if n == "BSD-3-Clause")
    gpl = {n: t for n, t in every if n.startswith("GPL") and n.endswith("later")}
    rows = [(i, "lead in words " * 20 + t + " and so on") for i, (_, t) in enumerate(every)]
    want = {(i, n) for i, (n, _) in enumerate(every)}
    rows += [(100, " ".join(gpl.values())), (101, clause + " THIS SOFTWARE IS PROVIDED " + dict(MORE_TEMPLATES)["BSD-2-Clause"])]
    want |= {(100, n) for n in gpl} | {(101, "BSD-3-Clause"), (101, "BSD-2-Clause")}
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in got} == want


def test_many_templates_from_a_table(spark):
    """More templates than the built-in list, of up to 400 words, given as a table; and the same without the first question by document."""
    import random

    from folioloom.llm import license_scan as L

    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    texts = [(f"X-{i}", words(rng.choice([5, 9, 30, 120, 400]))) for i in range(300)]
    table = spark.createDataFrame(texts, "license string, body string")
    picked = rng.sample(range(300), 12)
    rows = [(i, f"{words(50)} {texts[k][1]} {words(70)}") for i, k in enumerate(picked)] + [(90, words(300)), (91, None), (92, ""), (93, " ".join(texts[0][1].split()[:3]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda: sorted((r.doc_id, r.license, r.containment) for r in L.license_scan(docs, table).collect())
    want = sorted((i, texts[k][0], 1.0) for i, k in enumerate(picked))
    assert found() == want
    few, L.FEW_SHINGLES = L.FEW_SHINGLES, 0
    try:
        assert found() == want
    finally:
        L.FEW_SHINGLES = few
