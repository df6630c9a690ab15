"""License scans in DataFrame functions only.

Each document is cut into overlapping windows of words; the MinHash values of a
window retrieve the templates that share one of its bands, by a join on (span,
band, value), and the exact share of the template's 5-word shingles that stand in
the window decides.

A template of m shingles is sought in windows of 2 * span shingles that begin
every span shingles, with span the power of two at or above m, so any run of m
shingles lies whole in one window. A window that holds a share of 0.8 of the
template has a Jaccard similarity of at least 0.8 m / (2 span + 0.2 m) > 0.19
with it. With 64 bands of one value the chance that no band agrees is below
0.81 ** 64 = 1.4e-6.

Windows without any shingle of any template can't hold a match and aren't
hashed, and bands that no template of the span has aren't joined. Both are asked
of a table of flags of fixed size in the plan, which lets some through in vain
and none escape; so the work beside the hashing of words follows the notices
in the corpus, and any number of templates of any length is possible.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import bit_table, read_table, stage

#: Words of a shingle, least share of a template's shingles in a window, bands of one MinHash value each.
SHINGLE, SHARE, BANDS = 5, 0.8, 64
#: Flags of a table: some 64 times the number of keys, from 2 ** 17 to 2 ** 22, a bit each, as the plan holds them; a key sets PROBES of them.
LEAST_FLAGS, MOST_FLAGS, PROBES = 1 << 17, 1 << 22, 3
#: Up to so many shingles of templates, a document is first asked for any of them at once; that is quicker and tells the same.
FEW_SHINGLES = 4096
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"

#: Notices and grants of common licenses, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


#: Notices beyond those that the SQL compares. BSD-2-Clause ends with the words that follow its last clause, which set it apart from BSD-3-Clause.
MORE_TEMPLATES = (
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version "
        "2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
)


def words_of(text: Column) -> Column:
    """Lower-case runs of digits, letters a-z and characters beyond ASCII."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def shingle_at(words: Column, i: Column) -> Column:
    return F.concat_ws(" ", *[F.get(words, i + j) for j in range(SHINGLE)])


def minhash(shingles: Column) -> Column:
    """One MinHash value for each band."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, b))))


def _probes(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, 20 * j) for j in range(PROBES)]


class Flags:
    """Whether a 64-bit hash may be among those of a table: a literal of flags, so that it is asked within an expression."""

    def __init__(self, keys: DataFrame, h: Column):
        self.size = min(MOST_FLAGS, max(LEAST_FLAGS, 1 << (64 * keys.count()).bit_length()))
        words = bit_table(keys.select(F.explode(F.array(*_probes(h))).alias("p")), F.col("p"), self.size).view("<i8")
        # One literal of text; the optimizer folds it to an array of 64-bit words.
        self.words = F.from_json(F.lit("[" + ",".join(map(str, words.tolist())) + "]"), "array<bigint>")

    def holds(self, h: Column) -> Column:
        return reduce(Column.__and__, [self._set(p.bitwiseAND(F.lit(self.size - 1).cast("long"))) for p in _probes(h)])

    def _set(self, place: Column) -> Column:
        word = F.get(self.words, F.shiftright(place, 6).cast("int"))
        return F.getbit(word, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == F.lit(1).cast("byte")


def band_key(span: Column, band: Column, value: Column) -> Column:
    return F.xxhash64(span, band, value)


def template_table(spark: SparkSession, templates) -> DataFrame:
    """Staged (template, license, span, shingles, hashes) of ``templates``: pairs of license and text, or a table with the columns license and body."""
    if isinstance(templates, DataFrame):
        rows = templates.select(F.monotonically_increasing_id().alias("template"), F.col("license").cast("string").alias("license"), F.col("body").cast("string").alias("body"))
    else:
        if not templates:
            raise ValueError("no templates")
        rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template long, license string, body string")
    words = stage(rows.select("template", "license", words_of(F.col("body")).alias("words")), "op10-words")
    held = words.agg(F.count(F.lit(1)), F.coalesce(F.min(F.size("words")), F.lit(SHINGLE))).first()
    if not held[0]:
        raise ValueError("no templates")
    if held[1] < SHINGLE:
        raise ValueError(f"a template needs at least {SHINGLE} words")
    places = F.sequence(F.lit(0), F.size("words") - SHINGLE)
    rows = words.select("template", "license", F.array_distinct(F.transform(places, lambda i: shingle_at(F.col("words"), i))).alias("shingles"))
    span = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles").cast("double")) - 1e-9)).cast("int")
    return stage(rows.select("template", "license", span.alias("span"), "shingles", minhash(F.col("shingles")).alias("hashes")), "op10-templates")


def rival_table(templates: DataFrame, share: float) -> DataFrame:
    """(template, rivals) of the templates that have some: a rival is of another license and holds ``share`` of the template, so its text passes for both.

    Each is given by the shingles that the template alone has and those that the rival alone has.
    """
    held = templates.select("template", "license", F.size("shingles").alias("m"), F.explode("shingles").alias("s"))
    a, b = held.alias("a"), held.alias("b")
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & ~F.col("a.license").eqNullSafe(F.col("b.license"))).groupBy(F.col("a.template").alias("template"), F.col("b.template").alias("rival"), F.col("a.m").alias("m"))
    pairs = pairs.agg(F.count(F.lit(1)).alias("both")).filter(F.col("both") >= F.lit(share) * F.col("m")).select("template", "rival")
    mine, other = (templates.select(F.col("template").alias(t), F.col("shingles").alias(s)) for t, s in (("template", "mine"), ("rival", "others")))
    split = pairs.join(mine, "template").join(other, "rival").select("template", F.struct(F.array_except("mine", "others").alias("own"), F.array_except("others", "mine").alias("other")).alias("r"))
    return split.groupBy("template").agg(F.collect_list("r").alias("rivals"))


def _windows_of(span: int) -> Column:
    """The windows of ``span`` that hold a place of ``seen``: two overlap at each."""
    window = lambda at: F.struct(F.lit(span).alias("span"), at.cast("int").alias("at"))
    return F.array_distinct(F.flatten(F.transform("seen", lambda p: F.array(window(F.floor(p / span)), window(F.floor(p / span) - 1)))))


def license_scan(docs: DataFrame, templates=TEMPLATES + MORE_TEMPLATES, share: float = SHARE) -> DataFrame:
    """One row per document and license found: doc_id, license, containment, n_windows.

    containment is the greatest share of a template's shingles that one window
    holds, n_windows the number of windows (of any of the license's templates)
    with at least ``share``. Of templates whose texts pass for each other (versions
    of a license), one gives way where its row has a shingle that only the rival
    has and none that only it has. Null, empty and short texts have no findings;
    very long ones are scanned whole, and a task holds the words of one at a time.
    Rows with the same doc_id (null is one) are scanned apart and their findings
    merged. Other columns are not read. An empty table gives no rows. Without
    templates, or with one of fewer than 5 words, a ValueError is raised.
    """
    table = template_table(docs.sparkSession, templates)
    spans = sorted(r[0] for r in table.select("span").distinct().collect())  # powers of two, so some 20 at most
    bands = stage(table.select("span", "template", F.posexplode("hashes").alias("band", "value")), "op10-bands")
    # Equal hashes of different shingles only cost a window more to look at.
    shingles = table.select(F.explode("shingles").alias("s")).distinct()
    shingle_hash = F.xxhash64(*[F.get(F.split("s", " "), F.lit(j)) for j in range(SHINGLE)])
    known = Flags(shingles, shingle_hash)
    posted = Flags(bands, band_key(F.col("span"), F.col("band"), F.col("value")))
    w = F.col("words")
    last = F.size(w) - SHINGLE
    # Exploding a one-element array keeps the optimizer from putting the expression into each of its uses.
    once = lambda c: F.explode(F.array(c))
    worded = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", once(words_of(F.col("text"))).alias("words")).filter(F.size("words") >= SHINGLE)
    hashed = worded.select("uid", "doc_id", "words", once(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))).alias("hashes"))
    few = [r.h for r in shingles.select(shingle_hash.alias("h")).limit(FEW_SHINGLES + 1).collect()]
    if len(few) <= FEW_SHINGLES:
        hashed = hashed.filter(F.arrays_overlap("hashes", F.from_json(F.lit(f"[{','.join(map(str, few))}]"), "array<bigint>")))
    places = F.filter(F.sequence(F.lit(0), last), lambda i: known.holds(F.get("hashes", i)))
    hit = hashed.select("uid", "doc_id", "words", once(places).alias("seen")).filter(F.size("seen") > 0)
    windows = F.flatten(F.array(*[_windows_of(s) for s in spans]))
    cut = F.transform(
        F.filter(windows, lambda x: x["at"] >= 0),
        lambda x: F.struct(
            x["span"].alias("span"),
            x["at"].alias("at"),
            F.array_distinct(F.transform(F.sequence(x["at"] * x["span"], F.least((x["at"] + 2) * x["span"] - 1, last)), lambda i: shingle_at(w, i))).alias("shingles"),
        ),
    )
    marked = F.array_distinct(F.transform("seen", lambda i: shingle_at(w, i)))
    window = hit.select("uid", "doc_id", marked.alias("marked"), F.explode(cut).alias("w")).select("uid", "doc_id", "marked", "w.span", "w.at", "w.shingles", once(minhash(F.col("w.shingles"))).alias("own"))
    own = F.filter(F.transform("own", lambda v, b: F.struct(b.alias("band"), v.alias("value"))), lambda x: posted.holds(band_key(F.col("span"), x["band"], x["value"])))
    posts = window.select("uid", "doc_id", "marked", "span", "at", "shingles", F.explode(own).alias("p")).select("uid", "doc_id", "marked", "span", "at", "shingles", "p.band", "p.value")
    # A window meets a template once for each band that they share; it is compared once.
    met = posts.join(bands, ["span", "band", "value"]).groupBy("uid", "span", "at", "template").agg(F.first("doc_id").alias("doc_id"), F.first("marked").alias("marked"), F.first("shingles").alias("shingles"))
    about = table.select("template", "license", F.col("shingles").alias("sought")).join(rival_table(table, share), "template", "left")
    about = stage(about.withColumn("rivals", F.coalesce("rivals", F.array().cast("array<struct<own:array<string>,other:array<string>>>"))), "op10-about")
    found = met.join(about, "template")
    exact = F.size(F.array_intersect("shingles", "sought")).cast("double") / F.size("sought").cast("double")
    gives_way = F.exists("rivals", lambda r: ~F.arrays_overlap("marked", r["own"]) & F.arrays_overlap("marked", r["other"]))
    return found.filter(~gives_way).select("doc_id", "license", exact.alias("containment")).filter(F.col("containment") >= share).groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.count(F.lit(1)).alias("n_windows"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def _sql_templates() -> str:
    quoted = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES + MORE_TEMPLATES))
    return f"(VALUES {quoted})"


OP10_SQL = rf"""
WITH t AS (SELECT template, license, regexp_extract_all(lower(body), '{WORD}') AS w FROM {_sql_templates()} AS v(template, license, body)),
ts AS (SELECT DISTINCT template, license, array_to_string(w[i + 1 : i + {SHINGLE}], ' ') AS s FROM (SELECT *, unnest(range(len(w) - {SHINGLE - 1})) AS i FROM t)),
sized AS (SELECT *, count(*) OVER (PARTITION BY template) AS m FROM ts),
tpl AS (SELECT *, CAST(2 ** ceil(log2(m) - 1e-9) AS BIGINT) AS span FROM sized),
riv AS (SELECT a.template AS t, b.template AS r FROM tpl a JOIN tpl b ON a.s = b.s AND a.license <> b.license GROUP BY a.template, b.template, a.m HAVING count(*) >= {SHARE} * a.m),
only_one AS (
  SELECT t, r, true AS own, x.s FROM riv JOIN tpl x ON x.template = t WHERE NOT EXISTS (SELECT 1 FROM tpl y WHERE y.template = r AND y.s = x.s)
  UNION ALL SELECT t, r, false, x.s FROM riv JOIN tpl x ON x.template = r WHERE NOT EXISTS (SELECT 1 FROM tpl y WHERE y.template = t AND y.s = x.s)),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
q AS (SELECT rid, doc_id, list_transform(range(greatest(len(w) - {SHINGLE - 1}, 0)), lambda i: array_to_string(w[i + 1 : i + {SHINGLE}], ' ')) AS ss FROM d),
p AS (SELECT rid, doc_id, unnest(ss) AS s, unnest(range(len(ss))) AS i FROM q),
h AS (SELECT p.rid, p.doc_id, tpl.template, tpl.license, tpl.m, tpl.s, unnest([p.i // span, p.i // span - 1]) AS win FROM p JOIN tpl USING (s)),
gives AS (SELECT DISTINCT rid, t AS template FROM (SELECT rid, t, r FROM (SELECT DISTINCT rid, s FROM h) JOIN only_one USING (s) GROUP BY rid, t, r HAVING NOT bool_or(own))),
f AS (SELECT rid, doc_id, template, license, win, count(DISTINCT s)::DOUBLE / any_value(m)::DOUBLE AS containment FROM h WHERE win >= 0 GROUP BY ALL)
SELECT doc_id, license, max(containment) AS containment, count(*) AS n_windows FROM f ANTI JOIN gives USING (rid, template) WHERE containment >= {SHARE} GROUP BY doc_id, license
"""

QUERIES = {"op10_license_scan": op10_license_scan}
ORACLE = {"op10_license_scan": OP10_SQL}
