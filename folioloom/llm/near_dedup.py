"""MinHash near-dedup by an inverted join on signature coordinates.

1. Each text gives its set of distinct 3-word shingles (as 64-bit hashes), the
   digest of that set and a MinHash signature. Texts with the same set are one
   class; only one representative of each goes on.
2. A signature is a set of K posts (coordinate, value). Posts that only one
   representative has are skipped. The m others are put in one order for all,
   rarest first; two signatures that share at least T posts share one of the
   first m - T + 1 of either, so a representative is posted under these alone,
   and under none where m < T. So what very many texts have in common (a notice,
   a menu) makes a long list only for those that have little else.
3. Within a posting list the agreements of the signatures are counted; pairs with
   at least T that aren't connected yet become edges. Only a spanning forest
   leaves a task, never all pairs.
4. The connected components of these edges are candidate clusters. Within each
   the exact sets are compared; links are confirmed on full sets, and again only
   a spanning forest of the links leaves a task.
5. Components of the links are the answer.

Long lists and large clusters are split into blocks. Each block is compared
within itself and with one pivot of its group, which is copied to all blocks.
Rows that are connected to the pivot by then are of one component, so only the
others meet the rows of further blocks, a pair of blocks a group. A group of
near copies therefore costs in proportion to its size, however large it is.

T follows from the least similarity: a pair just at it agrees in fewer than T of
K coordinates with a chance of at most 1e-4 (6e-5 at 0.85, T = 13), and is then
missed only if no other candidates connect the two.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import SPACED, Words, connected_components, mixed, read_table, release, slices, stage, utf8_buffer, within_bitmap

#: Words of a shingle; least similarity in percent.
SHINGLE, PERCENT = 3, 85
#: Coordinates of a signature, and the greatest chance that a pair at the threshold has too few agreements.
K, MISSED = 24, 1e-4
#: Rows of a block of a posting list; documents, and shingles in all, of a block of a cluster.
LIST_BLOCK, CLUSTER_BLOCK, CLUSTER_SHINGLES = 512, 96, 1 << 20

_MULTIPLY = mixed(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mixed(np.arange(101, K + 101, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: pa.Array, size: int = SHINGLE):
    """The sorted distinct shingle hashes of each text; a text with fewer words, but not none, has its whole sequence as one."""
    for a, b in slices(texts):
        words = Words(*utf8_buffer(texts.slice(a, b - a)), SPACED)
        shingles = words.windows(size)
        short = dict(words.window_hashes(range(1, size)))
        for first, stop in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            n = stop - first
            if n >= size:
                own = np.sort(shingles[first : stop - size + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                yield short[n][first : first + 1] if n else np.zeros(0, np.uint64)


def signature(own: np.ndarray) -> np.ndarray:
    """The least of each of K hashes over the set, its upper 32 bits."""
    least = np.full(K, 2**64 - 1, np.uint64)
    for a in range(0, len(own), 1 << 14):
        np.minimum(least, (own[a : a + (1 << 14), None] * _MULTIPLY + _ADD).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def agreements(percent: int) -> int:
    """The greatest T for which a pair of that similarity agrees in fewer than T of K coordinates with a chance of at most MISSED."""
    p, below = percent / 100, 0.0
    for t in range(K + 1):
        below += math.comb(K, t) * p**t * (1 - p) ** (K - t)
        if below > MISSED:
            return max(1, t)
    return K


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.astype("<u8").tobytes(), digest_size=16).digest()


def described(texts: pa.Array, size: int) -> pa.Array:
    n, keys, sigs = [], [], []
    for own in shingle_sets(texts, size):
        n.append(len(own))
        keys.append(digest(own))
        sigs.append(signature(own))
    sig = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * K), pa.array(np.concatenate(sigs) if sigs else np.zeros(0, np.int32)))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(keys, pa.binary()), sig], ["n", "key", "sig"])


class Forest:
    """Union-find over the rows of a batch that hands out only the edges that joined something."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Unite left[i] and right[i]; the pairs that were apart before."""
        label, done = self.label, []

        def root(x: int) -> int:
            while label[x] != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                label[max(x, y)] = min(x, y)
                done.append((a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further
        return done


def by_group(batches, keys: int):
    """Tables of whole groups (rows with the same first ``keys`` columns, which come in a row); the open group waits for the next batch."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(i)) for i in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        if waiting and any(np.asarray(waiting[-1].column(i).slice(waiting[-1].num_rows - 1))[0] != c[0] for i, c in enumerate(cols)):
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting = []
        if not len(change):
            waiting.append(batch)
            continue
        cut = int(change[-1])
        yield pa.Table.from_batches([*waiting, batch.slice(0, cut)]).combine_chunks()
        waiting = [batch.slice(cut)]
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def group_bounds(table: pa.Table, keys: int) -> np.ndarray:
    cols = [np.asarray(table.column(i)) for i in range(keys)]
    change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
    return np.concatenate([[0], change, [table.num_rows]])


def match_edges(batches, least: int):
    """Rows (group, bi, bj, side, pivot, rep, sig) sorted by the first three; edges of pairs with at least ``least`` agreements, and what stays apart from the pivot."""
    for table in by_group(batches, 3):
        bounds = group_bounds(table, 3)
        sizes = np.diff(bounds)
        ends = np.repeat(bounds[1:], sizes)
        side, rep = np.asarray(table["side"]), np.asarray(table["rep"])
        across = np.asarray(table["bi"]) != np.asarray(table["bj"])
        sig = np.asarray(table["sig"].combine_chunks().flatten()).reshape(-1, K)
        forest, edges = Forest(len(rep)), []
        rows = np.arange(len(rep))
        for d in range(1, int(sizes.max())):
            rows = rows[rows + d < ends[rows]]
            # Skip what is connected already, and pairs of one side where two blocks meet.
            todo = rows[forest.label[rows] != forest.label[rows + d]]
            todo = todo[~across[todo] | (side[todo] != side[todo + d])]
            if len(todo):
                todo = todo[(sig[todo] == sig[todo + d]).sum(1) >= least]
                if len(todo):
                    edges += forest.join(todo, todo + d)
        yield edge_batch(table, rep, edges, forest, bounds)
    release()


def edge_batch(table: pa.Table, rep: np.ndarray, edges: list[tuple[int, int]], forest: Forest, bounds: np.ndarray) -> pa.RecordBatch:
    """(group, u, v): the edges, with group null; and for each row of a group with a pivot that isn't connected to it, the row as u, with v null."""
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    pivot = np.flatnonzero(np.asarray(table["pivot"]))
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    of_pivot = np.full(len(bounds) - 1, -1)
    of_pivot[group[pivot]] = forest.label[pivot]
    apart = np.flatnonzero((of_pivot[group] >= 0) & (of_pivot[group] != forest.label))
    u = np.concatenate([rep[pairs[:, 0]], rep[apart]]).astype(np.int64)
    v = np.concatenate([rep[pairs[:, 1]], rep[apart]]).astype(np.int64)
    is_edge = np.arange(len(u)) < len(pairs)
    groups = np.concatenate([np.zeros(len(pairs), np.int64), np.asarray(table.column(0))[apart].astype(np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(groups, mask=is_edge), pa.array(u), pa.array(v, mask=~is_edge)], ["group", "u", "v"])


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: 100 * intersection >= percent * union, counted exactly."""
    n = np.array([len(s) for s in sets], np.int64)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = np.bincount(at, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[at]
    at, owner = place[at[keep]], owner[keep]
    both = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    width = 1 << 14
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(at, [a, a + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[lo:hi], at[lo:hi] - a] = 1
        both += (has @ has.T).astype(np.int64)
    return 100 * both >= percent * (n[:, None] + n[None] - both)


def link_edges(batches, percent: int):
    """Rows (group, bi, bj, side, pivot, rep, set) sorted by the first three; edges of confirmed links, and what stays apart from the pivot."""
    for table in by_group(batches, 3):
        bounds = group_bounds(table, 3)
        rep, sets = np.asarray(table["rep"]), table["set"].combine_chunks()
        forest, edges = Forest(len(rep)), []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a > 1:
                own = [np.frombuffer(s, "<u8") for s in sets.slice(a, b - a).to_pylist()]
                left, right = np.nonzero(np.triu(linked(own, percent), 1))
                edges += forest.join(left + a, right + a)
        yield edge_batch(table, rep, edges, forest, bounds)
    release()


EDGES = "group bigint, u bigint, v bigint"


def forest_of(members: DataFrame, value: str, compare, name: str) -> DataFrame:
    """Edges (u, v) of a spanning forest of the pairs that ``compare`` finds within the groups of ``members``.

    ``members`` is a staged table (group, blocks, rep, ``value``); a group has
    about ``blocks`` blocks of rows, by the hash of rep. First every block is
    compared within itself and with the group's pivot, the row of the least rep.
    Then the rows that aren't connected to the pivot meet all blocks of their
    group, in blocks of their own. Pairs that neither step compares are both
    connected to the pivot.
    """
    zero, no = F.lit(0).cast("long"), F.lit(False)
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("long")
    sized = members.filter("blocks > 1").groupBy("group").agg(F.min("rep").alias("first"))
    large = stage(sized, f"{name}-pivots")
    own = members.join(large, "group", "left").select("group", block.alias("bi"), block.alias("bj"), zero.alias("side"), F.coalesce(F.col("rep") == F.col("first"), no).alias("pivot"), "rep", value, "blocks")
    pivots = own.filter("pivot")
    others = F.filter(F.sequence(zero, F.col("blocks") - 1), lambda b: b != F.col("bi"))
    copies = pivots.select("group", F.explode(others).alias("b"), "side", "pivot", "rep", value).select("group", F.col("b").alias("bi"), F.col("b").alias("bj"), "side", "pivot", "rep", value)
    first = stage(_compared(own.drop("blocks").unionByName(copies), compare), f"{name}-first")
    apart = first.filter("v is null").select("group", F.col("u").alias("rep")).distinct()
    counts = apart.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    if counts.isEmpty():
        return first.filter("v is not null").select("u", "v")
    share = members.select("group", "blocks").join(counts, "group").groupBy("group").agg(F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("blocks").alias("blocks"))
    # Blocks of the rows that are apart are as large as those of all rows.
    share = stage(share.select("group", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("blocks") * F.col("n") / F.col("rows")).cast("long")).alias("more")), f"{name}-shares")
    all_rows = members.join(share, "group").select("group", block.alias("bi"), "rep", value, "blocks", "more")
    here = all_rows.select("group", "bi", F.explode(F.sequence(zero, F.col("more") - 1)).alias("bj"), "rep", value, zero.alias("side"))
    own_block = F.pmod(F.xxhash64("rep"), F.col("more")).cast("long")
    # A row that stays apart can't be told from others by its value; it is fetched by its id.
    there = all_rows.join(stage(apart, f"{name}-apart"), ["group", "rep"], "left_semi").select("group", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("bi"), own_block.alias("bj"), "rep", value, F.lit(1).cast("long").alias("side"))
    # Sides are told apart by ``side``, so no number of a block may say that they are one.
    met = here.unionByName(there).select("group", "bi", (-F.col("bj") - 1).alias("bj"), "side", no.alias("pivot"), "rep", value)
    second = stage(_compared(met, compare), f"{name}-second")
    return first.unionByName(second).filter("v is not null").select("u", "v")


def _compared(rows: DataFrame, compare) -> DataFrame:
    grouped = rows.repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj", "rep")
    return grouped.mapInArrow(compare, EDGES).filter("v is null or u != v").distinct()


def near_duplicates(rows: DataFrame, size: int = SHINGLE, percent: int = PERCENT, uid: str | None = None) -> DataFrame:
    """Components of near duplicates of ``rows`` (doc_id, text, and a column with a unique id where ``uid`` names one).

    Returns uid, doc_id, n_shingles, component_id (smallest doc_id that is
    reachable over links) and stays (true for exactly one row of each component:
    that of the smallest doc_id, of repeated rows the first).

    Null and empty texts and texts without words have an empty set and are
    linked with nothing. Rows with equal sets are always linked. A null doc_id
    counts as the largest; component_id is null only where all are. Other columns
    are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = (F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid")
    #: Leads back from a representative to its row, without a second numbering of the rows.
    row_key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("rk")
    describe = F.arrow_udf(lambda t: described(t, size), "struct<n bigint, key binary, sig array<int>>")
    docs = rows.select(own, F.col("doc_id").cast("long").alias("doc_id"), row_key, describe(text).alias("d")).select("uid", "doc_id", "rk", "d.n", F.when(F.col("d.n") > 0, F.col("d.key")).otherwise(F.concat(F.lit("none "), F.col("uid").cast("string")).cast("binary")).alias("key"), "d.sig")
    docs = stage(docs, "op7-docs")
    order = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1).cast("long"))
    classes = stage(
        docs.filter("n > 0").groupBy("key").agg(F.min("uid").alias("rep"), F.min("rk").alias("rk"), F.min("doc_id").alias("low"), F.min_by("uid", order).alias("low_uid"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "op7-classes",
    )
    clusters = connected_components(_candidates(classes, agreements(percent)), "op7-clusters")
    links = stage(_links(rows.select(row_key, text.alias("text")), classes, clusters, size, percent), "op7-links")
    components = connected_components(links, "op7-components")
    grouped = classes.select("key", "rep", "low", "low_uid", "rows").join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    low_order = F.coalesce(F.col("low"), F.lit(2**63 - 1).cast("long"))
    # Only classes of several rows and linked classes need an answer from others.
    several = stage(grouped.filter("rows > 1 or root != rep").select("root").distinct(), "op7-several")
    grouped = grouped.join(several, "root", "left_semi")
    low = stage(grouped.groupBy("root").agg(F.min("low").alias("component_id"), F.min_by("low_uid", low_order).alias("first_uid")), "op7-low")
    answer = stage(grouped.select("key", "root").join(low, "root").select("key", "component_id", "first_uid"), "op7-answer")
    found = docs.select("uid", "doc_id", "n", "key").join(answer, "key", "left")
    alone = F.col("first_uid").isNull()
    return found.select("uid", "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (alone | (F.col("uid") == F.col("first_uid"))).alias("stays"))


def _candidates(classes: DataFrame, least: int) -> DataFrame:
    """Edges (u, v) of a spanning forest of the pairs with at least ``least`` agreements."""
    key = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    posts = classes.select("rep", F.posexplode("sig").alias("pos", "value")).select("rep", key.alias("group"))
    shared = stage(posts.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "op7-shared")
    known = stage(posts.join(shared, "group"), "op7-known")
    # At most K posts of a representative, the rarest first.
    ordered = known.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "group"))).alias("posts")).filter(F.size("posts") >= least)
    posted = stage(ordered.select("rep", F.explode(F.slice("posts", F.lit(1), F.size("posts") - (least - 1))).alias("p")).select("rep", "p.group"), "op7-posted")
    lists = stage(posted.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("group", F.ceil(F.col("n") / LIST_BLOCK).cast("long").alias("blocks")), "op7-lists")
    member = stage(posted.join(lists, "group"), "op7-posts")
    members = stage(member.join(classes.select("rep", "sig"), "rep").select("group", "blocks", "rep", "sig"), "op7-lists-of-signatures")
    return forest_of(members, "sig", lambda batches: match_edges(batches, least), "op7-match")


def _links(texts: DataFrame, classes: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (u, v) of a spanning forest of the confirmed links within each cluster."""
    member = stage(clusters.join(classes.select(F.col("rep").alias("node"), "rk", "key", "n"), "node").select(F.col("node").alias("rep"), F.col("root").alias("group"), "rk", "key", "n"), "op7-members")
    held = member.groupBy("group").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / CLUSTER_BLOCK), F.ceil(F.col("shingles") / CLUSTER_SHINGLES)).cast("long")
    held = stage(held.select("group", blocks.alias("blocks")), "op7-held")
    placed = stage(member.join(held, "group"), "op7-placed")
    # Most documents are in no cluster; a bitmap of fixed size keeps their texts from the shuffle.
    mine = texts.filter(within_bitmap(placed, "rk", F.col("rk")))
    sets = F.arrow_udf(lambda t: _digest_and_set(t, size), "struct<key binary, set binary>").asNondeterministic()
    found = mine.join(placed.withColumnRenamed("key", "own"), "rk").select("rep", "group", "blocks", "own", sets("text").alias("s")).filter(F.col("s.key") == F.col("own"))
    members = stage(found.select("group", "blocks", "rep", F.col("s.set").alias("set")).dropDuplicates(["group", "rep"]), "op7-sets")
    return forest_of(members, "set", lambda batches: link_edges(batches, percent), "op7-link").filter("u != v").distinct()


def _digest_and_set(texts: pa.Array, size: int) -> pa.Array:
    own = list(shingle_sets(texts, size))
    return pa.StructArray.from_arrays([pa.array([digest(x) for x in own], pa.binary()), pa.array([x.astype("<u8").tobytes() for x in own], pa.binary())], ["key", "set"])


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row that stays, unchanged."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*[docs[c] for c in docs.columns]).alias("row")), "near-rows")
    gone = stage(near_duplicates(rows.select("uid", "row.doc_id", "row.text"), size, percent, uid="uid").filter(~F.col("stays")).select("uid"), "near-gone")
    maybe = rows.withColumn("maybe", within_bitmap(gone, "uid", F.col("uid")))
    maybe = maybe.select("uid", "row", "maybe")
    kept = maybe.filter(~F.col("maybe")).select("row")
    return kept.unionByName(maybe.filter("maybe").join(gone, "uid", "left_anti").select("row")).select("row.*")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


#: All links by counting shared shingles, and the reachable rows by following them. Equal sets are one node.
OP7_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i + 1 : i + {SHINGLE}], ' ')) END)) AS ss FROM d),
c AS (SELECT any_value(ss) AS ss, min(rid) AS node, min(doc_id) AS low FROM s WHERE len(ss) > 0 GROUP BY md5(array_to_string(ss, chr(10)))),
p AS (SELECT node, len(ss) AS n, unnest(ss) AS g FROM c),
hot AS (SELECT g FROM p GROUP BY g HAVING count(*) > 1),
q AS (SELECT p.* FROM p JOIN hot USING (g)),
link AS (SELECT a.node AS u, b.node AS v FROM q a JOIN q b ON a.g = b.g AND a.node < b.node AND 100 * a.n >= {PERCENT} * b.n AND 100 * b.n >= {PERCENT} * a.n
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT node AS u, node AS v FROM c UNION SELECT reach.u, edge.v FROM reach JOIN edge ON reach.v = edge.u),
low AS (SELECT reach.u AS node, min(c.low) AS low FROM reach JOIN c ON c.node = reach.v GROUP BY reach.u)
SELECT s.doc_id, CAST(len(s.ss) AS BIGINT) AS n_shingles, coalesce(low.low, s.doc_id) AS component_id, s.doc_id = coalesce(low.low, s.doc_id) AS kept
FROM s LEFT JOIN c ON len(s.ss) > 0 AND md5(array_to_string(s.ss, chr(10))) = md5(array_to_string(c.ss, chr(10))) LEFT JOIN low ON low.node = c.node
"""

QUERIES = {"op7_near_dedup": op7_near_dedup}
ORACLE = {"op7_near_dedup": OP7_SQL}
