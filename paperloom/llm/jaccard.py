"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document is its set of word n-grams. Documents with equal sets form a class, named by a hash of
the set; its least document stands for it. Each class has a MinHash label of MAX_DEPTH hashes in each
of TREES trees. The labels are sorted over the whole cluster, which lays out every tree as a prefix
trie: the classes below a trie node are neighbours, and the longest prefix that a class shares with
any other is the one it shares with the class before or after it. A class matches at the longest
prefix it shares, shortened hash by hash, for all classes alike, until a pair at the threshold is
expected to match in some tree with the target recall. After verification the recall over the pairs
found (each weighed by the inverse of its chance to match) is estimated, and the prefixes are
shortened again while it lies below the target; labels are kept, so no text is read again for that.

The classes below one node are gathered around its least class, the pivot, in which every member has
a match of its own: groups cannot chain. All pairs of a group are verified exactly on their n-gram
sets, big groups in square tiles, so a group of any size is spread over tasks. A pair that meets
around several pivots counts at the least. A tile returns each member's number of links and a
spanning forest instead of its pairs. No candidate is dropped and no partner cap exists.

Sorting is by range of label and class, so a node that holds a third of all classes is cut into
several partitions too; the (at most two) nodes at a partition's borders are put together again by a
small table of two rows a partition. For all documents, only rows of 24 bytes are sorted; texts move
only for classes that matched something.

Defined results: a row for each document and different n-gram set that it has; rows with a null
doc_id take no part; texts without words (null, empty) match nothing and are their own group; a text
with fewer than n words is one n-gram; repeated rows count once; a doc_id with several texts has a row
and links for each; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .words import hashes, mix, release, slices, text_column, words

NGRAM = 3
THRESHOLD = 0.5
TREES = 40
MAX_DEPTH = 6
TARGET_RECALL = 0.99
SEED = 7
#: Classes in a tile; a task verifies two of them at most at a time.
TILE = 512
#: Up to so many matched classes, their ids are broadcast to pick the texts; beyond, they are joined.
BROADCAST_IDS = 2_000_000
_rng = np.random.default_rng(SEED)
MULTIPLY = _rng.integers(1, 1 << 63, TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, TREES * MAX_DEPTH, dtype=np.uint64)
#: A label is two integers: the tree and three hashes of HIGH bits, and three hashes of LOW bits.
HIGH, LOW = 19, 21
#: n-grams hashed at once, times the hashes of a label; fits a processor's cache.
BLOCK = 1 << 15
LINKS = "rep bigint, root bigint, links bigint, pairs bigint, expected double"


def chance(jaccard: float, depth: int, trees: int = TREES) -> float:
    """That a pair shares a prefix of this depth in some tree."""
    return 1.0 - (1.0 - jaccard**depth) ** trees


def prefix_depth(threshold: float, target: float, start: int = MAX_DEPTH) -> int:
    """The longest prefix at which a pair at the threshold matches with the target recall."""
    depth = start
    while depth > 1 and chance(threshold, depth) < target:
        depth -= 1
    return depth


def ngram_sets(text: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, in order."""
    offsets, at, distinct = words(text)
    ids = hashes(distinct)[at] if len(distinct) else np.zeros(0, np.uint64)
    full = np.zeros(len(ids), np.uint64)
    m = len(ids) - n + 1
    if m > 0:
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = mix(h + ids[k : k + m])
        full[:m] = h
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= n:
            s = full[a : b - n + 1].copy()
            s.sort()
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                h = mix(h + ids[k : k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def labels(s: np.ndarray) -> np.ndarray:
    """The label of a set in each tree, trees x 2."""
    least = np.full(TREES * MAX_DEPTH, np.iinfo(np.uint64).max, np.uint64)
    step = BLOCK // len(least)
    for at in range(0, len(s), step):
        np.minimum(least, (s[at : at + step, None] * MULTIPLY + ADD).min(axis=0), out=least)
    h = mix(least).reshape(TREES, MAX_DEPTH)
    out = np.zeros((TREES, 2), np.uint64)
    out[:, 0] = np.arange(TREES)
    for k in range(MAX_DEPTH):
        bits = np.uint64(HIGH if k < 3 else LOW)
        out[:, k // 3] = out[:, k // 3] << bits | h[:, k] >> (np.uint64(64) - bits)
    return out.view(np.int64)


def prefixes(hi: np.ndarray, lo: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``depth`` hashes of each label (the tree before them)."""
    if depth <= 3:
        return hi >> (HIGH * (3 - depth)), np.zeros_like(lo)
    return hi, lo >> (LOW * (MAX_DEPTH - depth))


def shared(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Hashes that each label of a sorted list shares with the one before it; -1 where there is none or the tree differs."""
    out = np.full(len(hi), -1, np.int64)
    for depth in range(MAX_DEPTH + 1):
        a, b = prefixes(hi, lo, depth)
        out[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])] = depth
    return out


def name_of(s: np.ndarray) -> int:
    """The 64-bit name of a class."""
    return int.from_bytes(xxhash.xxh3_64_digest(s.tobytes()), "big", signed=True)


def named(docs: DataFrame) -> DataFrame:
    """doc_id, rep (the name of its class, null without words) and labels of each document."""
    pair = pa.struct([("hi", pa.int64()), ("lo", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = ngram_sets(text_column(part))
                names = [name_of(s) if len(s) else None for s in sets]
                made = [labels(s) for s in sets if len(s)]
                flat = np.concatenate(made) if made else np.zeros((0, 2), np.int64)
                ends = np.concatenate([[0], np.cumsum([TREES * (len(s) > 0) for s in sets])])
                values = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(pair))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc_id", "rep", "labels"])
            release()

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id bigint, rep bigint, labels array<struct<hi:bigint,lo:bigint>>")


def nodes(leaves: DataFrame, depth: int, parts: int) -> DataFrame:
    """(pivot, rep) of the leaves (hi, lo, rep) below each trie node of this depth that holds several classes.

    A partition holds an equal share of the sorted leaves, so it is handled as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if not parts:
            return
        hi, lo, rep = map(np.concatenate, zip(*parts, strict=True))
        begin = np.flatnonzero(shared(hi, lo) < depth)
        size = np.diff(np.concatenate([begin, [len(rep)]]))
        border = np.zeros(len(begin), bool)  # these may go on in the partition before or after
        border[[0, -1]] = True
        keep = np.repeat((size > 1) | border, size)
        pivot = np.repeat(np.minimum.reduceat(rep, begin), size)[keep]
        open_ = pa.array(~np.repeat(border, size)[keep])
        a, b = prefixes(hi[keep], lo[keep], depth)
        yield pa.RecordBatch.from_arrays([pa.array(pivot), pa.array(rep[keep]), pa.array(a, mask=np.asarray(open_)), pa.array(b, mask=np.asarray(open_))], names=["pivot", "rep", "hi", "lo"])

    leaves = leaves.repartitionByRange(parts, "hi", "lo", "rep").sortWithinPartitions("hi", "lo", "rep")
    found = checkpointed(leaves.mapInArrow(run, "pivot bigint, rep bigint, hi bigint, lo bigint").distinct())
    # at most two nodes a partition
    borders = found.filter("hi IS NOT NULL").groupBy("hi", "lo").agg(F.min("pivot").alias("least"), F.count(F.lit(1)).alias("n"))
    whole = found.join(F.broadcast(borders), ["hi", "lo"], "left").filter("hi IS NULL OR n > 1")
    return whole.select(F.coalesce("least", "pivot").alias("pivot"), "rep").distinct()


def tiles(around: DataFrame, tile: int) -> DataFrame:
    """rep, the pivots below which it lies and the tiles (pivot, i, j) in which it is verified."""
    n = around.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("blocks"))
    placed = around.join(n, "pivot").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = placed.withColumn("with", other).select("rep", F.struct("pivot", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own").alias("tile"))
    return spread.groupBy("rep").agg(F.collect_list("tile").alias("tiles"))


def counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections."""
    n = len(sets)
    out = np.zeros((n, n), np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner = owner[shared]
    column = np.unique(column[shared], return_inverse=True)[1]
    if not len(column):
        return out
    ends = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + 4096, 4096))
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        m = np.zeros((n, 4096), np.float32)
        m[owner[a:b], column[a:b] - 4096 * k] = 1
        out += m @ m.T
    return out


def verified(group: list[tuple], sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the tile and similarities of its pairs at or above the threshold that no lesser pivot has.

    A member is (rep, pivot, i, j, own, all its pivots, its documents).
    """
    n = len(group)
    pivot, i, j = group[0][1:4]
    size = np.array([len(s) for s in sets], np.float64)
    if n == 2:
        both = float(len(np.intersect1d(sets[0], sets[1], assume_unique=True)))
        common = np.array([[size[0], both], [both, size[1]]])
    else:
        common = counts(sets)
    jac = common / np.maximum(size[:, None] + size[None, :] - common, 1)
    a, b = np.nonzero(np.triu(jac >= threshold, 1))
    if i != j and len(a):
        own = np.array([g[4] for g in group])
        cross = own[a] != own[b]
        a, b = a[cross], b[cross]
    lesser: dict[int, int] = {}
    at = [(k, lesser.setdefault(p, len(lesser))) for k, g in enumerate(group) for p in g[5] if p < pivot]
    if at and len(a):
        m = np.zeros((n, len(lesser)), np.float32)
        rows, cols = zip(*at, strict=True)
        m[list(rows), list(cols)] = 1
        mine = (m @ m.T)[a, b] == 0
        a, b = a[mine], b[mine]
    return a, b, jac[a, b]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(group: list[tuple], sets: list[np.ndarray], threshold: float, depth: int) -> list[tuple]:
    """A row of LINKS for each member of a tile that has a link there; the tile's sums lie in the first."""
    a, b, jac = verified(group, sets, threshold)
    if not len(a):
        return []
    documents = np.array([g[6] for g in group], np.float64)
    links = np.bincount(a, documents[b], len(group)) + np.bincount(b, documents[a], len(group))
    root = forest(len(group), a, b)
    out = [(group[k][0], group[root[k]][0], int(links[k]), 0, 0.0) for k in np.flatnonzero(links).tolist()]
    out[0] = (*out[0][:3], len(a), float((1.0 / (1.0 - (1.0 - jac**depth) ** TREES)).sum()))
    return out


def rep_links(docs: DataFrame, reps: DataFrame, around: DataFrame, threshold: float, depth: int, tile: int = TILE) -> DataFrame:
    """Rows of LINKS for all classes (rep, lead, documents) that match and reach the threshold."""
    placed = checkpointed(tiles(around, tile).join(reps, "rep").withColumnRenamed("lead", "doc_id"))
    ids = placed.select("doc_id")
    if placed.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").distinct()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = texts.join(placed, "doc_id").select("rep", "documents", "text", F.explode("tiles").alias("tile"), F.transform("tiles", lambda t: t["pivot"]).alias("pivots"))
    moved = moved.select("rep", F.col("tile.pivot").alias("pivot"), F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), F.col("tile.own").alias("own"), "pivots", "documents", "text")
    sorted_rows = moved.repartition(parts, "pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_sets: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                sets = ngram_sets(text_column(part))
                for row, s in zip(zip(*[part.column(k).to_pylist() for k in range(7)], strict=True), sets, strict=True):
                    if not len(s) or name_of(s) != row[0]:
                        continue  # another text of the same document
                    if held and held[0][1:4] != row[1:4]:
                        if len(held) > 1:
                            out += linked(held, held_sets, threshold, depth)
                        held, held_sets = [], []
                    if held and held[-1][0] == row[0]:
                        continue  # another text with the same set
                    held.append(row)
                    held_sets.append(s)
                yield _links(out)
        if len(held) > 1:
            yield _links(linked(held, held_sets, threshold, depth))

    return sorted_rows.mapInArrow(run, LINKS)


def _links(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((*[pa.int64()] * 4, pa.float64()))], names=[c.split()[0] for c in LINKS.split(", ")])


def matched(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL, tile: int = TILE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (doc_id, rep), classes (rep, lead, documents) and LINKS, at the first depth that reaches the target."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = checkpointed(named(docs))
    members = made.select("doc_id", "rep").distinct()
    real = made.filter("rep IS NOT NULL")
    reps = members.filter("rep IS NOT NULL").groupBy("rep").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("documents"))
    leaves = real.groupBy("rep").agg(F.first("labels").alias("labels")).select("rep", F.inline("labels")).select("hi", "lo", "rep")
    depth = prefix_depth(threshold, target)
    while True:
        links = checkpointed(rep_links(docs, reps, checkpointed(nodes(leaves, depth, parts)), threshold, depth, tile))
        found = links.agg(F.sum("pairs").alias("n"), F.sum("expected").alias("expected")).first()
        if depth == 1 or not found["n"] or found["n"] >= target * found["expected"]:
            return members, reps, links
        depth -= 1


def grouped(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, rep), and rep, class_id and n_links for the classes that have any link.

    class_id is the least doc_id of a connected component of links, n_links a document's number of links.
    """
    members, reps, links = matched(docs, threshold, target)
    edges = links.filter("root <> rep").select(F.col("root").alias("a"), F.col("rep").alias("b"))
    sums = links.groupBy("rep").agg(F.sum("links").alias("links"))
    per = reps.join(sums, "rep", "left").join(components(edges), F.col("rep") == F.col("node"), "left").filter("links IS NOT NULL OR documents > 1")
    per = checkpointed(per.select("rep", "lead", F.coalesce("label", "rep").alias("grp"), (F.coalesce("links", F.lit(0)) + F.col("documents") - 1).alias("n_links")))
    least = per.groupBy("grp").agg(F.min("lead").alias("class_id"))
    return members, checkpointed(per.join(least, "grp").select("rep", "class_id", "n_links"))


def joined(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id and n_links of every document.

    n_links counts the other documents (copies of this one and of others as well) at or above the
    threshold; class_id is the least doc_id that is connected by links, its own without any.
    """
    members, per = grouped(docs, threshold, target)
    if per.count() <= BROADCAST_IDS:
        per = F.broadcast(per)
    return members.join(per, "rep", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, least node of its component) for every node of the pairs, by repeated hooking and jumping."""
    edges = checkpointed(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("hook"), "label")
        jump = hooked.select(F.col("node").alias("hook"), F.col("hook").alias("to"))
        new = checkpointed(hooked.join(jump, "hook", "left").select("node", F.least("hook", F.coalesce("to", "hook")).alias("label"), (F.least("hook", F.coalesce("to", "hook")) != F.col("label")).alias("moved")))
        if not new.filter("moved").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")


def thinned(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """The documents without near duplicates: of each group the one with the least doc_id stays.

    Groups are the connected components of the pairs. Repeated rows of a doc_id that stays all stay,
    as do rows with a null doc_id and texts without words.
    """
    members, per = grouped(docs, threshold, target)
    if per.count() <= BROADCAST_IDS:
        per = F.broadcast(per)
    gone = checkpointed(members.join(per, "rep").filter("doc_id <> class_id").select("doc_id").distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def sql_links(source: str, threshold: float = THRESHOLD, n: int = NGRAM) -> str:
    """DuckDB SQL of :func:`joined`, exact, by an inverted index."""
    edge = "'^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$'"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> ''),
    lambda x: CASE WHEN regexp_replace(x, {edge}, '', 'g') = '' THEN x ELSE regexp_replace(x, {edge}, '', 'g') END) AS ws
  FROM {source} WHERE doc_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {n} THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n - 1}], ' ')) END)) AS s FROM w),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN c x ON x.doc_id = p.a JOIN c y ON y.doc_id = p.b WHERE k::DOUBLE / (x.n + y.n - k)::DOUBLE >= {threshold}),
d AS (SELECT DISTINCT doc_id FROM {source} WHERE doc_id IS NOT NULL),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS class_id FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)
SELECT m.doc_id, m.class_id, coalesce(n.n_links, 0)::BIGINT AS n_links FROM m LEFT JOIN n ON n.a = m.doc_id"""
