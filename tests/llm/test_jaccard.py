import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from paperloom.llm import jaccard
from paperloom.llm.words import trimmed


def grams(text, n=jaccard.NGRAM):
    w = [trimmed(x) for x in (text or "").lower().split()]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=jaccard.THRESHOLD):
    best = {}
    for a, x in rows:
        for b, y in rows:
            if a is not None and b is not None and a < b:
                s, t = grams(x), grams(y)
                if s and t and len(s & t) / len(s | t) >= threshold:
                    best[a, b] = max(best.get((a, b), 0), len(s & t) / len(s | t))
    return best


def corpus(rng, originals=12, copies=8):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(originals):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        for _ in range(copies):
            copy = [rng.choice(words) if rng.random() < 0.04 else w for w in base]
            rows.append(" ".join(copy))
    return list(enumerate(rows))


def stars(ids, links):
    """doc_id -> least connected doc_id."""
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {d: root(d) for d in ids}


def wanted(rows, links=None):
    """The rows of ``joined`` by brute force, where each doc_id has one text."""
    links = brute(rows) if links is None else links
    n = Counter(x for pair in links for x in pair)
    group = stars([d for d, _ in rows if d is not None], links)
    return {(d, g, n[d]) for d, g in group.items()}


@pytest.mark.parametrize("tile", [3, jaccard.TILE])
def test_recall_and_exactness(make, tile):
    rows = corpus(random.Random(5))
    members, reps, links = jaccard.matched(make(rows), tile=tile)
    size = {r["rep"]: r["documents"] for r in reps.collect()}
    of = {r["doc_id"]: r["rep"] for r in members.collect()}
    assert Counter(of.values()) == size and len(of) == len(rows)
    found = Counter()
    for r in links.collect():
        found[r["rep"]] += r["links"]
    n = Counter({d: found[rep] + size[rep] - 1 for d, rep in of.items()})
    want = brute(rows)
    exact = Counter(x for pair in want for x in pair)
    assert all(n[d] <= exact[d] for d in n)  # no false link
    assert sum(n.values()) >= 0.98 * sum(exact.values()) and len(want) > 100


def test_edges(make):
    rows = [(1, "a b c d"), (2, "A, b c. d!"), (3, None), (4, ""), (5, ""), (6, "one"), (7, "one"), (8, "two words"), (None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (13, "long " * 30000), (14, "long " * 30001)]
    docs = make(rows).withColumnRenamed("lang", "rep").withColumnRenamed("source", "class_id")
    got = jaccard.joined(docs).collect()
    assert {tuple(r) for r in got} == wanted(rows) and len(got) == len({d for d, _ in rows} - {None})
    assert jaccard.joined(docs.filter("doc_id > 99")).collect() == []


def test_several_texts_of_one_document(make):
    rows = [(10, "x y z q"), (10, "p o i u"), (10, "P o i, u"), (11, "p o i u"), (12, "x y z q"), (13, "other words in here")]
    got = sorted(tuple(r) for r in jaccard.joined(make(rows)).collect())
    assert got == [(10, 10, 1), (10, 10, 1), (11, 10, 1), (12, 10, 1), (13, 13, 0)]


def test_labels_sorted_are_a_trie(spark):
    rng = random.Random(8)
    # few values a hash, so that long prefixes are shared; the first hash is the same for most
    leaf = lambda: [0, *(rng.choice((0, 0, 1, 2)) for _ in range(jaccard.MAX_DEPTH))]
    rows = [(leaf(), rep) for rep in range(400)] + [([1, *r[1:]], rep) for rep in range(400, 420) for r in [leaf()]]
    packed = [((t[0] << 57) | (t[1] << 38) | (t[2] << 19) | t[3], (t[4] << 42) | (t[5] << 21) | t[6], rep) for t, rep in rows]
    common = lambda x, y: next((k for k in range(7) if x[k] != y[k]), 7) - 1
    order = sorted(range(len(rows)), key=lambda i: packed[i])
    hi, lo = (np.array([packed[i][k] for i in order], np.int64) for k in range(2))
    before = jaccard.shared(hi, lo)
    assert before[0] == -1 and before[1:].tolist() == [common(rows[i][0], rows[j][0]) for i, j in zip(order, order[1:])]
    longest = [max(max(common(rows[i][0], x) for j, (x, _) in enumerate(rows) if j != i), -1) for i in order]
    assert np.maximum(before, np.append(before[1:], -1)).tolist() == longest
    leaves = spark.createDataFrame(packed, "hi bigint, lo bigint, rep bigint").repartition(3)
    for depth in range(1, jaccard.MAX_DEPTH + 1):
        below = {}
        for t, rep in rows:
            below.setdefault(tuple(t[: depth + 1]), set()).add(rep)
        want = {(min(s), rep) for s in below.values() if len(s) > 1 for rep in s}
        for parts in (1, 7, 50):  # nodes far bigger than a partition
            got = jaccard.nodes(leaves, depth, parts).collect()
            assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_prefixes_shorten_until_the_recall(make, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 999)}" for _ in range(60)]
    rows = [(i, " ".join(rng.choice("xyz") + str(i) if rng.random() < 0.05 else w for w in base)) for i in range(30)]
    tried = []
    nodes = jaccard.nodes
    monkeypatch.setattr(jaccard, "prefix_depth", lambda threshold, target: jaccard.MAX_DEPTH)
    monkeypatch.setattr(jaccard, "nodes", lambda leaves, depth, parts: tried.append(depth) or nodes(leaves, depth, parts))
    links = jaccard.matched(make(rows))[2].agg({"pairs": "sum"}).first()[0]
    assert len(tried) > 1 and tried == list(range(jaccard.MAX_DEPTH, tried[-1] - 1, -1))
    assert links >= 0.95 * len(brute(rows)) > 50


def test_one_of_each_group_stays(make):
    rng = random.Random(6)
    rows = corpus(rng, 6, 5)
    rows += [(100, rows[0][1]), (101, None), (102, ""), (None, rows[0][1]), (103, "quite another text here")]
    kept = {r["doc_id"] for r in jaccard.thinned(make(rows)).collect()}
    assert kept == set(stars([d for d, _ in rows if d is not None], brute(rows)).values()) | {None}
    assert jaccard.thinned(make(rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1, 0.9) for i in range(40)] + [(100, 101, 0.8)], "a bigint, b bigint, jaccard double")
    assert {r["node"]: r["label"] for r in jaccard.components(pairs).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_depth():
    assert jaccard.prefix_depth(0.9, 0.99) > jaccard.prefix_depth(0.5, 0.99) >= 1
    d = jaccard.prefix_depth(0.5, 0.99)
    assert jaccard.chance(0.5, d) >= 0.99 and jaccard.chance(0.5, d + 1) < 0.99


def test_sets():
    a, b = jaccard.ngram_sets(pa.array(["a b c d a b c", "c d e"]))
    assert len(a) == 4 and len(b) == 1
