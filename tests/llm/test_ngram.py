import math
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import ngram
from paperloom.llm.eliasfano import EliasFano, read, write
from paperloom.llm.words import trimmed


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**50)), st.integers(0, 2**20), st.data())
def test_elias_fano(values, slack, data):
    v = np.sort(np.array(values, np.uint64))
    u = (int(v[-1]) if len(v) else 0) + 1 + slack
    e = EliasFano.build(v, u)
    assert e.access(np.arange(len(v))).tolist() == v.tolist()
    q = np.array([*values, *data.draw(st.lists(st.integers(0, u - 1))), 0, u - 1], np.uint64)
    at, value = e.successor(q)
    want = np.searchsorted(v, q)
    assert at.tolist() == want.tolist()
    assert all(int(x) == (int(v[i]) if i < len(v) else u) for i, x in zip(want, value))
    found = e.find(q)
    assert all((i == -1 and x not in v) or v[i] == x for i, x in zip(found, q))


def test_crowded_range():
    v = np.concatenate([np.arange(5000, dtype=np.uint64), np.array([2**45, 2**46], np.uint64)])
    e = EliasFano.build(v)
    assert e.find(v).tolist() == list(range(len(v)))
    assert e.nbytes() * 8 < 64 * len(v)


def test_long_runs():
    """Select after long runs of ones and of zeros."""
    rng = np.random.default_rng(3)
    v = np.sort(np.concatenate([rng.integers(2**30, 2**30 + 90, 20_000), rng.integers(0, 2**40, 900), rng.integers(2**39, 2**39 + 10**6, 5000)]).astype(np.uint64))
    e = EliasFano.build(v)
    assert (e.access(np.arange(len(v))) == v).all()
    bits = np.unpackbits(e.high.view(np.uint8), bitorder="little")
    assert (e.select0(np.arange(e.universe >> e.width)) == np.flatnonzero(bits == 0)[: e.universe >> e.width]).all()
    assert (v[e.find(v)] == v).all() and (e.find(v) == np.searchsorted(v, v)).all()


def test_files(tmp_path):
    e = EliasFano.build(np.array([3, 3, 9], np.uint64))
    write(str(tmp_path / "x"), e.parts("a") | {"q": np.array([1, 2], np.uint8), "none": np.zeros(0, np.int64)})
    back = read(str(tmp_path / "x"))
    assert EliasFano.of(back, "a").access(np.arange(3)).tolist() == [3, 3, 9] and back["q"].tolist() == [1, 2] and not len(back["none"])


def q(p, steps):
    return 2.0 ** -(min(255, round(-math.log2(min(p, 1.0)) * steps)) / steps)


def brute(texts):
    """The model by dictionaries; scores of all texts."""
    seqs = [["<s>", *[trimmed(w) for w in (t or "").lower().split()], "</s>", "<p>"] for t in texts]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for s in seqs:
        c1.update(s)
        for i in range(len(s) - 2):
            c2[tuple(s[i : i + 2])] += 1
            c3[tuple(s[i : i + 3])] += 1
    words = [w for w in c1 if w not in ("<s>", "<p>")]
    total, d = sum(c1[w] for w in words), ngram.DISCOUNT
    unknown = d * len(words) / total / (len(words) + 1)
    p1 = {w: q((c1[w] - d) / total + unknown, ngram.STEPS_P) for w in words}
    kept2 = {k: (n - d) / c1[k[0]] for k, n in c2.items()}
    followed = Counter()
    for k, n in c3.items():
        if k[2] != "<p>":
            followed[k[:2]] += n
    kept3 = {k: (n - d) / followed[k[:2]] for k, n in c3.items() if k[2] != "<p>"}
    g1, g2 = Counter(), Counter()
    for k, x in kept2.items():
        g1[k[0]] += x
    for k, x in kept3.items():
        g2[k[:2]] += x
    out = []
    for s in seqs:
        lp = 0.0
        for i in range(1, len(s) - 1):
            u, v, w = s[i - 2] if i > 1 else None, s[i - 1], s[i]
            p = q(kept2[v, w], ngram.STEPS_P) if (v, w) in kept2 else 0.0
            p += q(max(1 - g1[v], 2.0**-15), ngram.STEPS_G) * p1[w]
            if u is not None and (u, v) in kept2:
                p = p * q(1 - g2[u, v], ngram.STEPS_G) + (q(kept3[u, v, w], ngram.STEPS_P) if (u, v, w) in kept3 else 0.0)
            lp += math.log2(p)
        out.append((len(s) - 2, lp))
    return out


def test_scores_equal_brute_force(make):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", ","]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", "The end.", "the end", texts[0], "x " * 20000]
    docs = make(texts)
    got = {r["doc_id"]: (r["n_tokens"], r["log2_probability"]) for r in ngram.scored(docs, ngram.trained(docs)).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    for i, (n, lp) in enumerate(want):
        assert got[i][0] == n
        assert abs(got[i][1] - lp) <= 1e-6 * max(1, abs(lp)), (i, got[i], lp)


def test_trigrams_of_a_slice():
    import pyarrow as pa

    texts = ["a b a b a b", "", "a b c", "a b a"]
    s = ngram.Sequences.of(pa.array(texts))
    want = Counter()
    for t in texts:
        w = ["<s>", *t.split(), "</s>", "<p>"]
        want.update(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    small = sorted(zip(*(x.tolist() for x in s.trigrams())))
    assert sorted(n for *_, n in small) == sorted(want.values())
    s.ids = np.concatenate([s.ids, np.zeros(1 << 21, np.uint32)])  # too many words for one integer
    assert sorted(zip(*(x.tolist() for x in s.trigrams()))) == small


def test_many_shards_and_groups_of_them(make, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts += ["the same line"] * 30  # a hot context
    docs = make(texts)
    for size, most, split in ((400, 1024, 2_000_000), (150, 4, 1)):
        monkeypatch.setattr(ngram, "SHARD_BYTES", size)
        monkeypatch.setattr(ngram, "WORD_SHARD_BYTES", 2 * size)
        monkeypatch.setattr(ngram, "MAX_BLOCKS", most)
        monkeypatch.setattr(ngram, "SPLIT", split)
        model = ngram.trained(docs)
        assert model.shards > 10 and (model.shards > most) == (most == 4)
        got = {r["doc_id"]: r["log2_probability"] for r in ngram.scored(docs, model).collect()}
        for i, (_, lp) in enumerate(brute(texts)):
            assert abs(got[i] - lp) <= 1e-6 * max(1, abs(lp)), i


def test_empty_table_and_extra_columns(make):
    docs = make([(1, "a b")]).filter("doc_id = 9")
    assert ngram.scored(docs, ngram.trained(docs)).collect() == []
    docs = make([(None, "a b a b"), (2, "a b")]).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "shard")
    assert sorted(r["n_tokens"] for r in ngram.scored(docs, ngram.trained(docs)).collect()) == [3, 5]


def test_counts_of_one_are_in_the_model(make):
    texts = ["the plain page of the set"] * 3 + ["a rare topic seen in the plain park", "the set of a rare kind"]
    docs = make(texts)
    rows = {r["doc_id"]: r["log2_probability"] for r in ngram.scored(docs, ngram.trained(docs)).collect()}
    assert all(abs(rows[i] - lp) < 1e-6 for i, lp in enumerate(x for _, x in brute(texts)))
