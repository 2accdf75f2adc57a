"""Quality rules, source mixing, the pipeline, and all queries against DuckDB."""

import math
import random
from collections import Counter

import oracle
import pytest

import corpus_pipeline
from paperloom.llm import jaccard, mixing, quality, queries, secrets

SF = "/root/testdata/sf0.001"
PROSE = "The thonti of and ination was in the ereat, for it is on the enty and with that. " * 3
JUNK = ["", None, "  \n ", "SHOUT!! SHOUT!! LOUD!! WORDS!! EVER!! MORE!!", "a### b### c### d$$$ e### f###", "word " * 60, "same line of text here\n" * 9, "thonti | ination | ereat | enty | andor | thwh | erin | wher | onti | oreat"]


def test_quality(make):
    docs = make([PROSE, *JUNK, "Short.", PROSE]).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "q_metrics")
    assert sorted(r["doc_id"] for r in quality.kept(docs).collect()) == [0, len(JUNK) + 1, len(JUNK) + 2]
    assert quality.kept(docs).columns == docs.columns
    judged = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert len(judged) == len(JUNK) + 3 and all(judged[i + 1]["broken"] for i in range(len(JUNK)))
    assert judged[0]["keep"] and judged[2]["n_words"] == 0
    assert quality.kept(docs.filter("doc_id < 0")).collect() == []


def test_metrics_are_computed_once(spark, make):
    for df in (quality.measured(make([PROSE])), quality.kept(make([PROSE]))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_distinct") == 4 and plan.count("Generate") == 1, plan
    clashing = make([PROSE, *JUNK]).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "m")
    got = quality.measured(clashing)
    assert got.columns[:7] == [*clashing.columns, "n_words_", "mean_word_length"]
    assert [(r["doc_id"], r["n_words"], r["m"]) for r in got.collect()] == [(0, "en", "s0")]
    assert quality.measured(clashing.filter("doc_id < 0")).collect() == []


def test_long_clean_texts_stay(make):
    rng = random.Random(7)
    clean = " ".join(f"w{rng.randint(0, 19_999):x}" if rng.random() < 0.6 else rng.choice(["the", "of"]) for _ in range(300_000))
    small = " ".join(rng.choice(PROSE.lower().split()) for _ in range(150_000))
    passage = " ".join(clean.split()[:12_000])  # varied in each window, but over and over
    rows = {r["doc_id"]: r for r in quality.judged(make([clean, small, " ".join([passage] * 30)])).collect()}
    assert all(r["distinct_ratio"] < 0.2 for r in rows.values())
    assert [rows[i]["broken"] for i in range(3)] == ["", "word_variety", "word_variety"]


def poisson(u, rate):
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u and k < mixing.TERMS:
        k += 1
        p = p * rate / k
        c += p
    return k


def test_mixing_equals_inversion(spark, make):
    import hashlib

    rows = [(i, "x" * (1 + i % 7)) for i in range(600)]
    docs = make(rows).withColumnRenamed("lang", "mix_no")
    weights = {"s0": 0.6, "s1": 0.4}
    sizes = Counter()
    for i, t in rows:
        sizes[f"s{i % 3}"] += len(t)
    total = sum(sizes.values())
    got = Counter(r["doc_id"] for r in mixing.mixed(docs, weights, epochs=2.0).collect())
    for i, _ in rows:
        s = f"s{i % 3}"
        u = int(hashlib.md5(f"{mixing.SEED}:count:{i}".encode()).hexdigest()[:13], 16) / 2**52
        assert got[i] == poisson(u, weights.get(s, 0) * 2.0 * total / sizes[s]), i
    share = sum(len(rows[i][1]) * n for i, n in got.items() if i % 3 == 0) / sum(len(rows[i][1]) * n for i, n in got.items())
    assert abs(share - 0.6) < 0.06


def test_mixing_edges(make):
    docs = make([(1, None), (2, ""), (None, "abc"), (4, "abc"), (4, "abc"), (5, "z" * 100000)])
    many = mixing.mixed(docs, {"s0": 1.0}, epochs=0.1).count()  # a rate far above MAX_TERM_RATE
    assert 0.9 < many / (2 * 0.1 * 100009 / 3) < 1.1
    n = Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    assert n[4] % 2 == 0
    assert mixing.mixed(docs.filter("doc_id < 0")).collect() == [] and mixing.mixed(docs, {}).collect() == []
    a = [r["mix_order"] for r in mixing.copies(docs, epochs=9.0).collect()]
    assert len(a) == len(set(a)) or n[4] > 0


@pytest.mark.parametrize("name", [n for n in queries.queries() if n in queries.oracle_sql()])
def test_against_duckdb(spark, name):
    assert oracle.differences(spark, queries.queries()[name], queries.oracle_sql()[name], SF) == ""


def test_pipeline(spark, make, tmp_path):
    rng = random.Random(4)
    base = [" ".join(rng.choice(PROSE.lower().split()) + rng.choice("abcdef") * rng.randint(0, 2) for _ in range(80)) for _ in range(25)]
    texts = base + [b.replace(" the ", " tha ", 1) for b in base[:6]] + JUNK + [base[7] + ' token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"']
    make(texts, 3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = [(r["doc_id"], r["text"]) for r in quality.judged(docs).join(docs.select("doc_id", "text"), "doc_id").filter("keep").collect()]
    assert len(good) >= len(base)
    from test_jaccard import brute

    drop = {b for _, b in brute(good)}  # groups here are stars around the least id
    stay = {d: secrets.redact(t) for d, t in good if d not in drop}
    mixed = mixing.mixed(docs.filter(docs["doc_id"].isin(list(stay))).drop("text").join(spark.createDataFrame(list(stay.items()), "doc_id bigint, text string"), "doc_id"))
    want = Counter(r["doc_id"] for r in mixed.collect())
    assert Counter(r["doc_id"] for r in got) == want
    from paperloom.llm.bpe import loaded

    for r in got:
        assert r["exact"] and bytes(loaded().decode(r["token_ids"])).decode() == stay[r["doc_id"]]
    assert not any(b"9f86d081" in bytes(loaded().decode(r["token_ids"])) for r in got)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "source_mixing", "bpe_tokens"]
    assert jaccard.TARGET_RECALL >= 0.9
