"""Operators against small hand-written cases and sequential versions."""

import random

import pytest

from paperloom.operators import dedup, recover, resolve
from paperloom.sources import records
from paperloom.streaming import ingest

COLS = ["openalex_id", "doi", "arxiv_id", "abstract", "title", "url"]
SCHEMA = "id string, " + ", ".join(f"{c} string" for c in COLS)


def fold(stored, incoming, redirects):
    """Record by record, as written down."""
    key = lambda d: d.lower().strip().removeprefix("https://doi.org/") if d else None
    store = {r[0]: dict(zip(["id", *COLS], r)) for r in stored}
    for r in incoming:
        new = dict(zip(["id", *COLS], r))
        hit, winner = None, None
        for n, (c, f) in enumerate((("openalex_id", str), ("doi", key), ("arxiv_id", str))):
            if new[c] and hit is None:
                hit = next((s for s in sorted(store.values(), key=lambda x: x["id"]) if s[c] and f(s[c]) == f(new[c])), None)
            if new[c] and winner is None:
                old = [x for x in redirects if x[n] and f(x[n]) == f(new[c])]
                winner = min(old, key=lambda x: (x[4] is not None, -(x[4] or 0), x[3]))[3] if old else None
        if hit is not None:
            for c in COLS:
                if c not in resolve.GUARDED or new[c]:
                    hit[c] = new[c]
        elif winner is None:
            store[new["id"]] = new
        elif winner in store:
            for c in ("abstract", "url"):
                store[winner][c] = store[winner][c] or new[c]
    return sorted(tuple(s.values()) for s in store.values())


@pytest.mark.parametrize("seed", range(4))
def test_upsert_equals_folding(spark, seed):
    """Random records that meet papers, redirects and one another, on all paths."""
    rng = random.Random(seed)
    few = seed % 2  # few keys: components of different keys; else mostly alone or repeated
    pick = lambda p, n: rng.choice([None, "", *[f"{p}{i}" for i in range(n)]])
    stored = [(f"s{i:02}", f"w{i}", f"10.1/{i}" if i % 2 else None, None, rng.choice([None, "", "old"]), "t", rng.choice([None, "", "u"])) for i in range(8)]
    red = [(pick("W", 4), pick("10.2/", 4), pick("A", 4), rng.choice(["s01", "s02", "s05", "gone"]), rng.choice([None, 1, 2])) for _ in range(8)]
    rows = []
    for i in range(40):
        kind = rng.choice(["paper", "redirect", "new", "again"])
        if few:
            keys = (pick(rng.choice("wW"), 9), pick(rng.choice(["10.1/", "10.2/"]), 7), pick("aA"[i % 2], 5))
        elif kind == "again" and rows:
            keys = rng.choice(rows)[1:4]
        else:
            keys = {"paper": (f"w{rng.randint(0, 7)}", None, None), "redirect": (None, None, f"A{rng.randint(0, 3)}")}.get(kind, (f"n{i}", f"DOI:10.9/{i}", None))
        rows.append((f"t{i:02}", *keys, rng.choice([None, "", f"new{i}"]), f"u{i}", rng.choice([None, "", f"x{i}"])))
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", ord_in int").repartition(3)
    moves = spark.createDataFrame(red, "old_openalex_id string, old_doi string, old_arxiv_id string, new_id string, m int").selectExpr("*", "timestamp_seconds(m) AS merged_at", "concat('o', new_id) AS old_id")
    got = resolve.upsert(spark.createDataFrame(stored, SCHEMA), df, moves, COLS, "ord_in").collect()
    norm = lambda rows: sorted(tuple("" if v is None else v for v in r) for r in rows)
    clean = [(*r[:2], r[2].removeprefix("DOI:") if r[2] else r[2], *r[3:]) for r in rows]
    assert norm(tuple(r) for r in got) == norm(fold(stored, clean, red))


def test_redirected_records_change_nothing_else(spark):
    stored = spark.createDataFrame([("s1", None, None, None, None, None, "kept")], SCHEMA)
    red = spark.sql("SELECT 'gone' AS old_id, 's1' AS new_id, 'WL' AS old_openalex_id, CAST(NULL AS string) AS old_doi, CAST(NULL AS string) AS old_arxiv_id, CAST(NULL AS timestamp) AS merged_at UNION ALL SELECT 'x', 'nowhere', 'WX', NULL, NULL, NULL")
    rows = spark.createDataFrame([("t1", "WL", None, "a9", "text", "Loser title", "u", 1), ("t2", "WX", None, None, "text", "Never made again", "u", 2), ("t3", "WL", None, "a9", "later", "t", "u", 3), ("t4", None, None, None, "free", "No keys", None, 4), ("t5", None, "", None, "free", "No keys", None, 5)], SCHEMA + ", o int")
    got = sorted(tuple(r) for r in resolve.upsert(stored, rows, red, COLS, "o").collect())
    assert got == [("s1", None, None, None, "text", None, "kept"), ("t4", None, None, None, "free", "No keys", None), ("t5", None, None, None, "free", "No keys", None)]
    assert resolve.upsert(stored, rows.limit(0), red, COLS, "o").count() == 1 and resolve.upsert(stored.limit(0), rows, red.limit(0), COLS, "o").count() == 4


def test_resolve_rows(spark):
    papers = spark.createDataFrame([("a",), ("b",)], "id string")
    red = spark.createDataFrame([("x", "a", None), ("y", "a", None)], "old_id string, new_id string, merged_at timestamp")
    rows = spark.createDataFrame([(0, "x", "t"), (1, "a", "t"), (2, "y", "u"), (3, "x", "u"), (4, "gone", "t"), (5, None, "t")], "ordinal int, paper_id string, tag_id string")
    got = resolve.resolve_rows(rows, papers, red, ["paper_id", "tag_id"], "ordinal").collect()
    assert sorted((r["ordinal"], r["paper_id"], r["was_moved"]) for r in got) == [(1, "a", False), (2, "a", True)]
    ids = resolve.resolve_ids(rows.selectExpr("paper_id AS id"), papers, red).collect()
    assert {r["id"]: r["live_id"] for r in ids} == {"a": "a", "x": "a", "y": "a", "gone": None}


def test_signature_groups(spark):
    auth = "array(named_struct('name', 'Ada Li', 'affiliation', '', 'orcid', '', 'openalex_id', ''))"
    df = spark.sql(f"""SELECT *, {auth} AS authors, CAST(NULL AS string) AS published_date, CAST(NULL AS timestamp) AS created_at, 0 AS comment_count FROM VALUES
      ('1', 'Same title', '10.1/a', 'x', 1), ('2', 'same  title!', NULL, 'xx', 9), ('3', 'Other', '10.1/b', '', 0), ('4', 'other', '10.1/c', '', 0), ('5', 'Alone', NULL, '', 0) AS t(id, title, doi, abstract, upvote_count)""")
    assert [(r["keep_id"], r["remove_id"]) for r in dedup.by_signature(df).collect()] == [("1", "2")]


def test_write_back_keeps_long_abstracts(spark):
    from pyspark.sql import functions as F

    papers = spark.createDataFrame([("1", None), ("2", "short"), ("3", "l" * 60)], "id string, abstract string")
    answers = spark.createDataFrame([(str(i), "new", "crossref") for i in (1, 2, 3)], "id string, abstract string, source string")
    got = recover.write_back(papers, answers, F.lit("2024-01-01").cast("timestamp")).collect()
    assert {r["id"]: r["abstract"] for r in got} == {"1": "new", "2": "new", "3": "l" * 60}


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"title": "A title", "author": "Ada", "link": "http://x"}\nnot json\n')
    assert [r["title"] for r in records.read(spark, "feed", str(tmp_path)).collect()] == ["A title", None]
    assert records.window(2023) == ("2023-01-01", "2023-12-31")
    bulk = spark.createDataFrame([('{"externalIds": {"DOI": "10.1/X"}, "abstract": "t"}',), ("null",)], "value string")
    assert [tuple(r) for r in records.bulk_answers(records.parse(bulk, "bulk")).collect()] == [("10.1/x", "t")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"title": "A", "published": "2024-01-01T00:00:00Z", "link": "u"}\n{"title": "B", "published": "2024-01-01T01:00:00Z", "link": "u"}\n')
    seen = []
    stream = ingest.read_stream(spark, "feed", str(tmp_path / "in")).selectExpr("*", "CAST(published AS timestamp) AS ts")
    q = ingest.upsert_stream(ingest.first_seen_stream(stream, "link", "ts"), lambda df, n: seen.extend(r["link"] for r in df.collect()), str(tmp_path / "cp"))
    assert q.awaitTermination(120) and seen == ["u"]


def shuffled(spark):
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


@pytest.mark.parametrize("same_keys", [True, False])
def test_upsert_moves_values_at_most_twice(spark, same_keys):
    """Whether records meet by the same keys (joins) or by different ones (folding)."""
    rng = random.Random(5)
    long = lambda: rng.randbytes(10_000).hex()
    stored = [(f"s{i:02}", f"w{i}", None, f"b{i}", long(), "t", "u") for i in range(40)]
    rows = [(f"t{i:02}", f"w{i % 20}", None, None if same_keys else f"a{i % 7}", long() if i % 3 else "", f"n{i}", None, i) for i in range(60)]
    red = spark.createDataFrame([], "old_openalex_id string, old_doi string, old_arxiv_id string, new_id string, merged_at timestamp, old_id string")
    inputs = spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(rows, SCHEMA + ", o int")
    before = shuffled(spark)
    got = resolve.upsert(*inputs, red, COLS, "o").collect()
    assert shuffled(spark) - before < 2 * sum(len(r[4]) for r in [*stored, *rows])
    norm = lambda rows: sorted(tuple("" if v is None else v for v in r) for r in rows)
    assert norm(tuple(r) for r in got) == norm(fold(stored, [r[:7] for r in rows], []))


def test_components_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        test_upsert_equals_folding(spark, 1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_papers_without_an_id_pass(spark):
    stored = spark.createDataFrame([(None, None, None, None, "x", "t", None), (None, None, None, None, "y", "t", None)], SCHEMA)
    rows = spark.createDataFrame([("t1", "w1", None, None, "new", "n", None, 1)], SCHEMA + ", o int")
    red = spark.createDataFrame([], "old_openalex_id string, old_doi string, old_arxiv_id string, new_id string, merged_at timestamp, old_id string")
    assert sorted(r["abstract"] for r in resolve.upsert(stored, rows, red, COLS, "o").collect()) == ["new", "x", "y"]


def test_components_of_chains(spark):
    """Long chains in the order of their names end in few rounds; rings, stars, lone nodes and nodes without keys."""
    chain = [(f"c{i:04}", [f"k{i}", f"k{i + 1}"]) for i in range(300)]
    more = [(f"r{i}", [f"q{i}", f"q{(i + 1) % 5}"]) for i in range(5)] + [(f"s{i}", ["hub"]) for i in range(9)] + [("lone", ["x"]), ("none", [])]
    tracker, folder = [], resolve.checkpointed
    resolve.checkpointed = lambda df: tracker.append(1) or folder(df)
    try:
        got = resolve._components(spark.createDataFrame(chain + more, "node string, keys array<string>")).collect()
    finally:
        resolve.checkpointed = folder
    groups = {}
    for r in got:
        groups.setdefault(r["grp"], set()).add(r["node"])
    names = lambda rows: frozenset(n for n, _ in rows)
    assert {frozenset(g) for g in groups.values()} == {names(chain), names(more[:5]), names(more[5:14]), frozenset(["lone"]), frozenset(["none"])}
    assert len(got) == len(chain) + len(more) and len(tracker) < 30


def test_keywords_move_no_texts(spark):
    from paperloom.operators import classify

    rng = random.Random(6)
    ends = ["Deep  learning", "deep learning models and graph", "deep learnings, a graphs", "undeep learning graph", "deep learnt graph", "c++es graph", "c++x graph", "Graphes deep learning", None]
    papers = spark.createDataFrame([(f"p{i}", "t", e and rng.randbytes(20_000).hex() + " deep " + e, "src") for i, e in enumerate(ends)], "id string, title string, abstract string, source string")
    words = spark.createDataFrame([(1, "Deep learning", "a", 0), (2, "graph", "a", 0), (3, "C++", "a", 0), (4, "deep learning model", "b", 1), (5, "DEEP", "b", 1)], "entry_id int, keyword string, slug string, slug_ord int")
    before = shuffled(spark)
    got = sorted((r["paper_id"], r["slug"], r["n"]) for r in classify.keyword_hits(papers, words).collect())
    assert shuffled(spark) - before < 40_000
    assert got == [("p1", "a", 2), ("p1", "b", 2), ("p2", "a", 2), ("p5", "a", 2), ("p7", "a", 2)]
