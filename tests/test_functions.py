"""Scalar functions and rules against hand-checked values."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.functions import rules, text
from paperloom.operators import classify

AUTHORS = "array<struct<name:string,affiliation:string,orcid:string,openalex_id:string>>"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def s(x):
    return F.lit(x).cast("string")


def test_dois(spark):
    cases = [
        (text.clean_doi, " DOI: 10.1/X ", "10.1/X"), (text.clean_doi, "doi:", None), (text.clean_doi, "https://doi.org/10.1/x", "https://doi.org/10.1/x"), (text.clean_doi, None, None),
        (text.normalize_doi, "doi: 10.1/x", " 10.1/x"), (text.normalize_doi, "HTTP://DOI.ORG/10.1/X", "10.1/x"), (text.normalize_doi, "", None),
        (text.normalize_doi_prefix, "doi: 10.1/x", "10.1/x"), (text.normalize_doi_prefix, "https://doi.org/doi:10.1/X ", "10.1/x"),
        (text.normalize_doi_stored, " https://doi.org/10.1/X ", "10.1/x"), (text.normalize_doi_stored, "DOI:10.1/x", "doi:10.1/x"),
    ]
    for f, given_, want in cases:
        assert value(spark, f(s(given_))) == want, (f.__name__, given_)


def test_titles_and_names(spark):
    assert value(spark, text.normalize_title(s("<i>Étude</i>,  A-B"))) == "étude ab"
    assert value(spark, text.normalize_title(s(None))) == ""
    assert len(value(spark, text.normalize_title(s("ab " * 90)))) == 100
    name = lambda n: F.expr(f"CAST(array(named_struct('name', {n}, 'affiliation', '', 'orcid', '', 'openalex_id', '')) AS {AUTHORS})")
    none = F.array().cast(AUTHORS)
    assert value(spark, text.last_name(name("'  Ada  Lovelace '"))) == "lovelace"
    assert value(spark, text.last_name(none)) == "" == value(spark, text.last_name(name("NULL")))
    assert value(spark, text.signature(s(None), none, s(None))) == "||"
    assert value(spark, text.recovery_route(s("10.1016/j.x"))) == "free_exhausted"
    assert value(spark, text.recovery_route(s("10.1038/x"))) == value(spark, text.recovery_route(s(""))) == "free_dead"
    assert [round(value(spark, text.keyword_score(F.lit(n))), 6) for n in (2, 3, 4, 9)] == [0.7, 0.8, 0.9, 0.9]
    assert value(spark, text.clean_jats(s("<jats:p> a <b>c</b> </jats:p>"))) == "a c"
    assert value(spark, text.one_line(s(" a\nb  c\n"))) == "a b  c"
    assert [value(spark, text.iso_date(F.expr(e))) for e in ("array(2024)", "array(2024, 3)", "array(int(NULL))", "CAST(array() AS array<int>)")] == ["2024-01-01", "2024-03-01", None, None]


def test_update_rules(spark):
    for stored, new, wins, fills in [("a", "", "a", "a"), ("a", "b", "b", "a"), ("", "b", "b", "b"), ("", "", "", None)]:
        assert value(spark, text.incoming_wins(s(new), s(stored), True)) == wins
        assert value(spark, text.stored_wins(s(new), s(stored))) == fills
    assert value(spark, text.incoming_wins(s(None), s("a"), False)) is None


@settings(max_examples=15, deadline=None)
@given(words=st.lists(st.sampled_from(["a", "b", "cc", "d"]), max_size=12))
def test_rebuild(spark, words):
    index: dict = {}
    for i, w in enumerate(words):
        index.setdefault(w, []).append(i)
    got = spark.createDataFrame([(index,)], "m map<string,array<int>>").select(text.rebuild_text(F.col("m"))).first()[0]
    assert got == (" ".join(words) or None)


def test_rules(spark):
    ada = F.expr(f"CAST(array(named_struct('name', 'Ada', 'affiliation', '', 'orcid', '', 'openalex_id', '')) AS {AUTHORS})")
    blank = F.expr(f"CAST(array(named_struct('name', ' ', 'affiliation', '', 'orcid', '', 'openalex_id', '')) AS {AUTHORS})")
    good = "A sufficiently long title of a paper"
    ok = lambda t, src=None, a=ada, **k: value(spark, rules.valid_paper(s(t), s(src), a, **k))
    assert ok(good) and ok("x" * 20) and not ok("x" * 19) and not ok("") and not ok(None)
    assert not ok(good, " " + good.upper()) and not ok(good, a=blank) and not ok(good, a=F.lit(None).cast(AUTHORS))
    assert not ok("Molecular Medicine and Biology letters") and ok("Molecular Medicine and Biology letters", strict=False)
    assert ok("Molecular Medicine and Biology of Everything else letters")
    problem = lambda t, title="T": value(spark, rules.abstract_problem(s(t), s(title)))
    assert problem(None) == problem("") == "empty"
    assert problem("x" * 99) == "too_short:99" and problem("x" * 12001) == "too_long:12001" and problem("x" * 100) == ""
    assert problem("All Rights Reserved " + "x" * 100).startswith("boilerplate:")
    title = "A title of some length"
    assert problem(title + "y" * 119, title) == "title_only" and problem(title + "y" * 120, title) == ""


def test_keywords_equal_patterns(spark):
    """The token join against one pattern per keyword."""
    texts = ["classes and taxs in the démocratie, M&A finance", "class classy tax taxes", "state-of-the-art states", "mocratie M&A finances real estate", "", None, "Tax\nclass real\nestate real estates"]
    words = ["class", "Tax", "mocratie", "M&A finance", "state-of-the-art", "state", "real estate", "tax"]
    papers = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, title string").selectExpr("id", "title", "CAST(NULL AS string) AS abstract", "CAST(NULL AS string) AS source")
    kw = spark.createDataFrame([(i, w, "all", 0) for i, w in enumerate(words)], "entry_id int, keyword string, slug string, slug_ord int")
    got = {r["paper_id"]: r["n"] for r in classify.keyword_hits(papers, kw).collect()}
    want = {}
    for i, t in enumerate(texts):
        n = sum(bool(re.search(r"\b" + re.escape(w.lower()) + r"(?:e?s)?\b", f"{t or ''}  ".lower())) for w in words)
        if n >= 2:
            want[str(i)] = n
    assert got == want


def test_subfields_equal_patterns(spark):
    """The whole shipped dictionary against patterns, on a few texts."""
    from paperloom.sources import dims

    kw = dims.dimension(spark, "subfield_keywords")
    rows = kw.collect()
    texts = ["Monetary policy and inflation with central banks and interest rates", "Deep learning and neural networks for computer vision image segmentation", "voting elections parties and congress polls", "audit and tax disclosures by auditors under gaap"]
    papers = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, title string").selectExpr("id", "title", "'' AS abstract", "'' AS source")
    got = {(r["paper_id"], r["slug"]): r["n"] for r in classify.keyword_hits(papers, kw).collect()}
    want: dict = {}
    for i, t in enumerate(texts):
        for r in rows:
            if re.search(r"\b" + re.escape(r["keyword"].lower()) + r"(?:e?s)?\b", t.lower()):
                want[str(i), r["slug"]] = want.get((str(i), r["slug"]), 0) + 1
    assert got == {k: n for k, n in want.items() if n >= 2} and got


def test_inverted_index(spark):
    rows = [("a b a  c",), ("",), (None,), ("b",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.inverted_index(F.col("t"))).collect()]
    assert got == [{"a": [0, 2], "b": [1], "": [3], "c": [4]}, {"": [0]}, None, {"b": [0]}]
