import math
from collections import Counter, defaultdict

import regex
from hypothesis import example, given, settings
from hypothesis import strategies as st

from paperloom.llm import privacy
from paperloom.llm.words import trimmed


def test_entities():
    text = "mail joe.49@mail9.example.com, phone +1 (826) 555-7388, card 4094009243589165 or 4094-0092-4358-9165, host 196.3.67.149."
    assert [(k, text[a:b]) for k, a, b in privacy.entities(text)] == [("MAIL", "joe.49@mail9.example.com"), ("PHONE", "+1 (826) 555-7388"), ("CARD", "4094009243589165"), ("CARD", "4094-0092-4358-9165"), ("NETWORK", "196.3.67.149")]
    for clean in ("Version 2.0.", "CC BY-NC 4.0.", "in 2024 and 12345", "a@b", "1.2.3", "12345678901234567890"):
        assert not privacy.entities(clean), clean


def brute(texts):
    """Disclosing terms by plain counting."""
    occ = defaultdict(set)
    for t in texts:
        if t:
            for e, terms in privacy.surroundings(t):
                for x in ["", *terms]:
                    occ[e, x].add(tuple(terms))
    df = Counter()
    for t in texts:
        df.update({trimmed(w) for w in (t or "").lower().split()})
    best = {}
    for (e, x), s in occ.items():
        if x and len(s) >= privacy.MIN_OCCASIONS:
            n, ke, k = len(texts), len(occ[e, ""]), len(s)
            ic = -math.log2(ke / n)
            if ic > 0:
                best[x] = max(best.get(x, -9), math.log2(k * n / (ke * max(df[x], k))) / ic)
    return {x: v for x, v in best.items() if v >= privacy.GENERALISE}


def corpus():
    filler = "the of and to in was for on with as".split()
    texts = []
    for i in range(6):
        texts.append(f"{' '.join(filler[i:])} n{i} Zorblatt the quux{i} reached boss@corp.example.org by {filler[i]} m{i} today")
    texts += ["Zorblatt was here in the park", "the plain text of a clean page", None, "", "call +1 (913) 555-3797 now"] + [f"clean page number x{i} of the set" for i in range(80)]
    return texts


def test_equals_counting(make):
    texts = corpus()
    got = {r["term"]: r["disclosure"] for r in privacy.disclosing(make(texts)).collect()}
    want = brute(texts)
    assert set(got) == set(want) and "zorblatt" in got and "the" not in got
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_documents(make):
    texts = corpus()
    docs = make(texts).withColumnRenamed("lang", "terms")
    got = {r["doc_id"]: r["text"] for r in privacy.sanitised_documents(docs).collect()}
    joined = {r["doc_id"]: r["text"] for r in privacy.sanitised_documents(docs, broadcast_terms=0).collect()}
    assert got == joined  # the list of terms broadcast or joined
    for i, t in enumerate(texts):
        if t and ("@" in t or "Zorblatt" in t or "+1" in t):
            assert "@" not in got[i] and "Zorblatt" not in got[i] and "555" not in got[i]
        else:
            assert got[i] == t
    assert "[MAIL]" in got[0]
    rows = privacy.sanitised_documents(make(texts), counts=True).collect()
    assert sum(r["entities"] for r in rows) == 7 and len(rows) == len(texts)
    assert privacy.sanitised_documents(docs.filter("doc_id < 0")).collect() == []


def test_copies_are_one_occasion(make):
    texts = ["the rare wordx met joe@mail.example.com in may"] * 50 + [f"clean {i}" for i in range(20)]
    assert privacy.disclosing(make(texts)).collect() == []


def test_unicode_spaces(make):
    texts = [*corpus(), "seen near\u00a0Zorblatt\u202fhere", "une\u3000Zorblatt\u00a0: oui"]
    for n in (privacy.BROADCAST_TERMS, 0):  # the list of terms broadcast or joined
        got = {r["doc_id"]: r["text"] for r in privacy.sanitised_documents(make(texts), broadcast_terms=n).collect()}
        assert not any("Zorblatt" in (t or "") for t in got.values()), n


def test_copies_dilute_nothing(make):
    pages = [f"on day{i} the rare Wordx met joe@mail.example.com in place{i} again" for i in range(3)]
    texts = pages * 20 + [f"clean page {i}" for i in range(400)]
    got = {r["term"]: r["disclosure"] for r in privacy.disclosing(make(texts)).collect()}
    assert abs(got["wordx"] - 1) < 1e-9


def test_terms_far_away_and_behind_entities(make):
    gap = " ".join("the of and to in was for on with as".split() * 4)
    texts = [f"Farword {gap} p{i} Nearname joe@mail.example.com +1 (913) 555-3797 4094009243589165 q{i}" for i in range(4)] + [f"clean page {i} {gap}" for i in range(90)]
    docs = make(texts)
    got = {r["term"]: r["disclosure"] for r in privacy.disclosing(docs).collect()}
    assert set(got) == set(brute(texts)) == {"farword", "nearname"}
    pairs = docs.select("text").transform(privacy.occasions).collect()
    card = {t for r in pairs if r["entity"].startswith("CARD") for t in r["terms"]}
    assert {"nearname", "farword"} <= card
    assert all("Farword" not in r["text"] and "Nearname" not in r["text"] for r in privacy.sanitised_documents(docs).collect())


ALL = regex.compile(
    r"(?P<MAIL>[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++)|" + privacy.NUMBER.pattern
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["joe", ".", "@", "mail.example", ".com", " ", "+1 ", "(826) ", "555-", "7388", "196.3.67.149", "DE44", "4094", " 0092 ", "4358-9165", "123-45-6789", "é", "-", "(", "+"]), max_size=14))
@example(["+1 ", "7388", "@", "mail.example"])
@example(["+1 ", "7388", ".", "joe", "@", "mail.example"])
@example(["joe", "+1 ", "7388", "@", "mail.example"])
def test_entities_equal_one_pattern(parts):
    """The anchored search against one pattern tried at every place."""
    text = "".join(parts)
    assert privacy.entities(text) == [(m.lastgroup, *m.span()) for m in ALL.finditer(text)]


def test_long_repeated_and_null_rows(make):
    texts = corpus()
    long = "the of and " * 60_000 + "Zorblatt joe" + "x" * 300 + "@mail.example.com " + "t" * 500
    term = [f"{'q' * 400} wrote {f} boss@corp.example.org n{f} on x" for f in ("in", "at", "by", "or")]
    rows = [*enumerate(texts), (None, texts[0]), (0, texts[0]), (900, long), *enumerate(term, 950)]
    for n in (privacy.BROADCAST_TERMS, 0):
        got = privacy.sanitised_documents(make(rows), counts=True, broadcast_terms=n).collect()
        assert len(got) == len(rows) and sum(r["terms"] for r in got) > 0
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], set()).add(r["text"])
        assert by[None] == by[0] and len(by[0]) == 1
        (whole,) = by[900]
        assert "Zorblatt" not in whole and "x" * 300 not in whole and whole.endswith("[MAIL] " + "t" * 500) and len(whole) > 500_000
        assert not any("q" * 400 in t for d in range(950, 954) for t in by[d])  # a term of any length

