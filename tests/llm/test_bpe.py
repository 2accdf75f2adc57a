import base64
import random

import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import bpe, tokenstore


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.loaded()


@pytest.fixture(scope="module")
def exact():
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


HARD = ["", " ", "  a", "a  b", "a   b\n\n c", "foo \nbar", "foo\n bar  x  y", "it's we'll 123 ---\t\tx ", "\n\n\n", "日本語 テスト", "😀😀 " + "a" * 5000, "x  y", "don't 'tis rock'n'roll", "  a", "á b", "!!!!!!!!!!! ?", " a " * 300]


def test_equals_merging(vocabulary, exact):
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("abcdefghij éßñ \n.,'1!") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    offsets, ids = vocabulary.encode_column(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == exact.encode_ordinary(t), t
    assert bpe.same_bytes(vocabulary, pa.array(texts), offsets, ids).all()


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_any_text(vocabulary, exact, text):
    text = text.encode("utf-8", "ignore").decode()
    got = vocabulary.encode(text)
    assert got == exact.encode_ordinary(text)
    assert bytes(vocabulary.decode(got)) == text.encode()


def merged(b, word):
    """Plain merging, the lowest rank first."""
    parts = [bytes([x]) for x in word]
    while True:
        ranks = [b.ids.get(x + y, 1 << 30) for x, y in zip(parts, parts[1:])]
        if not ranks or min(ranks) == 1 << 30:
            return [b.ids[p] for p in parts]
        k = ranks.index(min(ranks))
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


class NoGreedy:
    """An automaton without the greedy path's matches, so that backtracking does all."""

    def __init__(self, automaton):
        self.iter = automaton.iter

    def iter_long(self, text):
        return iter(())


def both_paths(b, word):
    greedy = b.encode_word(word)
    automaton, b.automaton = b.automaton, NoGreedy(b.automaton)
    backtracked = b.encode_word(word)
    b.automaton = automaton
    return greedy, backtracked


SINGLE = [bytes([b]) for b in range(256)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab", max_size=40), st.lists(st.text(alphabet="ab", min_size=2, max_size=5), max_size=8, unique=True))
def test_small_vocabularies(word, more):
    tokens = list(SINGLE)
    for m in sorted(more, key=len):  # each a merge of two earlier ones
        raw = m.encode()
        if any(raw[:k] in tokens and raw[k:] in tokens for k in range(1, len(raw))):
            tokens.append(raw)
    small = bpe.Bpe(tokens)
    for got in both_paths(small, word.encode()):
        assert got == merged(small, word.encode())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", max_size=60), st.lists(st.text(alphabet="abc", min_size=2, max_size=6), max_size=25, unique=True))
def test_any_merge_table(word, more):
    """Also tokens in any rank order, most of which merging can't form."""
    tokens = [*SINGLE, *(m.encode() for m in more)]
    try:
        small = bpe.Bpe(tokens)
    except ValueError:  # a whole that ranks before its part
        plain = type("Plain", (), {"ids": {t: i for i, t in enumerate(tokens)}})
        assert any(merged(plain, t) == [i] for t, i in plain.ids.items() if len(t) > 2)
        return
    for got in both_paths(small, word.encode()):
        assert got == merged(small, word.encode())
    assert bytes(small.decode(small.encode_word(word.encode()))) == word.encode()


def test_token_that_merging_cannot_form():
    small = bpe.Bpe([*SINGLE, b"ab", b"bb", b"aa", b"aabb"])
    for word in (b"aabb", b"aaaabb", b"aabbaabb", b"xaabby"):
        assert set(map(tuple, both_paths(small, word))) == {tuple(merged(small, word))}
    assert bytes(small.decode([259])) == b"aabb"  # it is decoded all the same


def test_two_generations(vocabulary, exact, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    text = "one two three four five one two six seven one"
    assert vocabulary.encode(text) == exact.encode_ordinary(text)


def test_query(make, exact):
    texts = [*HARD, None, "again", "again"]
    docs = make(texts).withColumnRenamed("lang", "token_ids").withColumnRenamed("source", "exact")
    rows = {r["doc_id"]: r for r in bpe.encoded(docs).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["exact"] and rows[i]["token_ids"] == exact.encode_ordinary(t or "") and rows[i]["n_tokens"] == len(rows[i]["token_ids"])
    assert bpe.encoded(docs.filter("doc_id < 0")).collect() == []


def test_token_store(spark, make, exact):
    texts = [*HARD, None, "again", "again"]
    folder = tokenstore.new_folder(spark)
    rows = tokenstore.written(make([*enumerate(texts), (None, "no id")]), folder).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        t = "no id" if r["doc_id"] is None else texts[r["doc_id"]]
        shard = tokenstore.Shard(folder, r["shard"])
        assert shard[r["place"]].tolist() == exact.encode_ordinary(t or "")
        assert r["id_sum"] == sum(exact.encode_ordinary(t or "")) and r["n_tokens"] == len(exact.encode_ordinary(t or ""))
        assert shard.span([r["place"]])[0].tolist() == [r["first_token"]]
    for s in {r["shard"] for r in rows}:
        shard = tokenstore.Shard(folder, s)
        assert shard.span([len(shard) - 1])[1].tolist() == [len(shard.ids)]
    assert tokenstore.written(make(["x"]).filter("doc_id < 0")).collect() == []
