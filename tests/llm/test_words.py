import numpy as np
import pyarrow as pa
from hypothesis import example, given, settings
from hypothesis import strategies as st

from paperloom.llm import words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB1é.,-!ßÉ日́ \t\u00a0\u3000", max_size=30), max_size=5))
@example(["!\u3000", "a\u00a0", "\u3000"])
def test_split_and_trimmed(texts):
    offsets, at, distinct = words.words(pa.array(texts, pa.string()))
    got = [[distinct[int(i)].as_py() for i in at[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [[words.trimmed(w) for w in pa.compute.utf8_lower(pa.scalar(t)).as_py().split()] for t in texts]
    assert len(set(distinct.to_pylist())) == len(distinct)


def test_hashes():
    rng = np.random.default_rng(1)
    made = ["", *{"".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 70, 4000)}]
    h = words.hashes(pa.array(made))
    assert len(set(h.tolist())) == len(made)  # no collision
    assert words.hashes(pa.array(["x", *made]).slice(1)).tolist() == h.tolist()  # of the word alone
    assert words.hashes(pa.array(made[::-1])).tolist() == h[::-1].tolist()
    ones = np.unpackbits(h.view(np.uint8)).reshape(len(h), 64).mean(0)
    assert abs(ones - 0.5).max() < 0.06
    assert len(words.hashes(pa.array([], pa.string()))) == 0
