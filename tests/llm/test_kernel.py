import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from braidwork.llm import wordkernel as wk

from .conftest import words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t\x0bé\xa0z", max_size=40)), max_size=12))
def test_words_and_grams(texts):
    seen = []
    for p in wk.parts(pa.array(texts, pa.string()), lower=True, most=32):
        for r in range(p.rows):
            a, b = p.bounds[r], p.bounds[r + 1]
            seen.append([p.data[s:e].tobytes().lower().decode() for s, e in zip(p.start[a:b], p.end[a:b])])
            known = dict(zip(seen[-1], p.hash[a:b]))
            assert [known[w] for w in seen[-1]] == list(p.hash[a:b])
        g, at = wk.grams(p, 2)
        assert len(g) == sum(max(0, x - 1) for x in np.diff(p.bounds))
    assert seen == [words(t, lower=True) for t in texts]


def test_hashes_do_not_depend_on_the_part():
    text = " ".join(f"w{i}" for i in range(3000))
    whole = next(wk.parts(pa.array([text])))
    old, wk.STEP_BYTES = wk.STEP_BYTES, 100
    try:
        cut = next(wk.parts(pa.array(["x y", text]).slice(1)))
    finally:
        wk.STEP_BYTES = old
    assert (whole.hash == cut.hash).all() and (whole.start == cut.start).all()
