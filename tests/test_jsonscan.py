import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidwork.functions import jsonscan
from braidwork.functions import jsontree as jt

KEYS = {"a": "b", "a.b": "a-b.a", "b": "", "a.a": "b.a", "b.a": "a"}


def by_trees(texts, keys):
    out = []
    for text in texts:
        try:
            out.append([x._asdict() for x in jt.flatten(jt.parse(text), keys)] if text is not None and text.strip() else [])
        except ValueError:
            out.append([])
    return out


def check(texts, keys=KEYS):
    whole = pa.array(["out of sight", *texts, "{}"], pa.string()).slice(1, len(texts))
    assert jsonscan.flatten_texts(whole, keys).to_pylist() == by_trees(texts, keys)


names = st.sampled_from(["a", "b", "a.b", "", "_sourceCaseId", "é"])
leaves = st.one_of(st.none(), st.booleans(), st.integers(-3, 3), st.floats(), st.sampled_from(["x", "X Y\u2003z", "", "a\"b", "tab\t", "ü€𝄞", "null", "}{"]))
trees = st.recursive(leaves, lambda x: st.one_of(st.lists(x, max_size=4), st.dictionaries(names, x, max_size=4)), max_leaves=25)
objects = st.dictionaries(names, trees, max_size=4)
written = st.builds(lambda x, indent, plain: json.dumps(x, indent=indent, ensure_ascii=plain), st.one_of(objects, objects, trees), st.sampled_from([None, 1]), st.booleans())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), written), max_size=6))
def test_as_the_trees_say(texts):
    check(texts)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet='{}[]:,"a1 -.\\n', max_size=14).map(lambda x: '{"a":' + x + "}"), max_size=5), st.lists(written, max_size=2))
def test_faults(broken, good):
    check([*broken, *good])
    check([*good, *broken])


@settings(max_examples=300, deadline=None)
@given(written, st.integers(0, 200), st.sampled_from(list('{}[]:,"a1 \\\x01\xa0')), st.booleans(), written)
def test_a_byte_more_or_less(text, at, mark, more, good):
    at = min(at, len(text))
    check([good, text[:at] + (mark if more else "") + text[at + (not more) :], good])


@pytest.mark.parametrize(
    "text",
    ['{"a":1.00,"b":-0,"c":1E+05}', '{"a":01}', '{"a":NaN,"b":-Infinity}', '{"a":+1}', '{"a":1,"a":2}', '{"a":1}{"b":2}', "[1]", "7", " ", "", "{}", '{"a"}', '{"_sourceCaseId"}', '{"a":[2,10,1,{"b":1},[3,1]]}',
     '{"_sourceCaseId":{"a":1},"b":2}', '{"_sourceCaseId":7,"a":[{"b":" Q r","c":[{"_sourceCaseId":null}]},{"_sourceCaseId":"k","b":null}]}', '{"a":' * 60 + "1" + "}" * 60, '{"a":"\\u0041"}', '{"a":1,}', '{"a":[1,]}', '\ufeff{"a":1}'],
)
def test_cases(text):
    check([text])
    check(['{"b":[{"a":1},{"a":0}]}', text, None, '{"z":"1"}'])


def test_pieces(monkeypatch):
    rnd = np.random.default_rng(3)
    texts = [json.dumps({"a": [{"b": int(x), "c": "v" * int(x)} for x in rnd.integers(0, 30, 5)], "n": [int(x) for x in rnd.integers(0, 9, 4)]}) for _ in range(200)] + [None]
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(jsonscan, "PIECE", size)
        check(texts)
    check([])
