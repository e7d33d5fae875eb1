"""The JSON helpers: flattening, keys, merging, lineage, signatures."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidwork.functions import jsontree as jt
from braidwork.functions.merging import Policy, Version, join_parts, merge, merge_all, tag_proofs
from braidwork.plans.config import ARRAY_KEYS, POLICIES, SOFT_ARRAYS, Options, parse_segments, without_comments


def flat(text, keys=None):
    return [(f.field, f.match_key, f.value) for f in jt.flatten(jt.parse(text), keys or {})]


@pytest.mark.parametrize(
    ("text", "keys", "want"),
    [
        ('{"a":"flat","b":{"c":"nested"},"d":null}', {}, [("a", None, "flat"), ("b.c", None, "nested"), ("d", None, None)]),
        ('{"n":1.00,"m":1e2,"t":true}', {}, [("n", None, "1.00"), ("m", None, "1e2"), ("t", None, "true")]),
        ('{"a":1,"a":2}', {}, [("a", None, "2")]),
        ('{"tags":["y","x"]}', {}, [("tags", None, "x"), ("tags", None, "y")]),
        ('{"e":{},"f":[]}', {}, []),
        ('["x"]', {}, [("$root", None, '["x"]')]),
        ("null", {}, [("$root", None, None)]),
        ('{"terms":[{"code":"B","msg":"w"},{"code":"A","msg":"h"}]}', {"terms": "code"}, [("terms.code", "b", "B"), ("terms.msg", "b", "w"), ("terms.code", "a", "A"), ("terms.msg", "a", "h")]),
        ('{"t":[{"n":"ACC 123","c":"cust456","d":"2020-01-01","x":"TL01"}]}', {"t": "n-c-d-x"}, [(f"t.{k}", "acc123-cust456-2020-01-01-tl01", v) for k, v in (("n", "ACC 123"), ("c", "cust456"), ("d", "2020-01-01"), ("x", "TL01"))]),
        ('{"t":[{"k":"P","h":[{"v":2},{"v":1}]}]}', {"t": "k"}, [("t.k", "p", "P"), ("t.h.v", "p", "1"), ("t.h.v", "p", "2")]),
        ('{"t":[{"k":"P","h":[{"c":"1"}]}]}', {"t": "k", "t.h": "c"}, [("t.k", "p", "P"), ("t.h.c", "p-1", "1")]),
        ('{"t":[{"a":1}]}', {"t": "a-code"}, [("t.a", "1-null", "1")]),
        ('{"o":{"customerNumber":"9","codes":[{"code":"7"}]}}', {"o": "customerNumber", "o.codes": "code"}, [("o.customerNumber", "9", "9"), ("o.codes.code", "9-7", "7")]),
        ('{"t":[5,null,[6]]}', {"t": "k"}, [("t", "null", "5"), ("t", "null", None), ("t", "null", "6")]),
    ],
)
def test_flatten(text, keys, want):
    assert flat(text, keys) == want


@pytest.mark.parametrize(("item", "spec", "want"), [
    ('{"n":"234","d":[{"code":"234"}]}', "n-d.code", "234-234"), ('{"n":"234","d":[]}', "n-d.code", "234-null"), ('{"n":"234"}', "n-d.code", "234-null"), ('"text"', "n", "null"), ('{"n":{"a":1}}', "n", '{"a":1}'), ('{"n":[" A b "]}', "n", "ab"),
])
def test_match_key(item, spec, want):
    assert jt.match_key(jt.parse(item), spec) == want


def test_source_case_is_no_field():
    got = jt.flatten(jt.parse('{"a":[{"k":"1","_sourceCaseId":"c1","x":{"y":2}},{"k":"2"}]}'), {"a": "k"})
    assert [(f.field, f.case_id) for f in got] == [("a.k", "c1"), ("a.x.y", "c1"), ("a.k", None)]


@pytest.mark.parametrize(("path", "want"), [("a.b[1].c", "x"), ("a.b[0]", '{"c":1.0}'), ("a.b[9].c", None), ("a.z", None), ("n", None), ("a.b.c", None)])
def test_extract(path, want):
    assert jt.extract(jt.parse('{"a":{"b":[{"c":1.0},{"c":"x"}]},"n":null}'), path) == want


@pytest.mark.parametrize(("text", "want"), [
    ('id="i",request="{\\"a\\":1}"', '{"a":1}'), ('id=i,request={"a":1}', '{"a":1}'), ('{"a":1}', '{"a":1}'), ("other", "other"), (None, None),
])
def test_unwrap(text, want):
    assert jt.unwrap(text) == want


def test_canonical_ignores_order_and_provenance():
    a, b = jt.parse('{"b":[2,1],"a":{"x":1,"_caseIdByField":{"x":"c"}}}'), jt.parse('{"a":{"x":1},"b":[1,2],"_caseIdByField":{"a":"d"}}')
    text = [jt.dump(jt.canonical(jt.without_provenance(t))) for t in (a, b)]
    assert text[0] == text[1] == '{"a":{"x":1},"b":[1,2]}'


def test_stamp_and_take():
    tree = jt.stamp(jt.parse('{"a":1,"o":{"b":2},"h":{"c":3},"l":[{"d":4}]}'), "c1", {"h"})
    assert tree["o"]["_caseIdByField"] == {"b": "c1"} and "_caseIdByField" not in tree["h"] and tree["l"] == [{"d": "4"}]
    bare, notes = jt.take_cases(tree)
    assert notes == {"a": "c1", "o": "c1", "h": "c1", "l": "c1", "o.b": "c1"} and jt.dump(bare) == '{"a":1,"o":{"b":2},"h":{"c":3},"l":[{"d":4}]}'


MAIN = POLICIES["main"]


def stamped(text, case):
    return jt.stamp(jt.parse(text), case, set(MAIN.atomic))


def merged(a, b, at=("1", "2"), cases=("c1", "c2")):
    return merge(Version(stamped(a, cases[0]), at[0]), Version(stamped(b, cases[1]), at[1]), MAIN)


def test_union_and_collision():
    got = merged('{"a":"1","n":"John"}', '{"b":"2","n":"Johnny"}')
    assert got.tree["n"] == "Johnny" and got.tree["_caseIdByField"] == {"a": "c1", "b": "c2", "n": "c2"} and got.at == "2"
    assert merged('{"n":"x"}', '{"n":"y"}', ("3", None)).tree["n"] == "x" and merged('{"n":"x"}', '{"n":"y"}', (None, None)).tree["n"] == "y"


@settings(max_examples=80, deadline=None)
@given(st.permutations([('{"n":"A","x":1}', "1"), ('{"n":"B"}', "5"), ('{"n":"C","y":[1]}', "5")]))
def test_merge_does_not_depend_on_order(versions):
    got = merge_all([Version(jt.parse(t), at) for t, at in versions], Policy())
    assert got.tree["n"] == "C" and set(got.tree) == {"n", "x", "y"}


def test_merge_with_itself_is_identity():
    text = '{"addresses":[{"addressType":"Current","street":"1"},{"addressType":"Former1","street":"2"}],"a":{"b":1}}'
    got = merged(text, text, cases=("c", "c"))
    assert jt.dump(jt.without_provenance(got.tree)) == text.replace(" ", "")


def test_keyed_items_collide_and_unkeyed_ones_add_up():
    got = merged('{"documentProofs":[{"authenticationType":"A","document":"d","v":1}],"attachments":[1]}', '{"documentProofs":[{"authenticationType":"A","document":"d","v":2},{"document":"e"}],"attachments":[1]}').tree
    assert [(x.get("v"), x["_sourceCaseId"]) for x in got["documentProofs"]] == [("2", "c2"), (None, "c2")] and got["attachments"] == ["1"]
    plain = merge(Version(jt.parse('{"x":[{"a":1}]}'), "1"), Version(jt.parse('{"x":[{"a":1}]}'), "2"), Policy(arrays=frozenset({"x"})))
    assert len(plain.tree["x"]) == 2


def test_priority_field_wins_over_time():
    got = merged('{"addresses":[{"addressType":"Current","street":"old","addressRequested":{"disputeCodes":[]}}]}', '{"addresses":[{"addressType":"Current","street":"new"}]}').tree
    assert [(x["street"], x["_sourceCaseId"]) for x in got["addresses"]] == [("old", "c1")]


@pytest.mark.parametrize(("left", "right", "n"), [(2, 2, 2), (1, 1, 1), (4, 4, 4), (3, 1, 3), (0, 2, 2)])
def test_equal_items_cancel_one_to_one(left, right, n):
    item = {"firstName": "A", "lastName": "B", "middleName": "C"}
    got = merged(json.dumps({"alsoKnownAs": [item] * left}), json.dumps({"alsoKnownAs": [item] * right})).tree
    assert len(got["alsoKnownAs"]) == n


def test_atomic_object_keeps_the_losers_slot():
    got = merged('{"creditReportHeader":{"customerNumber":"1","x":"old","dateOfBirthRequested":{"d":1}}}', '{"creditReportHeader":{"customerNumber":"2"}}').tree
    header = got["creditReportHeader"]
    assert header["customerNumber"] == "2" and "x" not in header and header["dateOfBirthRequested"] == {"d": "1"}
    assert header["_caseIdByField"] == {"dateOfBirthRequested": "c1"} and got["_caseIdByField"]["creditReportHeader"] == "c2"


def test_parts_and_proofs():
    auth = tag_proofs(jt.parse('{"verifiedData":{"a":1},"documentProofs":[{"document":"1"}]}'), "documentProofs", "Authentication")
    review = tag_proofs(jt.parse('{"documentProofs":[{"document":"2"},{"document":"9","authenticationType":"Authentication"}],"z":1}'), "documentProofs", "Document_Review")
    got = join_parts({"authentication": auth, "docreview": review}, {"authentication": "verifiedData", "docreview": "documentProofs"}, "docreview", frozenset({"documentProofs"}))
    assert [(x["document"], x["authenticationType"]) for x in got["documentProofs"]] == [("2", "Document_Review"), ("1", "Authentication")] and got["verifiedData"] == {"a": "1"} and got["z"] == "1"


def test_configuration():
    assert len(ARRAY_KEYS) == 53 and len(SOFT_ARRAYS) == 22 and set(SOFT_ARRAYS) <= set(ARRAY_KEYS) and len(MAIN.arrays) == 20
    assert without_comments({"_comment_x": 1, "a": [{"_comment": 2, "b": 3}]}) == {"a": [{"b": 3}]}
    good = {"name": "m", "aiMethod": "a", "humanMethod": "h"}
    assert parse_segments(json.dumps([good]))[0].required == ("default",)
    for bad in ([], [{"name": "m"}], [good, good], [good | {"humanMethod": "a"}], [good | {"humanSubTypes": [{"name": "x", "discriminatorField": "y"}]}], [good, {"name": "n", "aiMethod": "h", "humanMethod": "q"}]):
        with pytest.raises(ValueError):
            parse_segments(json.dumps(bad))
    with pytest.raises(ValueError):
        Options("a", "h", "s", "r", "d", "c", (), filter_path="x")
