"""Nested records: rows, parents, lone objects, arrays in text, broken and deep payloads; checked against a plain walk."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.operators import nested

SCHEMA = "return_id bigint, kind string, payload string"


def rows(spark, payloads):
    df = spark.createDataFrame([(i, "clash", p) for i, p in enumerate(payloads)], SCHEMA)
    return nested.flatten_records(df, ["return_id"])


def paths(spark, payloads):
    return {(r.return_id, r.child_path, r.parent_path) for r in rows(spark, payloads).collect()}


def test_paths(spark):
    a = json.dumps({"S": [{"E": {"n": 1}}, {"E": [{"D": {"A": [{"x": 1}]}}, None, 3]}], "P": {"q": 1}, "G": [[{"r": 0}], [{"r": 1}, {"r": 2}]]})
    b = json.dumps({"S": {"E": json.dumps([{"n": 2}, {"n": 3}])}, "T": "[UNREADABLE]", "B": "[1, 2]", "N": None, "Z": []})
    got = paths(spark, [a, b, a[:30], None, "", "[{\"x\": 1}]", "{\"a\": NaN}", "17"])
    assert got == {
        (0, "$.S[0]", "$"), (0, "$.S[0].E[0]", "$.S[0]"), (0, "$.S[1]", "$"), (0, "$.S[1].E[0]", "$.S[1]"), (0, "$.S[1].E[0].D.A[0]", "$.S[1].E[0]"),
        (0, "$.G[0][0]", "$"), (0, "$.G[1][0]", "$"), (0, "$.G[1][1]", "$"),
        (1, "$.S[0]", "$"), (1, "$.S[0].E[0]", "$.S[0]"), (1, "$.S[0].E[1]", "$.S[0]"), (5, "$[0]", "$"),
    }


def test_repeats_deep_and_empty(spark):
    deep = "[" * 5000 + "]" * 5000  # valid, without an object
    one = json.dumps({"a": [{"b": 1}]})
    df = spark.createDataFrame([(1, "x", one), (1, "x", one), (2, "x", deep)], SCHEMA)
    assert nested.flatten_records(df, ["return_id"]).count() == 1
    assert nested.flatten_records(df.limit(0), ["return_id"]).count() == 0


def test_variants_and_typed_tables(spark):
    r = rows(spark, [json.dumps({"P": [{"Id": 1, "return_id": "x"}, {"Id": 2, "Amt": 1.5}, {"Id": 3, "return_id": "y"}]})]).cache()
    cat = {(c.kind, c.shape): c for c in nested.variant_catalog(r).collect()}
    assert {tuple(c.common_members) for c in cat.values()} == {("Id",)}
    shape = json.dumps([["Id", "i"], ["return_id", "s"]])
    t = nested.subtype_table(r, "$.P[]", shape, ["return_id"])
    assert dict(t.dtypes)["Id"] == "bigint" and "m_return_id" in t.columns
    assert sorted((x.Id, x.m_return_id) for x in t.collect()) == [(1, "x"), (3, "y")]
    s = nested.supertype_table(r, "$.P[]", ["Id"], ["return_id"])
    assert s.count() == 3


JSON = st.recursive(st.none() | st.integers() | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "c]"]), x, max_size=3), max_leaves=12)


@given(JSON)
@settings(max_examples=150, deadline=None)
def test_state_names_the_shape(v):
    assert nested.state(v) == nested.state(json.loads(json.dumps(v))) and nested.parse_deep(json.dumps(v)) == v
    v = nested.normalised(v)
    arrays = nested.array_members(v)
    found = [(p, parent) for p, parent, *_ in nested.walk(v, arrays)]
    assert len(found) == len(set(found)) and set(found) == set(plain(v, arrays))


def plain(v, arrays, path="$", parent="$", name=None, element=False):
    """The definition, said recursively."""
    v = nested.as_array(v)
    if isinstance(v, list):
        return [r for i, x in enumerate(v) for r in plain(x, arrays, f"{path}[{i}]", parent, name, True)]
    if not isinstance(v, dict):
        return []
    if not element and name in arrays:
        path, element = path + "[0]", True
    own = [(path, parent)] if element else []
    return own + [r for k, x in v.items() for r in plain(x, arrays, f"{path}.{k}", path if element else parent, k)]


def test_member_names_that_look_like_indexes():
    assert list(nested.walk({"x]": {"y": 1}}, set())) == []


def test_any_depth(spark):
    depth = 5000
    payload = '{"a": [' * depth + '{"b": 1}' + "]}" * depth
    got = rows(spark, [payload, payload[:-1]]).collect()
    assert len(got) == depth and {r.return_id for r in got} == {0} and len({r.variant for r in got}) == depth and "deep" not in {r.variant for r in got}
    assert max(got, key=lambda r: len(r.child_path)).child_path == "$" + ".a[0]" * depth
    assert [r.return_id for r in nested.rejected_records(spark.createDataFrame([(0, payload), (1, payload[:-1]), (2, None), (3, "{"), (3, "{"), (4, "1")], "return_id bigint, payload string"), ["return_id"]).orderBy("return_id").collect()] == [1, 2, 3]


def test_deep_parser_agrees_with_the_standard_one():
    texts = ['{"a": [1, -2.5e3, "x\\n\\u00e9", true, null], "b": {}}', "[]", " [ ] ", '"x"', "3", "[1,]", "{,}", '{"a"}', '{"a":}', "[1 2]", "[1]]", "", "[", '{"a":1', "[NaN]", "01", '{"a":1,"a":2}', "[[[]]]", '["\t"]']
    for t in texts:
        try:
            want = json.loads(t, parse_constant=nested._no_constant)
        except ValueError:
            want = ValueError
        try:
            got = nested.parse_deep(t)
        except ValueError:
            got = ValueError
        assert got == want, t


def test_a_state_is_computed_once():
    import time

    v = {"x": 1}
    for _ in range(100_000):
        v = {"a": [v], "n": 2}
    began = time.time()
    assert len(nested.states(v)[1]) == 200_001 and time.time() - began < 5


def test_member_names_that_are_data(spark, monkeypatch):
    payloads = [json.dumps({f"k{i}": [{"n": i}], f"k{i + 1}": {"n": 2}, "lone": {"z": 1}}) for i in range(12)]
    want = paths(spark, payloads)
    monkeypatch.setattr(nested, "MAX_ARRAY_MEMBERS", 5)
    assert paths(spark, payloads) == want and len(want) == 23


def test_subtype_tables_hold_every_row(spark, tmp_path):
    r = rows(spark, [json.dumps({"P": [{"Id": 1}, {"Id": "x", "Q": [{"v": 1.5}, {"v": None}]}]}), json.dumps({"P": {"Id": 3}})])
    made = nested.subtype_tables(r, f"file://{tmp_path}/t", ["return_id"])
    assert sum(t.count() for t in made.values()) == 5
    assert {(k, dict(t.dtypes).get("Id")) for (k, s), t in made.items() if k == "$.P[]"} == {("$.P[]", "bigint"), ("$.P[]", "string")}
    assert sorted(x.Id for (k, _), t in made.items() if k == "$.P[]" and dict(t.dtypes)["Id"] == "bigint" for x in t.collect()) == [1, 3]
