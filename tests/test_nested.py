"""Flat tables from nested records: identities, places, dirt."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.operators import nested as N

values = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text("ab .[~", max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text("ab.[~", min_size=1, max_size=2), c, max_size=3), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(values, values)
def test_hashes_are_equal_just_for_equal_trees(a, b):
    x, y = (json.loads(json.dumps(v), parse_int=N._Number) for v in (a, b))
    assert (N.merkle(x, {}) == N.merkle(y, {})) == (json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True))


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text("ab.[~", min_size=1, max_size=2), values, max_size=3))
def test_nodes_rebuild_the_record(record):
    seen: dict = {}
    root = N.merkle(json.loads(json.dumps(record), parse_int=N._Number), seen)

    def build(h):
        kind, literal, children, _ = seen[h]
        if kind == "object":
            return {k: build(c) for k, _, c in children}
        if kind == "array":
            return [build(c) for _, i, c in sorted(children, key=lambda x: x[1])]
        return {"null": lambda: None, "boolean": lambda: literal == "true", "number": lambda: int(literal), "string": lambda: literal}[kind]()

    assert build(root) == record


def test_separators_in_keys_do_not_run_together():
    one = N._Number("1")
    plain = {"a": one, "b": N._Number("2")}
    assert N.merkle(plain, {}) != N.merkle({"a\x1f" + N.merkle(one, {}) + "\x1fb": N._Number("2")}, {})
    assert N.merkle({"1:a": "b"}, {}) != N.merkle({"1": "a1:b"}, {}) and N.merkle("1", {}) != N.merkle(one, {})


def records(spark, payloads):
    return spark.createDataFrame([(i, p, "x") for i, p in enumerate(payloads, 1)], "record_no bigint, payload string, path string")


def test_places_lone_values_nulls_and_unreadable(spark):
    payloads = [
        '{"citations": [{"intents": ["a", null, " b ", ""]}, null, {"intents": "c"}, {"intents": [1, 2.50, true]}]}',
        '{"citations": {"intents": ["x"]}}', '{"citations": null}', "[]", "null", '{"a":', None, '{"citations": [[{"intents": ["deep"]}]]}', '{"citations.intents": "no"}', '{"citations": [{"intents": [["deep"]]}]}', '{"x": NaN}',
    ]
    nodes = N.subtrees(records(spark, payloads))
    got = sorted(tuple(r) for r in N.members(nodes, "f", ["citations", "intents"], [True, True]).collect())
    assert got == [("f", 1, 1, 1, "a"), ("f", 1, 1, 3, "b"), ("f", 1, 3, 1, "c"), ("f", 1, 4, 1, "1"), ("f", 1, 4, 2, "2.50"), ("f", 1, 4, 3, "true"), ("f", 2, 1, 1, "x")]
    assert sorted(tuple(r) for r in nodes.rejects.collect()) == [(4, "no object"), (5, "no object"), (6, "unreadable"), (7, "unreadable"), (11, "unreadable")]


def test_objects_are_stored_once_and_keep_every_place(spark):
    same = '{"author": {"id": "A1"}}'
    nodes = N.subtrees(records(spark, [f'{{"authorships": [{same}, {same}]}}', f'{{"authorships": [{same}]}}']))
    o = {(r.kind, r.literal): (r.n_places) for r in nodes.objects.collect() if r.kind == "string"}
    assert o == {("string", "A1"): 3} and nodes.objects.where("kind = 'object'").count() == 4
    assert nodes.bridges.where("key = 'id'").count() == 1
    assert N.members(nodes, "f", ["authorships", "author", "id"], [True, False, False]).count() == 3


def test_empty_table_and_long_values(spark):
    assert [d.count() for d in N.subtrees(records(spark, []))] == [0, 0, 0, 0]
    long = "x" * 300_000
    nodes = N.subtrees(records(spark, [json.dumps({"reference": [{"DOI": long}]})]))
    assert len(N.members(nodes, "f", ["reference", "DOI"], [True, False]).first().value) == 300_000


def test_deep_nesting_does_not_break(spark):
    deep = '{"reference": [{"DOI": "d", "x": ' + "[" * 2000 + "]" * 2000 + "}]}"
    worse = '{"reference": ' + "[" * 200_000 + "]" * 200_000 + "}"
    nodes = N.subtrees(records(spark, [deep, worse, '{"reference": {"DOI": "e"}}']))
    got = N.members(nodes, "f", ["reference", "DOI"], [True, False]).collect()
    assert {r.value for r in got} == {"d", "e"}
    assert [tuple(r) for r in nodes.rejects.collect()] == [(2, "unreadable")]
