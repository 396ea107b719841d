import json

import pytest

from docprep.operators.nested import Shape, _parse_iteratively, element_files, element_key, flatten_records, parse, strings_in


def flat(spark, rows, schema="record_id bigint, payload string"):
    tables = flatten_records(spark.createDataFrame(rows, schema))
    return tables, sorted((tuple(r) for r in element_files(tables).collect()), key=str)


def test_links_files_and_nesting(spark):
    payload = {"elements": [{"ObjectID": 1, "filePaths": [["a", {"p": "b"}], "a"], "x": {"ObjectID": None, "Kids": [{"ObjectID": "02", "Text": '{"ObjectID": 9}'}]}}, {"Kids": []}]}
    tables, rows = flat(spark, [(7, json.dumps(payload))])
    assert rows == [(7, 1, 2, ""), (7, None, 1, "a"), (7, None, 1, "b")]
    e = {r.object_id: r for r in tables["element"].collect()}
    f = tables["file"].collect()
    assert e[2].parent_pk == e[1].pk and {r.parent_pk for r in f} == {e[1].pk} and e[2].text == '{"ObjectID": 9}'


def test_nulls_broken_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, '{"ObjectID": 4', "x"), (4, '{"ObjectID": 4}', "x"), (5, '{"ObjectID": 4}', "x"), (6, '[NaN, {"ObjectID": 1}]', "x"), (None, '{"ObjectID": 8}', "x")]
    got = {(r.record_id, r.object_id) for r in flatten_records(spark.createDataFrame(rows, "record_id bigint, payload string, tag string"))["element"].collect()}
    assert got == {(4, 4), (5, 4), (None, 8)}


def test_empty_table(spark):
    tables = flatten_records(spark.createDataFrame([], "record_id bigint, payload string"))
    assert all(t.count() == 0 for t in tables.values())


def test_very_deep_payload(spark):
    depth = 30_000
    payload = "".join('{"ObjectID":%d,"Kids":[' % i for i in range(depth)) + "]}" * depth
    tables, _ = flat(spark, [(1, payload)])
    assert tables["element"].count() == depth
    assert tables["element"].where("object_id = parent_object_id + 1").count() == depth - 1


@pytest.mark.parametrize("value,key", [(3, 3), ("007", 7), ("x", None), ("", None), (True, None), (2.0, 2), (2.5, None), (None, None), (2**63, None), ("9" * 30, None), (-4, -4), ([1], None)])
def test_keys(value, key):
    assert element_key(value) == key


def test_strings_are_distinct_and_in_order():
    assert strings_in(["b", {"k": ["a", "b", None, 3]}, "c"]) == ["b", "a", "c"]


@pytest.mark.parametrize("s", ['{"a":[1,-2.5e3,{"b":"c\\u00e9"}],"d":null}', " [ ] ", '"x"', "true", "[[],{}]"])
def test_iterative_parser_agrees(s):
    assert _parse_iteratively(s) == json.loads(s)


@pytest.mark.parametrize("s", ["", "[1,]", '{"a"}', "[1 2]", "nul", '{"a":1}}', "[", "{1:2}"])
def test_iterative_parser_refuses(s):
    with pytest.raises(ValueError):
        _parse_iteratively(s)
    assert parse(s) is None


def test_other_field_names(spark):
    shape = Shape(key="id", files="attachments")
    t = flatten_records(spark.createDataFrame([(1, '{"id":1,"attachments":{"x":"y"}}')], "r bigint, body string"), "r", "body", shape)
    assert [r.file_path for r in t["file"].collect()] == ["y"]
