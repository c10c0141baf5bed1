import json

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harspan.functions.json_bodies import body_rows, first_balanced, flat_cells, has_json, load
from harspan.functions.tokens import jwt_expiry
from harspan.operators import systems

values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab", min_size=1, max_size=2), x, max_size=3), max_leaves=12)


def test_rows_of_bodies():
    assert body_rows([{"a": 1}, {"a": 2}]) == [{"a": 1}, {"a": 2}]
    assert body_rows([1, "x"]) == [{"value": 1}, {"value": "x"}]
    assert body_rows({"rows": [{"a": 1}], "data": [{"a": 2}]}) == [{"a": 2}]
    assert body_rows({"data": {"a": 1}}) == [{"data": {"a": 1}}]
    assert body_rows([{"statusCode": 200, "tid": 1, "result": [{"n": "x"}, 5]}]) == [{"statusCode": 200, "tid": 1, "n": "x"}, {"statusCode": 200, "tid": 1, "value": 5}]
    assert body_rows([{"n": "env", "result": [{"n": "row"}]}]) == [{"n": "row"}]
    assert body_rows([{"tid": 1, "result": []}]) == []
    assert body_rows({"a": 1}) == [{"a": 1}] and body_rows("x") == [{"value": "x"}] and body_rows(None) == []


def test_flat_cells():
    assert flat_cells({"a": {"b": [1, {"c": 2}], "e": {}, "f": []}}) == {"a.b[0]": 1, "a.b[1].c": 2, "a.e": "{}", "a.f": "[]"}
    assert flat_cells({}) == {"": "{}"}
    deep = load("[" * 3000 + "]" * 3000)
    assert deep is None or len(flat_cells(deep)) == 1


@given(values)
def test_every_leaf_has_its_own_path(value):
    def leaves(v):
        if isinstance(v, (dict, list)) and v:
            return sum(map(leaves, v.values() if isinstance(v, dict) else v))
        return 1

    assert len(flat_cells({"r": value})) == leaves(value)


def test_json_or_not(spark):
    texts = ['{"a":1}', "null", "", None, "x", '{"k":1,"k":2}', "[]", "5", "{"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(has_json(F.col("t")).alias("j")).collect()
    assert [r.j for r in rows] == [True, False, False, False, False, True, True, True, False]


def test_union_of_keys_in_first_seen_order(spark):
    rows = [(1, "h", "/a/1", "GET", 200, "t", '[{"b":1},{"a":2,"b":3}]'), (2, "h", "/a/2", "POST", 201, "u", '{"c.d":null}'), (3, "", None, None, None, None, '{"z":1}')]
    calls = spark.createDataFrame(rows, "call_id long, host string, path string, method string, status int, started_at string, response_body_json string")
    found = systems.data_rows(calls)
    order = systems.column_order(found, "system", "path_template").where("path_template = '/a/{id}'").orderBy("place").collect()
    assert [r.key for r in order] == ["b", "a", "c.d"]
    wide = systems.wide_rows(found.where("path_template = '/a/{id}'").orderBy("call_id", "row_idx"), ["b", "a", "c.d"]).collect()
    assert [list(r)[:4] for r in wide] == [["1", "", "", "GET"], ["3", "2", "", "GET"], ["", "", "", "POST"]]
    cells = systems.data_cells(calls).where("call_id = 2").first()
    assert cells.key == "c.d" and cells.value is None and cells.kind == "null"


def test_balanced_object():
    assert first_balanced('x = {"a": {"b": 1}} y', "x") == '{"a": {"b": 1}}'
    assert first_balanced("x {", "x") is None and first_balanced("{}", "y") is None


def test_token_expiry(spark):
    import base64

    body = base64.urlsafe_b64encode(json.dumps({"exp": 1700000000, "n": "ü?>"}).encode()).decode().rstrip("=")
    tokens = [f"a.{body}.c", f"a.{body}", "a.!!.c", None, "a.e30.c"]
    rows = spark.createDataFrame([(t,) for t in tokens], "t string").select(jwt_expiry(F.col("t")).alias("e")).collect()
    assert [r.e for r in rows] == [1700000000, None, None, None, None]
