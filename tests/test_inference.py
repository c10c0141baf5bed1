import json

import pytest
from pyspark.sql import functions as F

from harspan.operators import openapi, pagination, snippets
from harspan.operators.openapi import shape_of

SCHEMA = "call_id long, host string, path string, method string, url string, status int, request_headers map<string,string>, query_params map<string,string>, request_body_json string, response_body_json string"


def calls(spark, *rows):
    return spark.createDataFrame([(i, "h", p, "GET", f"https://h{p}", 200, {"A": "b c"}, q, s, b) for i, (p, q, s, b) in enumerate(rows)], SCHEMA)


def profile(spark, *rows):
    found = pagination.pagination_profiles(calls(spark, *[("/x", *r) for r in rows])).collect()
    assert len(found) == 1
    return found[0]


def test_numeric_paging(spark):
    r = profile(spark, ({"page": "1"}, None, None), ({"page": "2"}, None, None), ({"page": "3"}, None, None))
    assert (r.strategy, r.param_name, r.step_size, r.initial_value, round(r.confidence, 2), r.param_source) == ("PAGE", "page", 1, 1, 0.81, "query")
    r = profile(spark, ({"offset": "0"}, None, None), ({"offset": "20"}, None, None))
    assert (r.strategy, r.step_size, round(r.confidence, 2)) == ("OFFSET", 20, 0.74)
    r = profile(spark, ({"offset": "0"}, None, None))
    assert (r.strategy, r.step_size, r.confidence, r.sample_size) == ("OFFSET", 20, 0.25, 1)
    r = profile(spark, ({}, '{"skip": 5.9, "page": "5.9"}', None), ({}, '{"skip": 10}', None))
    assert (r.strategy, r.param_name, r.param_source, r.step_size, r.initial_value) == ("OFFSET", "skip", "body", 5, 5)


@pytest.mark.parametrize(
    "pages", [["1", "2", "4"], ["3", "2", "1"], ["1", "1"], ["1", "x"], ["1", None], ["2", "1", "3"], ["1", "3", "2", "4"], ["1", "2", "2", "4"]]
)
def test_no_numeric_paging(spark, pages):
    assert profile(spark, *[({"page": p}, None, None) for p in pages]).strategy == "NONE"


def test_missing_parameter_and_nothing(spark):
    assert profile(spark, ({"page": "1"}, None, None), ({"page": "2"}, None, None), ({}, None, None)).strategy == "NONE"
    r = profile(spark, (None, None, None), ({}, "[1]", None))
    assert (r.strategy, r.confidence, r.sample_size) == ("NONE", 0.0, 2)
    assert pagination.pagination_profiles(calls(spark, ("/x", None, None, None)).where("false")).count() == 0


def test_cursors(spark):
    r = profile(spark, ({}, None, '{"meta":{"next":"abc"},"list":["abc"]}'), ({"cursor": "abc"}, None, None))
    assert (r.strategy, r.param_name, r.cursor_json_path, r.confidence) == ("CURSOR", "cursor", "meta.next", 0.85)
    r = profile(spark, ({}, None, '{"list":["abc"]}'), ({}, '{"after": "abc"}', None))
    assert (r.strategy, r.param_name, r.cursor_json_path, r.confidence, r.param_source) == ("CURSOR", "after", None, 0.4, "body")
    r = profile(spark, ({}, None, '{"n":{"t":5}}'), ({}, '{"cursor": 5}', None))
    assert r.cursor_json_path == "n.t"


def test_sure_numbers_go_before_cursors(spark):
    r = profile(spark, ({"page": "1", "cursor": "a"}, None, None), ({"page": "2", "cursor": "b"}, None, None))
    assert r.strategy == "PAGE"
    assert profile(spark, ({"page": "1", "cursor": "a"}, None, None)).strategy == "CURSOR"


def test_shapes():
    assert shape_of(None, 1) == {"type": "integer", "nullable": True} == shape_of(1, None)
    assert shape_of("x", None) == {"type": "string"} and shape_of(None, "x") == shape_of(None) == {"type": "string", "nullable": True}
    assert shape_of(1, 1.5) == {"oneOf": [{"type": "integer"}, {"type": "number"}]} == shape_of(1, 1.5, 2)
    assert shape_of(1, 1.5, True, None) == {"oneOf": [{"type": "integer"}, {"type": "number"}, {"type": "boolean"}], "nullable": True}
    assert shape_of({"x": 1}, {"y": "a"}) == {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "string"}}}
    assert shape_of({"x": 1}, 5, {"y": None}) == {"oneOf": [{"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "string", "nullable": True}}}, {"type": "integer"}]}
    assert shape_of([True, 1, 2.0, "x", None, {}])["items"] == {"oneOf": [{"type": "boolean"}, {"type": "integer"}, {"type": "number"}, {"type": "string"}], "nullable": True}
    assert shape_of([]) == {"type": "array", "items": {"type": "string"}} and shape_of() is None
    assert shape_of([], [[1]])["items"] == {"oneOf": [{"type": "string"}, {"type": "array", "items": {"type": "integer"}}]}
    deep = {}
    for _ in range(40):
        deep = {"a": [deep]}
    assert json.dumps(shape_of(deep)).count("object") == 7


def test_schemas_against_all_bodies_at_once(spark):
    bodies = ['{"a":1,"b":[{"c":null}]}', '{"b":[{"c":"x","d":2.5}],"a":null}', "[1]", "no json", None, "", "null", '{"e":{}}', '{"a":"t","a.b":[]}']
    df = calls(spark, *[(f"/x/{i}", None, b if i % 2 else None, b) for i, b in enumerate(bodies)]).repartition(5)
    row = openapi.endpoint_schemas(df.withColumn("place", F.lit(1))).collect()
    assert len(row) == 1
    told = [json.loads(b) for b in bodies if b and b.startswith(("{", "["))]
    assert json.loads(row[0].response_schema) == shape_of(*told)
    assert json.loads(row[0].request_schema) == shape_of(json.loads(bodies[1]), json.loads(bodies[7]))
    assert openapi.endpoint_schemas(df.where("false")).count() == 0


def test_document(spark):
    df = calls(spark, ("/users/1", {"page": "1"}, '{"a":1}', '{"id":1}'), ("/users/2", {"page": "2", "q": "x"}, None, '{"id":null,"n":"x"}'), ("/", None, None, None))
    doc = openapi.openapi_document(df)
    get = doc["paths"]["/users/{userId}"]["get"]
    assert [p["name"] for p in get["parameters"]] == ["userId", "page", "q"]
    assert get["responses"]["200"]["content"]["application/json"]["schema"]["properties"] == {"id": {"type": "integer", "nullable": True}, "n": {"type": "string"}}
    assert get["requestBody"]["content"]["application/json"]["schema"] == {"type": "object", "properties": {"a": {"type": "integer"}}}
    assert get["x-pagination"]["strategy"] == "PAGE"
    assert doc["paths"]["/"]["get"]["responses"]["200"]["content"]["application/json"]["schema"] == {"type": "object"}
    json.dumps(doc)


def test_snippets(spark):
    df = calls(spark, ("/a", None, '{"k":"it\'s"}', None), ("/a", None, None, None), ("/b", None, None, None)).withColumn(
        "request_headers", F.when(F.col("call_id") == 2, F.lit(None)).otherwise(F.create_map(F.lit("Cookie"), F.lit("s=1"), F.lit("X"), F.lit("y z")))
    )
    rows = {r.endpoint: r for r in snippets.snippets(df).collect()}
    assert rows["/a"].curl_command == """curl -X GET https://h/a -H 'Cookie: <COOKIE>' -H 'X: y z' -d '{"k": "it'"'"'s"}'"""
    assert rows["/b"].curl_command == "curl -X GET https://h/b"
    assert "payload = {" in rows["/a"].python_requests and "json=payload" in rows["/a"].python_requests and "payload" not in rows["/b"].python_requests
    compile(rows["/a"].python_requests, "x", "exec")
    assert "s=1" in {r.endpoint: r for r in snippets.snippets(df, redact=False).collect()}["/a"].curl_command
