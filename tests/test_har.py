import json

import pytest
from pyspark.sql import functions as F

from harspan.functions.urls import url_host, url_path
from harspan.plans.analyze import analyze_archive, write_report, write_tables
from harspan.sources.har import read_har


def entry(url, body=None, method="GET", status=200, headers=(), query=(), sent=None):
    request = {"method": method, "url": url, "headers": [{"name": n, "value": v} for n, v in headers], "queryString": [{"name": n, "value": v} for n, v in query]}
    if sent is not None:
        request["postData"] = {"text": sent}
    content = {"mimeType": "application/json"}
    if body is not None:
        content["text"] = body
    return {"startedDateTime": "2024-01-01T00:00:00Z", "time": 1.5, "request": request,
            "response": {"status": status, "headers": [{"name": "Set-Cookie", "value": "a=1"}, {"name": "Set-Cookie", "value": "b=2"}], "content": content}}


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    folder = tmp_path_factory.mktemp("har")
    entries = [
        entry("https://u:p@Api.example:8443/users/12;v=1?ts=1&q={x}", '{"data":[{"id":1},{"id":2}]}', query=[("ts", "1"), ("q", "a"), ("q", "b")]),
        entry("https://api.example", "null"),
        entry("http://api.example/users/9/orders/7", '{"k":1,"k":2}', method="POST", sent='{"csrf":"x"}', headers=[("Authorization", "Bearer t")]),
        entry("https://api.example/x", "not json", status=500),
        entry("https://api.example/x"),
    ]
    (folder / "a.har").write_text(json.dumps({"log": {"entries": entries}}))
    (folder / "empty.har").write_text(json.dumps({"log": {"entries": []}}))
    (folder / "other.har").write_text(json.dumps({"nothing": 1}))
    (folder / "broken.har").write_text("{")
    return str(folder)


def test_calls_of_an_archive(spark, archive):
    calls = read_har(spark, archive).orderBy("call_id")
    rows = calls.collect()
    assert len(rows) == 5
    assert calls.select(F.map_keys("query_params").alias("k")).first().k == ["ts", "q"]
    first = rows[0]
    assert (first.host, first.path, first.method, first.status) == ("u:p@Api.example:8443", "/users/12", "GET", 200)
    assert first.query_params == {"ts": "1", "q": "b"}
    assert first.response_headers == {"Set-Cookie": "b=2"}
    assert rows[1].path == "/" and rows[1].response_body_json is None and rows[1].response_text_raw == "null"
    assert rows[2].response_body_json == '{"k":1,"k":2}' and rows[2].request_body_json == '{"csrf":"x"}'
    assert rows[3].response_body_json is None and rows[4].response_text_raw is None


def test_url_parts_never_fail(spark):
    urls = [("",), (None,), ("https://h",), ("//h/p",), ("/only/path?x#y",), ("https://h/a/d;e",), ("https://h/p;x/q",), ("mailto:me",)]
    rows = spark.createDataFrame(urls, "u string").select(url_host(F.col("u")).alias("h"), url_path(F.col("u")).alias("p")).collect()
    assert [tuple(r) for r in rows] == [("", "/"), ("", "/"), ("h", "/"), ("h", "/p"), ("", "/only/path"), ("h", "/a/d"), ("h", "/p;x/q"), ("", "me")]


def test_report_of_an_archive(spark, archive, tmp_path):
    found = analyze_archive(spark, archive)
    counts = write_report(found, str(tmp_path / "report.xlsx"))
    assert list(counts)[:5] == ["Overview", "Security Summary", "Security Findings", "Automation Status", "Bot Defense Findings"]
    assert counts["Overview"] == 2
    assert any(n.startswith("u_p@Api.example_8443") for n in counts)
    folders = write_tables(found, str(tmp_path / "tables"))
    assert spark.read.parquet(folders[0]).count() == 2
    curl = {r.endpoint: r.curl_command for r in found.snippets.collect()}
    assert "<AUTHORIZATION>" in curl["/users/9/orders/7"] and "Bearer" not in curl["/users/9/orders/7"]
    assert """-d '{"csrf": "x"}'""" in curl["/users/9/orders/7"]
