import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from harspan.operators import checks

SCHEMA = "call_id long, host string, path string, method string, url string, status int, response_headers map<string,string>, query_params map<string,string>, request_body_json string, response_text_raw string, started_at string"


def call(i=1, url="https://h/p", status=200, headers=None, query=None, sent=None, text=None, host="h", path="/p"):
    return (i, host, path, "GET", url, status, headers, query, sent, text, "t")


def found(spark, check, *calls):
    return [(r.call_id, r.severity, r.description, r.evidence) for r in checks.in_order(checks.scan(spark.createDataFrame(list(calls), SCHEMA), [check])).collect()]


def test_missing_headers(spark):
    rows = found(spark, checks.missing_headers, call(), call(2, headers={"STRICT-Transport-Security": "x", "content-security-policy": "y"}))
    assert [(r[0], r[1]) for r in rows] == [(1, "medium"), (1, "low"), (1, "low"), (1, "low"), (2, "low"), (2, "low")]


@pytest.mark.parametrize(
    "text,label",
    [
        ("AKIA" + "A1" * 8, "AWS Access Key"),
        ("aws_secret_access_key = " + "a" * 40, "AWS Secret Key (heuristic)"),
        ('"client_secret": "abcdefghijkl"', "Generic API Key field"),
        ("eyJa.b.c", "JWT"),
        ("-----BEGIN RSA PRIVATE KEY-----", "Private key block"),
        ("xoxb-1234567890", "Slack token"),
        ("sk_live_" + "a" * 16, "Stripe key"),
        ("AIza" + "b" * 35, "Google API key"),
    ],
)
def test_secrets(spark, text, label):
    rows = found(spark, checks.exposed_secrets, call(text=f"x {text} y"))
    assert [(r[1], r[2]) for r in rows] == [("high", f"{label} found in response_body")]
    assert rows[0][3] == ("***" if len(text) <= 12 else f"{text[:6]}...{text[-4:]}")


def test_secrets_in_request_and_url(spark):
    rows = found(spark, checks.exposed_secrets, call(sent='{"api_key": "abcdefghijklmn"}', url="https://h/?k=AKIA" + "Z" * 16))
    assert [r[2] for r in rows] == ["Generic API Key field found in request_body", "AWS Access Key found in url"]


def test_cookies(spark):
    assert [r[1] for r in found(spark, checks.weak_cookies, call(headers={"set-cookie": "a=b"}))] == ["medium", "medium", "low"]
    assert [r[1] for r in found(spark, checks.weak_cookies, call(url="http://h", headers={"Set-Cookie": "a=b"}))] == ["medium", "low"]
    assert found(spark, checks.weak_cookies, call(headers={"Set-Cookie": "a=b; Secure; HttpOnly; SameSite=Lax"}), call(2), call(3, headers={"Set-Cookie": ""})) == []


def test_cors_transport_errors(spark):
    wild = {"Access-Control-Allow-Origin": "*", "Access-Control-Allow-Credentials": "TRUE"}
    assert len(found(spark, checks.open_cors, call(headers=wild), call(2, headers={**wild, "Access-Control-Allow-Origin": "x"}))) == 1
    assert len(found(spark, checks.plain_transport, call(url="http://h"), call(2), call(3, url=None))) == 1
    trace = "Traceback (most recent call last)"
    assert [r[2] for r in found(spark, checks.verbose_errors, call(status=500, text=trace), call(2, text=trace), call(3, status=None, text=trace))] == ["Stack trace exposed in 500 response body"]


def test_bot_signals(spark):
    assert [r[1] for r in found(spark, checks.captchas, call(text="<div class=g-recaptcha>"), call(2))] == ["blocker"]
    rows = found(spark, checks.bot_vendors, call(status=403, headers={"cf-mitigated": "challenge"}))
    assert [r[1] for r in rows] == ["blocker", "high"]
    rows = found(spark, checks.fragile_requests, call(query={"ts": "1", "csrf": "x", "q": "1"}), call(2, sent='{"nonce":1,"a":2}'), call(3, sent="[1]"))
    assert ["csrf, ts" in rows[0][2], "nonce" in rows[1][2], len(rows)] == [True, True, 2]


def test_endpoint_status_and_summary(spark):
    calls = spark.createDataFrame(
        [call(1, path="/a", text="hcaptcha.com"), call(2, path="/a", query={"ts": "1"}), call(3, path="/b", query={"sig": "1"}), call(4, path="/c"), call(5, host=None, path=None)], SCHEMA
    )
    rows = {(r.system, r.endpoint): r.automation_status for r in checks.endpoint_status(calls).collect()}
    assert rows == {("h", "/a"): "blocked", ("h", "/b"): "fragile", ("h", "/c"): "likely automatable", (None, None): "likely automatable"}
    summary = checks.summarize_findings(checks.scan(calls, checks.SECURITY_CHECKS)).collect()
    assert [(r.system, r.medium, r.low, r.total) for r in summary] == [("h", 4, 12, 16), (None, 1, 3, 4)]


def test_own_check_and_empty_table(spark):
    own = lambda: checks.those((F.col("status") == 418, checks.finding("Own", "info", "teapot")))
    assert [r[1] for r in found(spark, own, call(status=418), call(2))] == ["info"]
    empty = spark.createDataFrame([], SCHEMA)
    assert checks.scan(empty, [*checks.SECURITY_CHECKS, *checks.BOT_CHECKS]).count() == 0
    assert isinstance(checks.summarize_findings(checks.scan(empty, checks.BOT_CHECKS)).first(), (type(None), Row))
