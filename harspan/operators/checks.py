"""Passive checks of captured calls: security findings and signs that a call resists automation.

A check is a function from nothing to an array column of findings, evaluated per call inside the JVM; ``scan`` takes any
list of checks, so callers may add their own. Nothing is sent anywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import has_header, header, header_text
from ..functions.json_bodies import body_keys

Check = Callable[[], Column]

# Headers, patterns and texts of the findings.
SECURITY_HEADERS = [
    ("strict-transport-security", "Missing HSTS header", "medium"),
    ("content-security-policy", "Missing Content-Security-Policy header", "low"),
    ("x-content-type-options", "Missing X-Content-Type-Options header", "low"),
    ("x-frame-options", "Missing X-Frame-Options / frame-ancestors CSP", "low"),
]
SECRETS = [
    ("AWS Access Key", r"AKIA[0-9A-Z]{16}"),
    ("AWS Secret Key (heuristic)", r"(?i)aws_secret_access_key[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9/+=]{40}"),
    ("Generic API Key field", r"(?i)\"(api[_-]?key|apikey|secret|client_secret)\"\s*:\s*\"[A-Za-z0-9\-_]{12,}\""),
    ("JWT", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    ("Private key block", r"-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    ("Slack token", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    ("Stripe key", r"sk_live_[A-Za-z0-9]{16,}"),
    ("Google API key", r"AIza[0-9A-Za-z\-_]{35}"),
]
ERROR_LEAKS = [
    ("Stack trace", r"(?i)(traceback \(most recent call last\)|at\s+\S+\(\S+:\d+:\d+\)|\.java:\d+\))"),
    ("SQL error", r"(?i)(sql syntax|sqlstate|ORA-\d{5}|unclosed quotation mark)"),
    ("Debug info", r"(?i)(DEBUG = ?True|django\.core\.handlers|werkzeug\.debug)"),
]
CAPTCHAS = [
    ("reCAPTCHA", r"(?i)(recaptcha/api\.js|g-recaptcha|grecaptcha)"),
    ("hCaptcha", r"(?i)(hcaptcha\.com|h-captcha)"),
    ("Cloudflare Turnstile", r"(?i)(challenges\.cloudflare\.com/turnstile|cf-turnstile)"),
    ("FunCaptcha/Arkose", r"(?i)(arkoselabs|funcaptcha)"),
    ("Generic CAPTCHA JSON", r"(?i)\"captcha[_-]?(token|required|challenge)\""),
]
BOT_VENDORS = [
    ("Cloudflare Bot Management", r"(?i)(cf-mitigated|__cf_bm|cf-ray)"),
    ("Akamai Bot Manager", r"(?i)(_abck|akamai-bot|sensor_data)"),
    ("PerimeterX / HUMAN", r"(?i)(_px[0-9]?=|perimeterx|px-captcha)"),
    ("DataDome", r"(?i)(datadome|dd_cookie)"),
    ("FingerprintJS", r"(?i)(fingerprintjs|fpjs\.io|/fp/)"),
]
CHALLENGE = r"(?i)cf-mitigated"
FRAGILE_NAMES = r"(?i)^(csrf|xsrf|nonce|_token|timestamp|ts|expires|signature|sig)$"
SEVERITIES = {"blocker": 0, "high": 1, "medium": 2, "low": 3, "info": 4}
FINDING = "struct<category:string,severity:string,description:string,evidence:string>"


def finding(category: str, severity: str, description: Column | str, evidence: Column | str = "") -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(
        F.lit(category).alias("category"), F.lit(severity).alias("severity"), as_column(description).alias("description"), as_column(evidence).alias("evidence")
    )


def those(*cases: tuple[Column, Column]) -> Column:
    """The findings whose condition holds, in order."""
    told = [F.when(F.coalesce(condition, F.lit(False)), found) for condition, found in cases]
    return F.filter(F.array(*told), lambda f: f.isNotNull())


def _response() -> Column:
    return F.coalesce(F.col("response_text_raw"), F.lit(""))


def missing_headers() -> Column:
    return those(*[(~has_header(F.col("response_headers"), h), finding("Missing security header", s, m, h)) for h, m, s in SECURITY_HEADERS])


def masked(secret: Column) -> Column:
    """The first six and last four characters of what is longer than twelve."""
    return F.when(F.length(secret) > 12, F.concat(F.left(secret, F.lit(6)), F.lit("..."), F.right(secret, F.lit(4)))).otherwise(F.lit("***"))


def exposed_secrets() -> Column:
    """The first secret of each kind in response, request body and URL. Bodies are searched as the JSON text sent."""
    cases = []
    for place, text in (("response_body", _response()), ("request_body", F.coalesce("request_body_json", F.lit(""))), ("url", F.coalesce("url", F.lit("")))):
        for label, pattern in SECRETS:
            hit = F.regexp_extract(text, pattern, 0)
            cases.append((hit != "", finding("Exposed secret", "high", f"{label} found in {place}", masked(hit))))
    return those(*cases)


def weak_cookies() -> Column:
    cookie = header(F.col("response_headers"), "set-cookie")
    low, start = F.lower(cookie), F.left(cookie, F.lit(60))
    given = F.length(cookie) > 0
    return those(
        (given & F.col("url").startswith("https://") & ~low.contains("secure"), finding("Weak cookie flag", "medium", "Set-Cookie missing Secure flag over HTTPS", start)),
        (given & ~low.contains("httponly"), finding("Weak cookie flag", "medium", "Set-Cookie missing HttpOnly flag", start)),
        (given & ~low.contains("samesite"), finding("Weak cookie flag", "low", "Set-Cookie missing SameSite attribute", start)),
    )


def open_cors() -> Column:
    origin = header(F.col("response_headers"), "access-control-allow-origin")
    credentials = header(F.col("response_headers"), "access-control-allow-credentials")
    text = "Wildcard Access-Control-Allow-Origin combined with allow-credentials: true"
    return those(((origin == "*") & (F.lower(credentials) == "true"), finding("CORS misconfiguration", "high", text, "Access-Control-Allow-Origin: *")))


def plain_transport() -> Column:
    return those((F.col("url").startswith("http://"), finding("Insecure transport", "high", "Call made over plain HTTP, not HTTPS", F.col("url"))))


def verbose_errors() -> Column:
    failed = (F.col("status") >= 400) & (_response() != "")
    told = lambda label: F.concat(F.lit(f"{label} exposed in "), F.col("status").cast("string"), F.lit(" response body"))
    return those(*[(failed & _response().rlike(p), finding("Verbose error disclosure", "medium", told(label))) for label, p in ERROR_LEAKS])


def captchas() -> Column:
    return those(*[(_response().rlike(p), finding("CAPTCHA detected", "blocker", f"{label} present in response body")) for label, p in CAPTCHAS])


def bot_vendors() -> Column:
    told = header_text(F.col("response_headers"))
    text = F.concat(told, F.lit(" "), _response())
    cases = [(text.rlike(p), finding("Bot-defense signal", "high", f"{label} detected (headers/cookies or body)")) for label, p in BOT_VENDORS]
    challenge = (F.col("status") == 403) & told.rlike(CHALLENGE)
    return those(*cases, (challenge, finding("Bot-defense signal", "blocker", "403 response with Cloudflare challenge marker")))


def fragile_names() -> Column:
    """Names of short-lived values among query parameters and top-level body keys, in order."""
    none = F.array().cast("array<string>")
    names = F.array_union(F.coalesce(F.map_keys("query_params"), none), F.coalesce(body_keys(F.col("request_body_json")), none))
    return F.array_sort(F.filter(names, lambda n: n.rlike(FRAGILE_NAMES)))


def fragile_requests() -> Column:
    names = F.array_join(fragile_names(), ", ")
    text = F.concat(F.lit("Depends on short-lived value(s): "), names, F.lit(" -- captured request will likely fail if replayed verbatim later"))
    return those((names != "", finding("Replay-fragile request", "medium", text)))


SECURITY_CHECKS: list[Check] = [missing_headers, exposed_secrets, weak_cookies, open_cors, plain_transport, verbose_errors]
BOT_CHECKS: list[Check] = [captchas, bot_vendors, fragile_requests]


def scan(calls: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per finding, with the places of its check and within it, so that ``in_order`` can sort them stably."""
    found = F.transform(F.array(*[c() for c in checks]), lambda fs, i: F.transform(fs, lambda f, j: F.struct(i.alias("check_idx"), j.alias("sub_idx"), f.alias("f"))))
    flat = calls.select("call_id", "host", "path", "method", "url", "status", "started_at", F.explode(F.flatten(found)).alias("x"))
    return flat.select(
        "call_id", F.col("x.check_idx").alias("check_idx"), F.col("x.sub_idx").alias("sub_idx"),
        F.col("host").alias("system"), F.col("path").alias("endpoint"), "method", "url", "status", "x.f.*", "started_at",
    )


def in_order(findings: DataFrame) -> DataFrame:
    """Findings by severity, then as the calls and checks came."""
    rank = F.coalesce(F.element_at(F.create_map(*[x for k, v in SEVERITIES.items() for x in (F.lit(k), F.lit(v))]), F.col("severity")), F.lit(9))
    return findings.orderBy(rank, "call_id", "check_idx", "sub_idx")


def summarize_findings(findings: DataFrame) -> DataFrame:
    """Findings per system and severity with their total, most first."""
    counts = [F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low", "info")]
    return findings.groupBy("system").agg(*counts, F.count(F.lit(1)).alias("total"), F.min("call_id").alias("first")).orderBy(F.desc("total"), "first").drop("first")


def endpoint_status(calls: DataFrame) -> DataFrame:
    """Per host and literal path whether calls look blocked, fragile or likely automatable, with the first method seen.

    Findings are not joined back: the worst flag of an endpoint is an aggregate over its own calls.
    """
    flag = F.when((F.size(captchas()) > 0) | (F.size(bot_vendors()) > 0), 2).when(F.size(fragile_requests()) > 0, 1).otherwise(0)
    per = calls.select(F.col("host").alias("system"), F.col("path").alias("endpoint"), "method", "call_id", flag.alias("flag"))
    worst = per.groupBy("system", "endpoint").agg(F.max("flag").alias("flag"), F.min(F.struct("call_id", "method")).alias("first"))
    told = F.when(F.col("flag") == 2, "blocked").when(F.col("flag") == 1, "fragile").otherwise("likely automatable")
    return worst.orderBy("first.call_id").select("system", "endpoint", "first.method", told.alias("automation_status"))
