"""Queries of the library's own operators, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import registry_day
from ..functions.headers import redacted
from ..functions.json_bodies import balanced_object, has_json
from ..functions.paths import is_dynamic, named_template, plain_template
from ..functions.text import unbreak
from ..functions.tokens import jwt_expiry
from ..functions.urls import url_host, url_path
from ..operators import checks, dedup, openapi, packed_values, pagination, picking, registry, search, snapshot_diff, snippets, systems
from ..session import read_table
from ..sinks.xlsx import column_widths
from ..sources.har import calls_table, parse_archives
from .probe import probe_calls, probe_sql

VALUE_FIELDS = ["licenseActivities", "licenseArabicActivities"]
CLEANED = ["customerName", "customerArabicName", "licAddress", "licArabicAddress", "licManagerName", "licManagerArabicName", "licenseStatus",
           "customerRegistrationStatus"]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every activity of both fields with its place."""
    known = packed_values.load_dictionary(read_table(spark, d, "activity_list"), "name_en", "name_ar")
    return packed_values.unpack_values(read_table(spark, d, "registry_rows"), "rec_id", VALUE_FIELDS, known)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Licences that came, went or changed from one snapshot to the next."""
    return snapshot_diff.licence_changes(read_table(spark, d, "licence_snapshots")).select("snapshot_no", "licno", "change_kind")


def p5_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same with old and new values."""
    return snapshot_diff.licence_changes(read_table(spark, d, "licence_snapshots"))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    return calls_table(read_table(spark, d, "calls"))


def system_summary(spark: SparkSession, d: str) -> DataFrame:
    return systems.summarize_systems(_calls(spark, d))


def url_split(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("url")
    return read_table(spark, d, "calls").select("call_id", url_host(url).alias("host"), url_path(url).alias("path"))


def path_template(spark: SparkSession, d: str) -> DataFrame:
    keyed = read_table(spark, d, "calls").select(F.coalesce("method", F.lit("GET")).alias("method"), plain_template(F.col("path")).alias("template"))
    return keyed.groupBy("method", "template").agg(F.count(F.lit(1)).alias("n_calls"))


def dynamic_segments(spark: SparkSession, d: str) -> DataFrame:
    flat = read_table(spark, d, "calls").select(F.explode(F.split("path", "/")).alias("segment")).where("segment <> ''")
    return flat.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).select("segment", "n", is_dynamic(F.col("segment")).alias("is_dynamic"))


def named_templates(spark: SparkSession, d: str) -> DataFrame:
    found = read_table(spark, d, "calls").select(named_template(F.col("path")).alias("t"))
    return found.groupBy(F.col("t.template").alias("template"), F.array_join(F.map_keys("t.params"), ",").alias("params")).agg(F.count(F.lit(1)).alias("n_calls"))


def json_bodies(spark: SparkSession, d: str) -> DataFrame:
    calls = read_table(spark, d, "calls")
    flag = has_json(F.col("response_text_raw"))
    return calls.groupBy(flag.alias("has_json")).agg(F.count(F.lit(1)).alias("n_calls"))


def event_cells(spark: SparkSession, d: str) -> DataFrame:
    """Flat cells of the JSON text that events carry."""
    events = read_table(spark, d, "events").select(
        F.col("event_id").alias("call_id"), F.lit("events").alias("host"), F.lit("/events").alias("path"), F.col("props").alias("response_body_json")
    )
    return systems.data_cells(events).select("call_id", "key", "value", "kind")


def envelope_rows(spark: SparkSession, d: str) -> DataFrame:
    """Licences that answers of the directory show: one row per item of each envelope."""
    rows = systems.data_rows(_calls(spark, d))
    has = F.map_contains_key("cells", "licNo")
    kept = rows.where(has & F.col("cells")["licNo"].isNotNull())
    return kept.groupBy(F.col("cells")["licNo"].alias("licno"), F.col("cells")["tid"].alias("tid")).agg(F.count(F.lit(1)).alias("n_rows"))


def data_cells(spark: SparkSession, d: str) -> DataFrame:
    return systems.data_cells(_calls(spark, d))


def column_order(spark: SparkSession, d: str) -> DataFrame:
    return systems.column_order(systems.data_rows(_calls(spark, d)), "system", "path_template")


def _found(spark: SparkSession, d: str, check: checks.Check) -> DataFrame:
    return checks.scan(probe_calls(spark, d), [check]).select("call_id", "sub_idx", "category", "severity", "description", "evidence")


def missing_headers(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.missing_headers).select("call_id", "severity", "evidence")


def secrets_masked(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.exposed_secrets).select("call_id", "description", "evidence")


def weak_cookies(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.weak_cookies).select("call_id", "severity", "description", "evidence")


def cors(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.open_cors).select("call_id", "severity", "evidence")


def transport(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.plain_transport).select("call_id", "evidence")


def verbose_errors(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.verbose_errors).select("call_id", "description")


def captcha_signals(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.captchas).select("call_id", "description")


def vendor_signals(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, checks.bot_vendors).select("call_id", "severity", "description")


def fragile_params(spark: SparkSession, d: str) -> DataFrame:
    names = F.array_join(checks.fragile_names(), ", ")
    return probe_calls(spark, d).select("call_id", names.alias("names")).where("names <> ''")


def findings_pivot(spark: SparkSession, d: str) -> DataFrame:
    return checks.summarize_findings(checks.scan(probe_calls(spark, d), checks.SECURITY_CHECKS))


def security_findings(spark: SparkSession, d: str) -> DataFrame:
    found = checks.scan(probe_calls(spark, d), checks.SECURITY_CHECKS)
    return found.groupBy("system", "category", "severity").agg(F.count(F.lit(1)).alias("n_findings"))


def endpoint_status(spark: SparkSession, d: str) -> DataFrame:
    return checks.endpoint_status(probe_calls(spark, d))


def first_example(spark: SparkSession, d: str) -> DataFrame:
    calls = read_table(spark, d, "calls").select("call_id", "host", "method", "path", "status")
    return dedup.first_per_key(calls, [F.col("host"), F.col("method"), F.col("path")], [F.col("call_id")])


def redacted_headers(spark: SparkSession, d: str) -> DataFrame:
    calls = read_table(spark, d, "calls")
    own = F.coalesce("request_headers", F.create_map().cast("map<string,string>"))
    given = F.map_concat(own, F.create_map(F.lit("Authorization"), F.concat(F.lit("Bearer "), F.md5(F.col("call_id").cast("string")))))
    return calls.select("call_id", F.explode(redacted(given)).alias("name", "value"))


def curl_snippet(spark: SparkSession, d: str) -> DataFrame:
    found = snippets.snippets(_calls(spark, d))
    return found.select("system", "method", "endpoint", "status_seen", "curl_command")


def request_scripts(spark: SparkSession, d: str) -> DataFrame:
    return snippets.snippets(_calls(spark, d)).select("system", "method", "endpoint", "python_requests")


def html_clean(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "registry_rows").select("rec_id", unbreak(F.col("licAddress")).alias("address"))


def registry_clean(spark: SparkSession, d: str) -> DataFrame:
    df = read_table(spark, d, "registry_rows")
    return registry.clean_fields(df).select("rec_id", *CLEANED)


def registry_export(spark: SparkSession, d: str) -> DataFrame:
    return registry.export_rows(read_table(spark, d, "registry_rows"))


def registry_names(spark: SparkSession, d: str) -> DataFrame:
    return registry.name_rows(read_table(spark, d, "registry_rows"))


def registry_payload(spark: SparkSession, d: str) -> DataFrame:
    """Records read from payloads made of whole registry rows."""
    rows = read_table(spark, d, "registry_rows")
    record = F.struct(
        F.col("customerName").alias("companyName"), F.col("licNo").alias("license_no"), F.col("licIssueDate").alias("issueDate"), F.col("licAddress").alias("address"),
        F.struct(F.col("licManagerName").alias("name")).alias("manager"), F.col("licenseStatus").alias("status"),
    )
    payload = rows.select("rec_id", F.to_json(F.struct(F.array(record).alias("results"))).alias("j"))
    return registry.payload_records(payload, "j").drop("record_idx")


def date_normalize(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "registry_rows").select("rec_id", registry_day(F.col("licIssueDate")).alias("issued"), registry_day(F.col("licExpDate")).alias("expires"))


def order_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Days of order times given as seconds and as milliseconds."""
    orders = read_table(spark, d, "orders")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return orders.select("o_orderkey", registry_day(seconds).alias("by_seconds"), registry_day((seconds * 1000).cast("string")).alias("by_millis"))


def token_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Expiry of tokens made of event numbers."""
    events = read_table(spark, d, "events")
    claims = F.concat(F.lit('{"sub":"'), F.col("user_id").cast("string"), F.lit('","exp":'), (F.col("event_id") + 1_700_000_000).cast("string"), F.lit("}"))
    body = F.translate(F.rtrim(F.base64(F.encode(claims, "utf-8")), F.lit("=")), "+/", "-_")
    return events.select("event_id", jwt_expiry(F.concat(F.lit("e30."), body, F.lit(".sig"))).alias("exp"))


def balanced_json(spark: SparkSession, d: str) -> DataFrame:
    """The first object of each answer of the directory behind the word result."""
    calls = read_table(spark, d, "calls")
    return calls.select("call_id", balanced_object(F.col("response_text_raw"), "result").alias("object")).where("object is not null")


def dedup_keep_null(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "licNo", "customerName")
    return dedup.deduplicate(rows, "licNo", [F.col("rec_id")])


def composite_key_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "licNo", "customerName", "customerRegistrationNumber")
    key = dedup.licence_key(F.col("licNo"), F.col("customerName"), F.col("customerRegistrationNumber"))
    return dedup.first_per_key(rows.withColumn("licence_key", key), [F.col("licence_key")], [F.col("rec_id")]).select("rec_id", "licence_key")


def anti_seen(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "licNo")
    snapshots = read_table(spark, d, "licence_snapshots").where("licNo is not null").select(F.col("licNo").alias("key")).distinct()
    return dedup.not_seen(rows, F.col("licNo"), snapshots)



def capped_search_names(spark: SparkSession, d: str) -> DataFrame:
    return search.leaf_search(read_table(spark, d, "registry_rows").select("rec_id", "customerName"), "customerName", 20)


def capped_search_keep(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "customerName")
    return search.kept_search(rows, "customerName", [F.col("rec_id")], 20)


def capped_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "search_id")
    return search.capped_rows(rows, "search_id", [F.col("rec_id")], 3)


def rows_added_per_term(spark: SparkSession, d: str) -> DataFrame:
    """How many new licences each search brought, the first search counting."""
    rows = read_table(spark, d, "registry_rows").where("length(licNo) > 0").select("rec_id", "search_id", "licNo")
    first = dedup.first_per_key(rows, [F.col("licNo")], [F.col("search_id"), F.col("rec_id")])
    return first.groupBy("search_id").agg(F.count(F.lit(1)).alias("n_added"))


def pending_terms(spark: SparkSession, d: str) -> DataFrame:
    return search.pending_terms(read_table(spark, d, "search_log"))


def pagination_numeric(spark: SparkSession, d: str) -> DataFrame:
    """Paging by numbers, over all calls of each endpoint."""
    keyed = pagination.endpoint_calls(_calls(spark, d))
    return pagination.numeric_profiles(keyed).select("method", "path_template", F.col("key").alias("param_name"), "strategy", F.col("step").alias("step_size"), F.col("first").alias("initial_value"), F.round("confidence", 4).alias("confidence"))


def pagination_profiles(spark: SparkSession, d: str) -> DataFrame:
    return pagination.pagination_profiles(_calls(spark, d))


def pagination_cursor(spark: SparkSession, d: str) -> DataFrame:
    """Calls given a cursor that the response before them shows."""
    calls = _calls(spark, d)
    token = lambda n: F.md5(n.cast("string"))
    planted = calls.withColumns(
        {
            "query_params": F.create_map(F.lit("cursor"), token(F.col("call_id") - 1)),
            "response_body_json": F.concat(F.lit('{"meta":{"next":"'), token(F.col("call_id")), F.lit('"}}')),
        }
    )
    return pagination.cursor_profiles(pagination.endpoint_calls(planted)).select("method", "path_template", F.col("key").alias("param_name"), F.col("path").alias("cursor_json_path"), "confidence")


def status_sets(spark: SparkSession, d: str) -> DataFrame:
    return systems.status_sets(_calls(spark, d))


def param_union(spark: SparkSession, d: str) -> DataFrame:
    return systems.parameter_union(_calls(spark, d))


def endpoint_schemas(spark: SparkSession, d: str) -> DataFrame:
    found = openapi.endpoint_schemas(_calls(spark, d))
    return found.select("method", "path_template", "response_schema", "request_schema")


def post_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls by POST whose URL names the remote entry point."""
    return picking.matching(_calls(spark, d), url_has="apexremote", method="POST").select("call_id", "path", "status")


def host_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls of hosts with a word in their name."""
    return picking.matching(_calls(spark, d), host_has="zone").select("call_id", "host", "url")


def body_matches(spark: SparkSession, d: str) -> DataFrame:
    return picking.matching(_calls(spark, d), body_has="LLC").select("call_id")


def first_last_calls(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last call of each method and host that hold a JSON body."""
    calls = _calls(spark, d).where("response_body_json is not null")
    both = [picking.first_match(calls, "host", "method", last=last).select(F.lit(name).alias("which"), "host", "method", "call_id") for name, last in (("first", False), ("last", True))]
    return both[0].unionByName(both[1])


def running_unique_total(spark: SparkSession, d: str) -> DataFrame:
    """How many different licences are known after each search that brought one."""
    return picking.running_total(rows_added_per_term(spark, d), "n_added", "search_id")


def file_names(spark: SparkSession, d: str) -> DataFrame:
    calls = read_table(spark, d, "calls")
    return calls.groupBy(picking.file_name(F.col("host"), F.col("path")).alias("file_name")).agg(F.count(F.lit(1)).alias("n_calls"))


def bot_findings(spark: SparkSession, d: str) -> DataFrame:
    found = checks.scan(probe_calls(spark, d), checks.BOT_CHECKS)
    return found.groupBy("system", "category", "severity").agg(F.count(F.lit(1)).alias("n_findings"))


def har_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls read back from archives of one entry each, written as such captures are."""
    calls = read_table(spark, d, "calls")
    pairs = lambda c: F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    request = F.struct("method", "url", pairs("request_headers").alias("headers"), pairs("query_params").alias("queryString"), F.struct(F.col("request_body_json").alias("text")).alias("postData"))
    content = F.struct(F.col("mime_type").alias("mimeType"), F.col("response_text_raw").alias("text"))
    entry = F.struct(F.col("started_at").alias("startedDateTime"), F.col("time_ms").alias("time"), request.alias("request"),
                     F.struct("status", pairs("response_headers").alias("headers"), content.alias("content")).alias("response"))
    archives = calls.select(F.col("call_id").alias("file_no"), F.to_json(F.struct(F.struct(F.array(entry).alias("entries")).alias("log"))).alias("value"))
    back = parse_archives(archives)
    return back.select(F.shiftright("call_id", 24).alias("call_id"), "host", "path", "method", "url", "status", "mime_type", "started_at", "time_ms", "response_text_raw",
                       F.array_join(F.array_sort(F.map_keys("query_params")), ",").alias("params"), F.col("request_body_json").isNotNull().alias("sent"))


def body_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of the outermost values of JSON answers, per endpoint."""
    places = openapi.body_places(pagination.endpoint_calls(_calls(spark, d))).where("side = 0 and place = '[]'")
    return places.select("method", "path_template", "kind", "n_calls")


def letter_sweep(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "customerName")
    return search.letter_sweep(rows, "customerName", [F.col("rec_id")], 100)


def split_search(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "registry_rows").select("rec_id", "licNo", "customerName")
    return search.split_search(rows, "customerName", "licNo", [F.col("rec_id")], 100, 50)


def term_results(spark: SparkSession, d: str) -> DataFrame:
    """What each term of the log would find among all rows."""
    return search.term_results(read_table(spark, d, "registry_rows"), "customerName", read_table(spark, d, "search_log"), 100)


def widths(spark: SparkSession, d: str) -> DataFrame:
    return column_widths(read_table(spark, d, "registry_rows").select("rec_id", "licAddress", "customerName", "licenseActivities"), 22, 55, 4)


_DAY = "coalesce(strftime(coalesce(" + ", ".join(f"try_strptime(e, '{f}')" for f in ["%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y", "%m-%d-%Y", "%d %b %Y"]) + "), '%Y-%m-%d'), lower(e))"
_SNAPSHOTS = f"""
with n as (select snapshot_no s, upper(trim(licNo)) k, lower(trim(licenseStatus)) st, trim(licExpDate) e, loaded_at, row_id
           from licence_snapshots where length(trim(licNo)) > 0),
d as (select s, k, st, {_DAY} e, row_number() over (partition by s, k order by loaded_at desc, row_id desc) rn from n),
l as (select s, k, st, e from d where rn = 1),
c as (select coalesce(a.s, b.s + 1) as snapshot_no, coalesce(a.k, b.k) as licno,
        case when b.k is null then 'added' when a.k is null then 'removed' else 'changed' end as change_kind,
        b.st as old_status, b.e as old_expires, a.st as new_status, a.e as new_expires
      from (select * from l where s > (select min(s) from l)) a
      full join (select * from l where s < (select max(s) from l)) b on a.s = b.s + 1 and a.k = b.k
      where a.k is null or b.k is null or a.st is distinct from b.st or a.e is distinct from b.e)
"""

_PATH = r"case when regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 2), ';[^/]*$', '') = '' then '/' else regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 2), ';[^/]*$', '') end"
_UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_TEMPLATE = f"regexp_replace(regexp_replace(coalesce(path, '/'), '/{_UUID}', '/{{uuid}}', 'g'), '/[0-9]+', '/{{id}}', 'g')"
_JSON = "coalesce(json_valid({x}) and trim({x}) <> 'null' and {x} <> '', false)"
_DYNAMIC = f"coalesce(regexp_matches({{x}}, '^(?:[0-9]+|{_UUID}|[0-9a-fA-F]{{24}})$') or (regexp_matches({{x}}, '^[0-9a-zA-Z_-]{{8,}}$') and regexp_matches({{x}}, '[0-9]') and regexp_matches({{x}}, '[a-zA-Z]')), false)"


_NAMED = f"""
seg as (select path, unnest(string_split(path, '/')) as seg, generate_subscripts(string_split(path, '/'), 1) - 1 as i from (select distinct path from calls where path is not null)),
dyn as (select *, {_DYNAMIC.replace('{x}', 'seg')} as dynamic from seg),
las as (select *, coalesce(last_value(case when seg <> '' and not dynamic then seg end ignore nulls) over (partition by path order by i rows between unbounded preceding and 1 preceding), '') as last from dyn),
ste as (select *, regexp_replace(regexp_replace(last, 's+$', ''), '[^a-zA-Z0-9]', '', 'g') as stem from las),
bas as (select *, case when dynamic then case when length(stem) > 1 then lower(left(stem, 1)) || substr(stem, 2) || 'Id' when length(stem) = 1 then stem || 'Id' else 'param' || i end end as base from ste),
num as (select *, row_number() over (partition by path, base order by i) as nth from bas),
named as (select path, coalesce(nullif(string_agg(case when dynamic then '{{' || base || case when nth > 1 then cast(nth as varchar) else '' end || '}}' else seg end, '/' order by i), ''), '/') as template,
  coalesce(string_agg(base || case when nth > 1 then cast(nth as varchar) else '' end, ',' order by i) filter (dynamic), '') as params from num group by path)
"""
_PAGED = f"""
with {_NAMED},
ep as (select upper(coalesce(nullif(method, ''), 'GET')) as method, template as path_template, call_id, query_params from calls join named using (path) where {{filter}}),
sizes as (select method, path_template, count(*) as n_calls from ep group by 1, 2),
keys as (select unnest({pagination.NUMERIC_KEYS}) as key, unnest(range({len(pagination.NUMERIC_KEYS)})) as key_idx),
v as (select method, path_template, call_id, key, key_idx, try_cast(trim(query_params[key]) as bigint) as num from ep, keys where query_params[key] is not null),
w as (select *, num - lag(num) over (partition by method, path_template, key order by call_id) as step from v),
a as (select method, path_template, key, key_idx, count(*) as n, count(num) as whole, min(step) as low, max(step) as high, arg_min(num, call_id) as first from w group by 1, 2, 3, 4),
c as (select a.*, case when n = 1 then 0.25 else 0.6 + 0.35 * least(n / 5.0, 1.0) end as confidence, case when n > 1 then low when key in ('offset', 'skip') then 20 else 1 end as step_size,
    case when key in ('offset', 'skip') then 'OFFSET' else 'PAGE' end as strategy
  from a join sizes using (method, path_template) where n = n_calls and whole = n and (n = 1 or (low > 0 and low = high))),
best as (select *, row_number() over (partition by method, path_template order by confidence desc, key_idx) as rank from c)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_QUOTE = "case when regexp_full_match({x}, '[a-zA-Z0-9@%+=:,./_-]+') then {x} else concat(" + _quoted("'") + ", replace({x}, " + _quoted("'") + ", " + _quoted("'\"'\"'") + "), " + _quoted("'") + ") end"


def _cases(kinds: list[tuple[str, str]], rows: str, text: str = "body") -> str:
    """A union of one select per pattern over ``probe``; ``rows`` names what is selected, with {label}."""
    return " union all ".join(
        f"select {rows.replace('{label}', label).replace('{pattern}', _quoted(p))} from probe where regexp_matches({text}, {_quoted(p)})" for label, p in kinds
    )


def _header(name: str) -> str:
    return f"list_filter(h, lambda x: lower(x.k) = '{name}')[1].v"


def _security_sql() -> dict[str, str]:
    probe = "with " + probe_sql()
    masked = "case when length(s) > 12 then concat(left(s, 6), '...', right(s, 4)) else '***' end"
    secrets = " union all ".join(
        f"select call_id, host, '{label} found in {place}' as description, regexp_extract({text}, {_quoted(p)}, 0) as s from probe where regexp_matches({text}, {_quoted(p)})"
        for place, text in (("response_body", "body"), ("request_body", "coalesce(case when " + _JSON.replace('{x}', 'sent') + " then sent end, '')"), ("url", "coalesce(url, '')"))
        for label, p in checks.SECRETS
    )
    missing = " union all ".join(
        f"select call_id, host, '{s}' as severity, '{n}' as evidence from probe where len(list_filter(h, lambda x: lower(x.k) = '{n}')) = 0" for n, _, s in checks.SECURITY_HEADERS
    )
    cookie = f"cookies as (select call_id, host, url, {_header('set-cookie')} as c from probe)"
    weak = """select call_id, host, 'medium' as severity, 'Set-Cookie missing Secure flag over HTTPS' as description, left(c, 60) as evidence from cookies where length(c) > 0 and starts_with(url, 'https://') and not contains(lower(c), 'secure')
      union all select call_id, host, 'medium', 'Set-Cookie missing HttpOnly flag', left(c, 60) from cookies where length(c) > 0 and not contains(lower(c), 'httponly')
      union all select call_id, host, 'low', 'Set-Cookie missing SameSite attribute', left(c, 60) from cookies where length(c) > 0 and not contains(lower(c), 'samesite')"""
    open_cors = f"select call_id, host, 'high' as severity, 'Access-Control-Allow-Origin: *' as evidence from probe where {_header('access-control-allow-origin')} = '*' and lower({_header('access-control-allow-credentials')}) = 'true'"
    plain = "select call_id, host, url as evidence from probe where starts_with(url, 'http://')"
    errors = " union all ".join(
        f"select call_id, host, concat('{label} exposed in ', status, ' response body') as description from probe where status >= 400 and body <> '' and regexp_matches(body, {_quoted(p)})" for label, p in checks.ERROR_LEAKS
    )
    captcha = _cases(checks.CAPTCHAS, "call_id, '{label} present in response body' as description")
    text = "concat(array_to_string(list_transform(h, lambda x: concat(x.k, ': ', coalesce(x.v, ''))), ' '), ' ', body)"
    vendor = _cases(checks.BOT_VENDORS, "call_id, 'high' as severity, '{label} detected (headers/cookies or body)' as description", text)
    vendor += " union all select call_id, 'blocker', '403 response with Cloudflare challenge marker' from probe where status = 403 and len(list_filter(h, lambda x: regexp_matches(concat(x.k, ': ', x.v), '(?i)cf-mitigated'))) > 0"
    names = "list_distinct(list_concat(coalesce(map_keys(query_params), []), coalesce(case when json_valid(sent) and json_type(sent) = 'OBJECT' then json_keys(sent) end, [])))"
    fragile = f"select call_id, array_to_string(list_sort(list_filter({names}, lambda n: regexp_matches(n, {_quoted(checks.FRAGILE_NAMES)}))), ', ') as names from probe"
    every = f"""every as (
      select host, 'Missing security header' as category, severity from ({missing})
      union all select host, 'Exposed secret', 'high' from ({secrets})
      union all select host, 'Weak cookie flag', severity from ({weak})
      union all select host, 'CORS misconfiguration', severity from ({open_cors})
      union all select host, 'Insecure transport', 'high' from ({plain})
      union all select host, 'Verbose error disclosure', 'medium' from ({errors}))"""
    return {
        "missing_headers": f"{probe} select call_id, severity, evidence from ({missing})",
        "secrets_masked": f"{probe} select call_id, description, {masked} as evidence from ({secrets})",
        "weak_cookies": f"{probe}, {cookie} select call_id, severity, description, evidence from ({weak})",
        "cors": f"{probe} select call_id, severity, evidence from ({open_cors})",
        "transport": f"{probe} select call_id, evidence from ({plain})",
        "verbose_errors": f"{probe} select call_id, description from ({errors})",
        "captcha_signals": f"{probe} {captcha}",
        "vendor_signals": f"{probe} {vendor}",
        "fragile_params": f"{probe} select * from ({fragile}) where names <> ''",
        "findings_pivot": f"{probe}, {cookie}, {every} select host as system, count(*) filter (severity = 'high') as high, count(*) filter (severity = 'medium') as medium, count(*) filter (severity = 'low') as low, count(*) filter (severity = 'info') as info, count(*) as total from every group by 1",
        "bot_findings": f"""{probe}, b as (
            select call_id, 'CAPTCHA detected' as category, 'blocker' as severity from ({captcha}) union all select call_id, 'Bot-defense signal', severity from ({vendor})
            union all select call_id, 'Replay-fragile request', 'medium' from ({fragile}) where names <> '')
          select host as system, category, severity, count(*) as n_findings from b join probe using (call_id) group by 1, 2, 3""",
        "security_findings": f"{probe}, {cookie}, {every} select host as system, category, severity, count(*) as n_findings from every group by 1, 2, 3",
        "endpoint_status": f"""{probe}, blocked as ({captcha} union all select call_id, description from ({vendor})), fragile as (select * from ({fragile}) where names <> ''),
          f as (select p.host, p.path, p.method, p.call_id, case when p.call_id in (select call_id from blocked) then 2 when p.call_id in (select call_id from fragile) then 1 else 0 end as flag from probe p)
          select host as system, path as endpoint, arg_min(method, call_id) filter (call_id is not null) as method_raw, case max(flag) when 2 then 'blocked' when 1 then 'fragile' else 'likely automatable' end as automation_status from f group by 1, 2""",
    }


def _search_sql(rows: str, id_: str, text: str, cap: int, depth: int = 6) -> str:
    return f"""
with r as (select {id_} as id, {text} as t, lower({text}) as l from {rows} where {text} is not null),
p as (select r.id, left(l, k) as p from r, range(0, {depth + 1}) x(k) where k <= length(l) and regexp_matches(left(l, k), '^[a-z0-9]*$')),
c as (select p, count(*) as n from p group by 1)
select id as {id_}, t as {text} from r where id in (select id from p join c using (p) where n < {cap})"""


def _kept_sql(rows: str, id_: str, text: str, cap: int, depth: int = 5) -> str:
    return f"""
with r as (select {id_} as id, {text} as t, lower({text}) as l from {rows} where {text} is not null),
p as (select r.id, k, left(l, k) as p from r, range(1, {depth + 1}) x(k) where k <= length(l) and regexp_matches(left(l, k), '^[a-z0-9]+$')),
c as (select id, k, count(*) over (partition by p) as n, row_number() over (partition by p order by id) as rn from p),
v as (select id, n, rn, coalesce(min(n) over (partition by id order by k rows between unbounded preceding and 1 preceding), {cap}) as above from c)
select id as {id_}, t as {text} from r where id in (select id from v where above >= {cap} and (n < {cap} or rn <= {cap}))"""


def _registry_sql() -> dict[str, str]:
    br = lambda c, by: f"regexp_replace({c}, '(?i)<br\\s*/?>', {by}, 'g')"
    strip = lambda x: f"regexp_replace(regexp_replace({x}, '^\\s+', ''), '\\s+$', '')"
    clean = lambda c: strip(br(c, "' '"))
    day = lambda c: f"case when length({strip(c)}) > 0 then coalesce(strftime(coalesce(" + ", ".join(f"try_strptime({strip(c)}, '{f}')" for f in ["%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y", "%d %b %Y"]) + f"), '%Y-%m-%d'), {strip(c)}) end"
    export = ", ".join(f"coalesce({br(f, 'chr(10)')}, '') as \"{c}\"" for c, f in registry.EXPORT_COLUMNS.items())
    names = ", ".join(f"coalesce({br(registry.EXPORT_COLUMNS[c], _quoted(', '))}, '') as \"{c}\"" for c in registry.NAME_COLUMNS)
    width = lambda c: f"select '{c}' as column_name, cast(least(greatest(greatest(max(list_max(list_transform(string_split(coalesce(cast({c} as varchar), ''), chr(10)), lambda x: length(x)))), {len(c)}) + 4, 22), 55) as integer) as width from registry_rows"
    return {
        "html_clean": f"select rec_id, {clean('licAddress')} as address from registry_rows",
        "registry_clean": "select rec_id, " + ", ".join(f"{clean(c)} as {c}" for c in CLEANED) + " from registry_rows",
        "registry_export": f"select {export} from registry_rows",
        "registry_names": f"select {names} from registry_rows where customerName is not null or licNo is not null",
        "registry_payload": f"""select coalesce(customerName, '') as business_name, coalesce(licNo, '') as license_number, {day('licIssueDate')} as issue_date, cast(null as varchar) as expiry_date,
            coalesce(licAddress, '') as address, coalesce(licManagerName, '') as manager, '' as activity, coalesce(licenseStatus, '') as status from registry_rows""",
        "date_normalize": f"select rec_id, {day('licIssueDate')} as issued, {day('licExpDate')} as expires from registry_rows",
        "widths": " union all ".join(width(c) for c in ["rec_id", "licAddress", "customerName", "licenseActivities"]),
        "dedup_keep_null": "select rec_id, licNo, customerName from (select *, row_number() over (partition by licNo order by rec_id) rn from registry_rows) where rn = 1 or licNo is null or licNo = ''",
        "composite_key_dedup": """select rec_id, k as licence_key from (select rec_id, k, row_number() over (partition by k order by rec_id) rn from
            (select rec_id, case when length(licNo) > 0 then licNo else concat('noLic_', coalesce(customerName, 'None'), '_', coalesce(customerRegistrationNumber, 'None')) end as k from registry_rows)) where rn = 1""",
        "anti_seen": "select rec_id, licNo from registry_rows r where not exists (select 1 from licence_snapshots s where s.licNo = r.licNo and r.licNo <> '')",
        "capped_rows": "select rec_id, search_id from (select rec_id, search_id, row_number() over (partition by search_id order by rec_id) rn from registry_rows) where rn <= 3",
        "rows_added_per_term": "select search_id, count(*) as n_added from (select search_id, row_number() over (partition by licNo order by search_id, rec_id) rn from registry_rows where length(licNo) > 0) where rn = 1 group by 1",
    }


_SWEPT = """l as (select unnest(string_split('abcdefghijklmnopqrstuvwxyz', '')) as c),
h as (select l.c as term, r.* from (select rec_id, licNo, customerName from registry_rows {where}) r join l on contains(lower(r.customerName), l.c)),
swept as (select * exclude (rn) from (select *, row_number() over (partition by term order by rec_id) as rn from h) where rn <= 100)"""


def _picking_sql() -> dict[str, str]:
    json = _JSON.replace("{x}", "response_text_raw")
    known = _SWEPT.replace("{where}", "where licNo is not null")
    return {
        "post_calls": "select call_id, path, status from calls where contains(url, 'apexremote') and method = 'POST'",
        "host_calls": "select call_id, host, url from calls where contains(host, 'zone')",
        "body_matches": f"select call_id from calls where contains(response_text_raw, 'LLC') or ({_JSON.replace('{x}', 'request_body_json')} and contains(request_body_json, 'LLC'))",
        "first_last_calls": f"""with c as (select host, method, call_id from calls where {json})
            select 'first' as which, host, method, min(call_id) as call_id from c group by all union all select 'last', host, method, max(call_id) from c group by all""",
        "running_unique_total": """select search_id, n_added, cast(sum(n_added) over (order by search_id) as bigint) as total from (
            select search_id, count(*) as n_added from (select search_id, row_number() over (partition by licNo order by search_id, rec_id) rn from registry_rows where length(licNo) > 0) where rn = 1 group by 1)""",
        "file_names": """select left(regexp_replace(regexp_replace('collector_' || coalesce(host, '') || '_' || coalesce(path, ''), '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g'), 90) || '.py' as file_name,
            count(*) as n_calls from calls group by 1""",
        "har_calls": f"""select call_id, regexp_extract(coalesce(url, ''), '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 1) as host, {_PATH} as path, method, coalesce(url, '') as url, status, mime_type, started_at, time_ms,
            response_text_raw, coalesce(array_to_string(list_sort(map_keys(query_params)), ','), '') as params, {_JSON.replace('{x}', 'request_body_json')} as sent from calls""",
        "body_kinds": f"""with {_NAMED} select upper(coalesce(nullif(method, ''), 'GET')) as method, template as path_template, case json_type(response_text_raw) when 'ARRAY' then 'array' when 'OBJECT' then 'object'
            when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'DOUBLE' then 'number' else 'integer' end as kind, count(*) as n_calls from calls join named using (path) where {json} group by 1, 2, 3""",
        "letter_sweep": f"with {_SWEPT.replace('{where}', '')} select rec_id, customerName, term from swept",
        "split_search": f"""with {known},
            firsts as (select licNo, min(term) as term from swept group by 1),
            crowded as (select term from firsts group by 1 having count(*) >= 50),
            ph as (select crowded.term || l.c as term, r.* from crowded, l join (select rec_id, licNo, customerName from registry_rows where licNo is not null) r on contains(lower(r.customerName), crowded.term || l.c)),
            pairs as (select * exclude (rn) from (select *, row_number() over (partition by term order by rec_id) as rn from ph) where rn <= 100),
            every as (select * from swept union all select * from pairs)
            select rec_id, licNo, customerName, term from (select *, row_number() over (partition by licNo order by term, rec_id) as rn from every) where rn = 1""",
        "term_results": """with t as (select distinct lower(trim(term)) as term from search_log where length(trim(term)) between 1 and 5),
            f as (select term, count(customerName) as n from t left join registry_rows on starts_with(lower(customerName), term) group by 1)
            select term, least(n, 100) as n_returned, n >= 100 as hit_cap from f""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [p4_found, p5_found, p5_changes, system_summary, url_split, path_template, dynamic_segments, named_templates, json_bodies, event_cells, envelope_rows,
              data_cells, column_order, missing_headers, secrets_masked, weak_cookies, cors, transport, verbose_errors, captcha_signals, vendor_signals, fragile_params,
              findings_pivot, security_findings, endpoint_status, first_example, redacted_headers, curl_snippet, request_scripts, html_clean, registry_clean, registry_export,
              registry_names, registry_payload, date_normalize, order_epochs, token_expiry, balanced_json, dedup_keep_null, composite_key_dedup, anti_seen,
              capped_search_names, capped_search_keep, capped_rows, rows_added_per_term, pending_terms, pagination_numeric, pagination_profiles, pagination_cursor, status_sets,
              param_union, endpoint_schemas, widths, post_calls, host_calls, body_matches, first_last_calls, running_unique_total, file_names, bot_findings, har_calls,
              body_kinds, letter_sweep, split_search, term_results]
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    method = "coalesce(method, 'GET')"
    security = _security_sql()
    security["endpoint_status"] = security["endpoint_status"].replace("arg_min(method, call_id) filter (call_id is not null) as method_raw", "list(method order by call_id)[1] as method")
    return {
        "p5_found": _SNAPSHOTS + "select snapshot_no, licno, change_kind from c",
        "p5_changes": _SNAPSHOTS + "select snapshot_no, licno, change_kind, old_status, old_expires, new_status, new_expires from c",
        "system_summary": f"""select case when length(host) > 0 then host else 'unknown-host' end as system, count(*) as total_calls,
            count(*) filter ({_JSON.replace('{x}', 'response_text_raw')}) as calls_with_json_data, array_to_string(list_sort(list(distinct method) filter (method is not null)), ', ') as methods,
            count(distinct nullif(path, '')) as distinct_endpoints, array_to_string(list_sort(list(distinct status) filter (status is not null)), ', ') as statuses from calls group by 1""",
        "url_split": f"select call_id, regexp_extract(coalesce(url, ''), '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 1) as host, {_PATH} as path from calls",
        "path_template": f"select {method} as method, {_TEMPLATE} as template, count(*) as n_calls from calls group by 1, 2",
        "dynamic_segments": f"select segment, count(*) as n, any_value({_DYNAMIC.replace('{x}', 'segment')}) as is_dynamic from (select unnest(string_split(path, '/')) as segment from calls) where segment <> '' group by 1",
        "named_templates": f"with {_NAMED} select template, params, count(*) as n_calls from calls join named using (path) group by 1, 2",
        "pagination_numeric": _PAGED.replace("{filter}", "true")
        + "select method, path_template, key as param_name, strategy, step_size, first as initial_value, round(confidence, 4) as confidence from best where rank = 1",
        "pagination_profiles": _PAGED.replace("{filter}", "true")
        + """select s.method, s.path_template, coalesce(b.strategy, 'NONE') as strategy, b.key as param_name, case when b.key is not null then 'query' end as param_source, coalesce(b.step_size, 1) as step_size,
            coalesce(b.first, 0) as initial_value, cast(null as varchar) as cursor_json_path, coalesce(b.confidence, 0.0) as confidence, s.n_calls as sample_size
            from sizes s left join best b on s.method = b.method and s.path_template = b.path_template and b.rank = 1""",
        "pagination_cursor": f"""with {_NAMED},
            ep as (select upper(coalesce(nullif(method, ''), 'GET')) as method, template as path_template, call_id from calls join named using (path)),
            l as (select *, call_id - lag(call_id) over (partition by method, path_template order by call_id) as gap from ep)
            select method, path_template, 'cursor' as param_name, case when count(*) filter (gap = 1) > 0 then 'meta.next' end as cursor_json_path,
              cast(case when count(*) filter (gap = 1) > 0 then 0.85 else 0.4 end as double) as confidence from l group by 1, 2""",
        "curl_snippet": f"""select host as system, method, path as endpoint, status as status_seen,
            concat_ws(' ', 'curl -X', coalesce(nullif(method, ''), 'GET'), {_QUOTE.replace('{x}', "coalesce(url, '')")},
              nullif(array_to_string(list_transform(map_entries(request_headers), lambda e: '-H ' || {_QUOTE.replace('{x}', "(e.key || ': ' || e.value)")}), ' '), ''),
              case when {_JSON.replace('{x}', 'request_body_json')} then '-d ' || {_QUOTE.replace('{x}', 'request_body_json')} end) as curl_command
            from (select *, row_number() over (partition by host, method, path order by call_id) rn from calls) where rn = 1""",
        "json_bodies": f"select {_JSON.replace('{x}', 'response_text_raw')} as has_json, count(*) as n_calls from calls group by 1",
        "event_cells": "select event_id as call_id, k as key, json_extract_string(props, '$.' || k) as value, case when json_type(props, '$.' || k) in ('BIGINT', 'UBIGINT') then 'integer' when json_type(props, '$.' || k) = 'DOUBLE' then 'number' else 'string' end as kind from (select event_id, props, unnest(json_keys(props)) as k from events where json_valid(props))",
        "envelope_rows": """select json_extract_string(r, '$.licNo') as licno, tid, count(*) as n_rows from (
            select json_extract_string(e, '$.tid') as tid, unnest(json_extract(e, '$.result[*]')) as r from (
              select unnest(json_extract(response_text_raw, '$[*]')) as e from calls where json_valid(response_text_raw) and json_type(response_text_raw) = 'ARRAY'))
            where json_extract_string(r, '$.licNo') is not null group by 1, 2""",
        **security,
        "first_example": "select call_id, host, method, path, status from (select *, row_number() over (partition by host, method, path order by call_id) rn from calls) where rn = 1",
        "redacted_headers": """select call_id, e.k as name, e.v as value from (select call_id, unnest(list_concat(coalesce(list_transform(map_entries(request_headers), lambda x: {'k': x.key, 'v': x.value}), []), [{'k': 'Authorization', 'v': '<AUTHORIZATION>'}])) as e from calls)""",
        **_registry_sql(),
        **_picking_sql(),
        "order_epochs": "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as by_seconds, strftime(o_orderdate, '%Y-%m-%d') as by_millis from orders",
        "token_expiry": "select event_id, event_id + 1700000000 as exp from events",
        "capped_search_names": _search_sql("registry_rows", "rec_id", "customerName", 20),
        "capped_search_keep": _kept_sql("registry_rows", "rec_id", "customerName", 20),
        "pending_terms": """
with l as (select unnest(string_split('abcdefghijklmnopqrstuvwxyz0123456789', '')) as c),
d as (select lower(trim(term)) as term, max(cast(hit_cap as integer)) as capped from search_log where n_returned is not null and term is not null group by 1),
p as (select c as term, cast(null as varchar) as parent_term from l union all select d.term || c, d.term from d, l where capped = 1 and length(d.term) < 5)
select term, parent_term, length(term) as depth from p where term not in (select term from d)""",
        "status_sets": f"select {method} as method, {_TEMPLATE} as path_template, coalesce(nullif(array_to_string(list_sort(list(distinct status) filter (status is not null)), ', '), ''), '200') as statuses from calls group by 1, 2",
        "param_union": f"select method, path_template, param, count(*) as n_calls from (select {method} as method, {_TEMPLATE} as path_template, unnest(map_keys(query_params)) as param from calls) group by 1, 2, 3",
    }
