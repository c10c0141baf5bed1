"""The whole analysis of a capture: summary, findings, automation status, snippets and data tables, and the report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, snippets, systems
from ..session import checkpointed, collect_bounded
from ..sinks.xlsx import sheet_name, write_workbook
from ..sources.har import read_har

#: Sheets of a workbook; more endpoints than this are written as folders.
MAX_SHEETS = 2_000


@dataclass
class Analysis:
    """Lazy tables over one capture that was read once."""

    calls: DataFrame
    summary: DataFrame
    findings: DataFrame
    finding_summary: DataFrame
    bot_findings: DataFrame
    automation: DataFrame
    snippets: DataFrame
    rows: DataFrame


def analyze_calls(calls: DataFrame, redact: bool = True) -> Analysis:
    """The analysis of a table of calls; nothing runs until a table is used."""
    security = checks.scan(calls, checks.SECURITY_CHECKS)
    bots = checks.scan(calls, checks.BOT_CHECKS).drop("evidence")
    return Analysis(
        calls=calls,
        summary=systems.summarize_systems(calls),
        findings=checks.in_order(security),
        finding_summary=checks.summarize_findings(security),
        bot_findings=checks.in_order(bots),
        automation=checks.endpoint_status(calls),
        snippets=snippets.snippets(calls, redact),
        rows=systems.data_rows(calls),
    )


def analyze_archive(spark: SparkSession, path: str, redact: bool = True) -> Analysis:
    """The analysis of HTTP archives; parsed calls are written once to the shared checkpoint folder."""
    return analyze_calls(checkpointed(read_har(spark, path)), redact)


def report_sheets(found: Analysis) -> list[tuple[str, DataFrame]]:
    """The sheets of a report in order; all but the overview only when they have rows."""
    order = ["call_id", "check_idx", "sub_idx"]
    sheets = [("Overview", found.summary)]
    for name, df in (
        ("Security Summary", found.finding_summary), ("Security Findings", found.findings.drop(*order)), ("Automation Status", found.automation),
        ("Bot Defense Findings", found.bot_findings.drop(*order)), ("Request Snippets", found.snippets),
    ):
        if not df.isEmpty():
            sheets.append((name, df))
    by = ["system", "path_template"]
    # every sheet takes its own rows from here
    rows = checkpointed(found.rows)
    listed = systems.column_order(rows, *by).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "key"))), lambda x: x["key"]).alias("keys"))
    first = rows.groupBy(*by).agg(F.min("call_id").alias("first"))
    groups = collect_bounded(listed.join(first, by), MAX_SHEETS, "the list of endpoints with data")
    for g in sorted(groups, key=lambda g: g.first):
        own = rows.where((F.col("system") == g.system) & (F.col("path_template") == g.path_template)).orderBy("call_id", "row_idx")
        sheets.append((f"{g.system}_{g.path_template}", systems.wide_rows(own, list(g["keys"]))))
    return sheets


def write_report(found: Analysis, path: str) -> dict[str, int]:
    """The report as one workbook; gives the rows of each sheet."""
    return write_workbook(path, report_sheets(found))


def write_tables(found: Analysis, folder: str, format: str = "parquet") -> list[str]:
    """The report as one folder per table, written by all executors; data rows partitioned by system."""
    used: set[str] = set()
    written = []
    for name, df in (
        ("overview", found.summary), ("security_summary", found.finding_summary), ("security_findings", found.findings),
        ("automation_status", found.automation), ("bot_findings", found.bot_findings), ("request_snippets", found.snippets),
    ):
        target = f"{folder}/{sheet_name(name, used)}"
        df.write.mode("overwrite").format(format).save(target)
        written.append(target)
    if format in ("parquet", "json", "orc"):
        found.rows.write.mode("overwrite").format(format).partitionBy("system").save(f"{folder}/data_rows")
        written.append(f"{folder}/data_rows")
    return written
