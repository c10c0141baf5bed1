"""Registry records: cleaning, export forms and records read from payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import registry_day
from ..functions.text import unbreak

# Columns of the export and the fields that they come from.
EXPORT_COLUMNS = {
    "Company Name": "customerName", "Company Name (Arabic)": "customerArabicName", "License Number": "licNo", "License Issue Date": "licIssueDate",
    "License Expiry Date": "licExpDate", "Address": "licAddress", "Address (Arabic)": "licArabicAddress", "Manager": "licManagerName",
    "Manager (Arabic)": "licManagerArabicName", "Activities": "licenseActivities", "Activities (Arabic)": "licenseArabicActivities",
    "License Status": "licenseStatus", "Registration Status": "customerRegistrationStatus", "Registration Number": "customerRegistrationNumber",
    "Registration Date": "customerRegistrationDate",
}
NAME_COLUMNS = ["Company Name", "License Number", "License Issue Date", "License Expiry Date", "Address", "Manager", "Activities", "License Status"]


def clean_fields(df: DataFrame) -> DataFrame:
    """Every text column without line-break markup and outer white space; nulls and other columns stay."""
    return df.select(*[unbreak(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def _lines(df: DataFrame, field: str, by: str) -> Column:
    column = F.col(f"`{field}`")
    if isinstance(df.schema[field].dataType, T.ArrayType):
        return F.array_join(F.transform(column, lambda x: x.cast("string")), by)
    return F.regexp_replace(column.cast("string"), r"(?i)<br\s*/?>", by)


def export_rows(df: DataFrame) -> DataFrame:
    """The fifteen export columns, breaks as new lines, lists one value per line; a missing or null field is empty."""
    return df.select(*[F.coalesce(_lines(df, f, "\n"), F.lit("")).alias(c) if f in df.columns else F.lit("").alias(c) for c, f in EXPORT_COLUMNS.items()])


def name_rows(df: DataFrame) -> DataFrame:
    """The eight main columns, breaks and lists joined by commas, of rows that have a company name or a licence number."""
    kept = df.where(F.col("customerName").isNotNull() | F.col("licNo").isNotNull())
    return kept.select(*[F.coalesce(_lines(kept, EXPORT_COLUMNS[c], ", "), F.lit("")).alias(c) for c in NAME_COLUMNS])


def payload_records(df: DataFrame, json_column: str, records_key: str = "results") -> DataFrame:
    """Eight normalised fields of every record in registry payloads (a list, a list under a key, or one object).

    Of alternative source fields the first that is neither null nor empty counts; elements that are no objects are
    left out; malformed payloads give nothing.
    """
    doc = F.try_parse_json(F.col(f"`{json_column}`"))
    as_list = lambda path: F.try_variant_get(doc, path, "array<variant>")
    one = lambda path: F.when(F.schema_of_variant(F.try_variant_get(doc, path, "variant")).startswith("OBJECT"), F.array(F.try_variant_get(doc, path, "variant")))
    places = [as_list("$"), as_list(f"$.{records_key}"), one(f"$.{records_key}"), as_list("$.data"), one("$.data")]
    raw = df.select(F.posexplode(F.coalesce(*places)).alias("record_idx", "r")).where(F.schema_of_variant("r").startswith("OBJECT"))

    def first(*paths: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_variant_get("r", f"$.{p}", "string"), F.lit("")) for p in paths], F.lit(""))

    return raw.select(
        "record_idx",
        first("companyName", "business_name", "name").alias("business_name"),
        first("licenseNumber", "license_no").alias("license_number"),
        registry_day(first("issueDate", "license_issue_date")).alias("issue_date"),
        registry_day(first("expiryDate", "license_expiry_date")).alias("expiry_date"),
        first("address.fullAddress", "address").alias("address"),
        first("manager.name", "managerName").alias("manager"),
        first("activity.description", "businessActivity").alias("activity"),
        first("licenseStatus", "status").alias("status"),
    )
