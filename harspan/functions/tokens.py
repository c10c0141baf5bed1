"""Claims of signed web tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jwt_expiry(token: Column) -> Column:
    """The ``exp`` claim of a three-part token in seconds, null when there is none."""
    parts = F.split(token, r"\.")
    body = F.translate(F.get(parts, F.lit(1)), "-_", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), "=")
    claims = F.decode(F.when(padded.rlike("^[A-Za-z0-9+/]+=*$"), F.try_to_binary(padded, F.lit("base64"))), "utf-8")
    return F.when(F.size(parts) == 3, F.get_json_object(claims, "$.exp").try_cast("bigint"))
