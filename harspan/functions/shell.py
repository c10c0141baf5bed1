"""Quoting for command lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shell_quoted(text: Column) -> Column:
    """``text`` as one word of a POSIX shell; bare where nothing needs quoting."""
    safe = text.rlike(r"\A[a-zA-Z0-9@%+=:,./_-]+\z")
    return F.when(safe, text).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("'\"'\"'")), F.lit("'")))
