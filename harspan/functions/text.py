"""Column functions for texts as people type them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """``text`` stripped, with each inner run of white space as one blank."""
    return F.regexp_replace(strip(text), r"\s+", " ")


def blank_to_null(text: Column) -> Column:
    """Null for a text of white space only."""
    return F.when(F.length(strip(text)) > 0, text)


def unbreak(text: Column, by: str = " ") -> Column:
    """``text`` with HTML line breaks replaced by ``by`` and stripped."""
    return strip(F.regexp_replace(text, r"(?i)<br\s*/?>", by))
