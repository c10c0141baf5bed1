"""Calendar days from dates in several notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Shape of a notation and the patterns tried for it in order; day first where both readings are possible.
NOTATIONS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ["yyyy-M-d"]),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ["yyyy/M/d"]),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ["d/M/yyyy", "M/d/yyyy"]),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ["d-M-yyyy", "M-d-yyyy"]),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ["d.M.yyyy", "M.d.yyyy"]),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ["d MMM yyyy"]),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ["d MMMM yyyy"]),
]


def calendar_day(text: Column) -> Column:
    """The day that ``text`` gives, or null; the shape decides which patterns are tried, so nothing is parsed in vain."""
    value = strip(text)
    out = None
    for shape, patterns in NOTATIONS:
        word = F.initcap(value) if "M yyyy" in patterns[0] and "MMM" in patterns[0] else value
        parsed = F.coalesce(*[F.try_to_timestamp(word, F.lit(p)) for p in patterns]).cast("date")
        out = F.when(value.rlike(shape), parsed) if out is None else out.when(value.rlike(shape), parsed)
    return out


def day_key(text: Column) -> Column:
    """A text that is equal for equal days; what is no date compares as its stripped lower-case self, null stays null."""
    return F.coalesce(F.date_format(calendar_day(text), "yyyy-MM-dd"), F.lower(strip(text)))


def registry_day(raw: Column) -> Column:
    """``yyyy-MM-dd`` of an epoch number (seconds, or milliseconds above 10,000,000,000) or of a dated text.

    Blank gives null; a text in no known notation stays, stripped.
    """
    value = strip(raw.cast("string"))
    number = F.when(value.rlike(r"^\d{5,}(\.\d+)?$"), value.try_cast("double"))
    seconds = F.when(number > 10_000_000_000, number / 1000).otherwise(number)
    # fixed patterns of the export format, tried in this order
    ordered = ["yyyy-M-d", "d/M/yyyy", "d-M-yyyy", "M/d/yyyy", "d MMM yyyy"]
    day = F.coalesce(*[F.try_to_timestamp(value, F.lit(p)) for p in ordered])
    return F.when(
        F.length(value) > 0,
        F.coalesce(
            F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"),
            F.date_format(day, "yyyy-MM-dd"),
            value,
        ),
    )
