"""Parts of URLs; unlike strict parsers these never fail on what browsers send."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = r"^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)"


def url_host(url: Column) -> Column:
    """The authority as written, with port, user and case; empty when there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1)


def url_path(url: Column) -> Column:
    """The path without query, fragment and the parameters of its last segment; ``/`` when empty."""
    path = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2), r";[^/]*$", "")
    return F.when(path == "", F.lit("/")).otherwise(path)
