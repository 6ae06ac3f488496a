"""Text helpers of the ingest jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(text: Column | str, pattern: str) -> Column:
    """First group of the first match; NULL when nothing matches."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found)


def last_path_segment(url: Column | str) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def trimmed_line(value: Column | str) -> Column:
    """The line without surrounding white space and control characters."""
    return F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
