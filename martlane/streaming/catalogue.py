"""Download links out of catalogue pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.text import first_match, last_path_segment
from martlane.sources.schemas import CATALOGUE_LINK


def with_first_link(pages: DataFrame, html: str, pattern: str = CATALOGUE_LINK) -> DataFrame:
    """Add the first link that matches and the file name it ends in (NULL: none)."""
    linked = pages.withColumn("download_url", first_match(html, pattern))
    return linked.withColumn("file_name", last_path_segment("download_url"))


def split_by_link(pages: DataFrame, html: str, pattern: str = CATALOGUE_LINK) -> tuple[DataFrame, DataFrame]:
    """Pages with a link, and pages without one for the quarantine."""
    linked = with_first_link(pages, html, pattern)
    found = F.col("download_url").isNotNull()
    return linked.filter(found), linked.filter(~found).drop("download_url", "file_name")
