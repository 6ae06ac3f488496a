"""Landed feed files wrapped into one VARIANT column, RAW."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.functions.text import trimmed_line
from martlane.sources.schemas import FEEDS

WRAPS = ("json", "body", "text", "lines")
WHOLE = ("body", "text")


def read_payloads(spark: SparkSession, folder: str, wrap: str, stream: bool = False, **options) -> DataFrame:
    """Payload text, one row per payload, in a column ``value``.

    ``json`` files hold one JSON payload per line and are split between tasks;
    ``body`` files are one JSON payload as a whole, line breaks and all; ``text``
    files are one payload as a whole; ``lines`` files give one payload per line
    that is not blank.
    """
    if wrap not in WRAPS:
        raise ValueError(f"wrap must be one of {', '.join(WRAPS)}")
    reader = spark.readStream.schema("value string") if stream else spark.read
    for name, value in options.items():
        reader = reader.option(name, value)
    payloads = reader.format("text").option("wholetext", wrap in WHOLE).load(folder)
    if wrap == "lines":
        payloads = payloads.select(trimmed_line("value").alias("value"))
    if wrap != "text":
        payloads = payloads.filter(F.trim("value") != "")
    return payloads


def wrap_payloads(payloads: DataFrame, wrap: str) -> DataFrame:
    """Add RAW: parsed JSON, or the text itself as one string value.

    JSON that does not parse, or that something follows, gives RAW NULL, so no
    payload is lost, in whole or in part. The parser stops after the first value
    of a text; so the payload is parsed as a member of an object that has one more
    member behind it, named after the payload's own hash, which must be found.
    """
    if wrap in ("json", "body"):
        end = F.md5("value")
        framed = F.concat(F.lit('{"v":'), "value", F.lit(',"'), end, F.lit('":1}'))
        members = F.try_variant_get("framed", "$", "map<string,variant>")
        whole = (F.size("members") == 2) & F.map_contains_key("members", end)
        return (
            payloads.withColumn("framed", F.try_parse_json(framed))
            .withColumn("members", members)
            .withColumn("RAW", F.when(whole, F.try_variant_get("framed", "$.v", "variant")))
            .drop("framed", "members")
        )
    return payloads.withColumn("RAW", F.col("value").cast("variant"))


def split_quarantine(wrapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows with RAW, and the text of payloads that could not be wrapped."""
    good = wrapped.filter(F.col("RAW").isNotNull()).drop("value")
    bad = wrapped.filter(F.col("RAW").isNull()).select(F.col("value").alias("payload"))
    return good, bad


def drop_header(lines: DataFrame, header: str, column: str = "value") -> DataFrame:
    """Lines that are not the header, which batches of one file repeat."""
    return lines.filter(F.col(column) != header)


def read_feed(spark: SparkSession, folder: str, feed: str) -> tuple[DataFrame, DataFrame]:
    """A landed feed as (raw rows, quarantined payloads)."""
    wrap = FEEDS[feed].wrap
    return split_quarantine(wrap_payloads(read_payloads(spark, folder, wrap), wrap))
