"""Staging: typed views over raw tables, and flattened feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.operators.flatten import flatten, object_size
from martlane.sources.schemas import (
    CONNECTION_FIELDS,
    DEPARTURE_FORMAT,
    DEPARTURE_PATTERN,
    STATION_FIELDS,
    STATIONBOARD_FIELDS,
)
from martlane.sources.seeds import seed_columns


def cast_select(raw: DataFrame, columns: Sequence[tuple[str, str]], strict: bool = True) -> DataFrame:
    """Exactly these columns with these types; no row is added or lost.

    ``strict`` raises on text that does not fit, otherwise it becomes NULL.
    """

    cast = "CAST" if strict else "TRY_CAST"
    return raw.selectExpr(*[f"{cast}({name} AS {t}) AS {name}" for name, t in columns])


def stage(raw: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """The typed view of one seed table."""
    return cast_select(raw, seed_columns(table), strict)


def stg_transport_connections(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per connection. Departures keep their wall-clock time."""
    flat = flatten(raw, "$.connections", CONNECTION_FIELDS, strict=strict)
    text = F.col("departure")
    if strict:
        departure = F.to_timestamp_ntz(text, F.lit(DEPARTURE_FORMAT))
    else:
        departure = F.when(text.rlike(DEPARTURE_PATTERN), F.left(text, F.lit(19)).try_cast("timestamp_ntz"))
    return flat.withColumn("departure", departure)


def stg_sbb_stationboard(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per station board entry."""
    return flatten(raw, "$.results", STATIONBOARD_FIELDS, strict=strict)


def stg_meteoswiss_stations(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per published item, with the number of its assets."""
    assets = {"num_assets": object_size("item", "$.assets")}
    return flatten(raw, "$.features", STATION_FIELDS, strict=strict, extra=assets)
