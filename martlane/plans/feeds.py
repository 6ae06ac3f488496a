"""Feed marts: rail overview and weather station catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.dates import minutes_between
from martlane.operators.latest import latest_per_key
from martlane.operators.unions import align_union

RAIL_COLUMNS = (
    "departure",
    "station_name",
    "line_text",
    "product",
    "operator",
    "latitude",
    "longitude",
    "delay_minutes",
    "platform",
    "data_source",
)


def mart_swiss_rail_overview(connections: DataFrame, stationboard: DataFrame) -> DataFrame:
    """Both departure feeds in one shape.

    The connection feed's product is the line and its category the product.
    Its delay passes through; the station board's is 0 unless flagged late
    with both times known.
    """
    first = connections.select(
        "departure",
        F.col("from_station").alias("station_name"),
        F.col("product").alias("line_text"),
        F.col("category").alias("product"),
        "operator",
        F.col("from_latitude").alias("latitude"),
        F.col("from_longitude").alias("longitude"),
        "delay_minutes",
        "platform",
        F.lit("transport_opendata").alias("data_source"),
    )
    planned, expected = F.col("scheduled_departure"), F.col("forecast_departure")
    late = F.when(F.col("has_departure_delay"), minutes_between(planned, expected))
    second = stationboard.select(
        planned.alias("departure"),
        "station_name",
        "line_text",
        "product",
        F.col("operator_name").alias("operator"),
        F.coalesce(late, F.lit(0)).alias("delay_minutes"),
        F.lit("sbb_stationboard").alias("data_source"),
    )
    return align_union(first, second, columns=RAIL_COLUMNS)


def mart_weather_station_catalog(stations: DataFrame, latest_only: bool = False) -> DataFrame:
    """Stations as published; every poll adds rows.

    ``latest_only`` keeps the newest row per station, which is what a unique
    station id needs.
    """
    columns = ["station_id", "station_name", "latitude", "longitude", "last_update", "num_assets"]
    if not latest_only:
        return stations.select(*columns)
    rest = {c: c for c in columns if c != "station_id"}
    return latest_per_key(stations, ["station_id"], "last_update", rest)
