"""Seed CSV files: read as text, typed in staging."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martlane.sources.schemas import SEEDS


def seed_columns(table: str) -> list[tuple[str, str]]:
    """Names and types of a seed table, in file order."""
    return re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", SEEDS[table])


def text_schema(table: str) -> T.StructType:
    """The same columns, all text, so codes keep their leading zeros."""
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in seed_columns(table)])


def read_seed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``<folder>/<table>.csv`` with a header row; an empty field is NULL."""
    return (
        spark.read.schema(text_schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", False)
        .option("mode", "FAILFAST")
        .csv(f"{folder.rstrip('/')}/{table}.csv")
    )
