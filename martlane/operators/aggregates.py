"""Aggregate helpers shared by marts and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sums(on: str, measure: str, names: Mapping[str, str]) -> list[Column]:
    """One sum per value of ``on`` (value -> output name), missing cells are 0.

    Plain conditional sums keep the number of columns fixed and stay in one
    hash aggregate, whatever values occur in the data.
    """
    return [
        F.sum(F.when(F.col(on) == value, F.col(measure)).otherwise(F.lit(0))).alias(out)
        for value, out in names.items()
    ]


def count_true(flag: Column | str) -> Column:
    """Rows where the flag is TRUE; NULL counts as not TRUE."""
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)


def any_match(condition: Column) -> Column:
    """1 when some row of the group meets the condition, else 0."""
    return F.max(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, NULL left out, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(column))
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; every task keeps its own ``k`` before they are merged."""
    return df.orderBy(*order).limit(k)
