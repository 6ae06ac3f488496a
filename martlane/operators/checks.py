"""Declared data checks: failing rows, and a report of failing-row counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.sources.schemas import TableChecks


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count; NULL is no value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~F.col(column).isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key the parent does not have; NULL passes."""
    known = parent.select(F.col(parent_column).alias("known_key")).distinct()
    keyed = child.filter(F.col(column).isNotNull())
    return keyed.join(known, F.col(column) == F.col("known_key"), "left_anti")


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Missing keys with the number of child rows that use them.

    Counting per key before the join means a key shared by many child rows
    crosses the shuffle as one row per task.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return relationships(used, column, parent, parent_column)


def _report(counts: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    )


def _row_checks(df: DataFrame, table: str, spec: TableChecks) -> DataFrame | None:
    """All checks that look at one row at a time, from a single scan."""
    tests: list[tuple[str, str, Column]] = [
        ("not_null", c, F.col(c).isNull()) for c in (*spec.key, *spec.required)
    ]
    tests += [
        ("accepted_values", c, ~F.col(c).isin(*values)) for c, values in spec.accepted.items()
    ]
    if not tests:
        return None
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check_name"),
                    F.lit(column).alias("column_name"),
                    F.count_if(condition).alias("failures"),
                )
                for check, column, condition in tests
            ]
        ).alias("results")
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline("results"))


def run_checks(df: DataFrame, table: str, spec: TableChecks, parent: Callable[[str], DataFrame]) -> DataFrame:
    """One report row per declared check: table_name, check_name, column_name, failures.

    ``failures`` counts rows for not_null, accepted_values and relationships,
    and repeated values for unique; 0 means the check passes. ``parent`` gives
    the frame of a referenced table.
    """
    parts = []
    rows = _row_checks(df, table, spec)
    if rows is not None:
        parts.append(rows)
    for column in spec.key:
        repeated = unique(df, column).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(_report(repeated, table, "unique", column))
    for column, (parent_table, parent_column) in spec.refs.items():
        orphans = orphan_counts(df, column, parent(parent_table), parent_column)
        lost = orphans.agg(F.sum("n_records").alias("failures"))
        parts.append(_report(lost, table, "relationships", column))
    return reduce(DataFrame.unionByName, parts)
