"""Latest row per key, with the number of rows, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_order(ts: str, tiebreak: Sequence[str]) -> Column:
    """Sort value of a row: a missing time beats every time, then ids decide."""
    return F.struct(
        F.col(ts).isNull().alias("no_time"),
        F.col(ts).alias("time"),
        *[F.col(c).alias(f"tie_{i}") for i, c in enumerate(tiebreak)],
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    fields: Mapping[str, str],
    tiebreak: Sequence[str] = (),
    count_as: str | None = None,
) -> DataFrame:
    """One row per key with ``fields`` (source -> output name) of its latest row.

    The maximum of (order, payload) structs is a plain aggregate: every task
    keeps one candidate per key before the shuffle, so a key that owns a large
    share of the rows sends one row per task instead of all of them. The
    payload takes part in the comparison after the order, which makes full
    ties deterministic. ``count_as`` adds the row count from the same pass.
    """
    payload = F.struct(*[F.col(src).alias(out) for src, out in fields.items()])
    best = F.max(F.struct(latest_order(ts, tiebreak).alias("ord"), payload.alias("row")))
    aggs = [best.alias("best")]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = [F.col(f"best.row.{name}").alias(name) for name in fields.values()]
    if count_as:
        out.append(F.col(count_as))
    return df.groupBy(*keys).agg(*aggs).select(*keys, *out)
