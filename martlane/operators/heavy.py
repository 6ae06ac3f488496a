"""Heavy hitters of a key column, kept with the table they belong to.

A summary is a frequent-items sketch with a bounded number of counters, built in partial
steps and mergeable, so a table that grows by batches adds the summaries of its batches. It
over-estimates a count by at most 3.5 rows in 2^18 of the table, so every key with a share of
1/SHARE of the rows is among its first CANDIDATES. These are counted exactly. What is stored
is a few thousand rows at most, whatever the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy when it owns at least 1/SHARE of a table's rows, so there are at most SHARE.
SHARE = 20_000
COUNTERS = 1 << 17
# Counts are over-estimated by rows / 74,900 at most; so many keys can seem heavy.
CANDIDATES = 1 << 15


def summarize(df: DataFrame, key: str) -> DataFrame:
    """One row: the sketch of the column's values and how many there are; NULL is not counted."""
    keyed = df.select(F.col(key).alias("k")).filter("k is not null")
    return keyed.agg(
        F.expr(f"approx_top_k_accumulate(k, {COUNTERS})").alias("sketch"),
        F.count(F.lit(1)).alias("rows"),
    )


def combine(summaries: Sequence[DataFrame]) -> DataFrame:
    """The summary of all the tables that summaries are of."""
    rows = reduce(DataFrame.unionByName, summaries)
    return rows.agg(
        F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch"),
        F.sum("rows").alias("rows"),
    )


def candidates(summary: DataFrame, share: int = SHARE) -> DataFrame:
    """hot_key and total (rows of the table): all keys that can be heavy, and few others."""
    each = summary.select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {CANDIDATES})")).alias("c"), "rows"
    )
    likely = each.filter(F.col("c.count") >= F.greatest(F.lit(2.0), F.col("rows") / share))
    return likely.select(F.col("c.item").alias("hot_key"), F.col("rows").alias("total"))


def heavy_keys(df: DataFrame, key: str, summary: DataFrame, share: int = SHARE) -> DataFrame:
    """hot_key, n and total: keys with at least two rows and 1/share of all, counted exactly."""
    # A few thousand rows: see CANDIDATES.
    likely = F.broadcast(candidates(summary, share))
    met = df.select(F.col(key).alias("hot_key")).join(likely, "hot_key")
    counts = met.groupBy("hot_key").agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("total"))
    return counts.filter(F.col("n") >= F.greatest(F.lit(2.0), F.col("total") / share))
