"""Ranks over whole tables and large groups, without one task that sees all rows.

Rows are dealt to ranges of the order and sorted there. A row's place is the number
of rows in earlier ranges plus its own in the range; the first are running sums over
one number per range. So no window runs over a table or a group: only over ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlane.session import stored

# Bits of a row's number within its partition in Spark's increasing ids.
_ROW_BITS = 33


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equal values in all columns of two aliased frames, NULL being equal to NULL."""
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(Column.__and__, pairs)


def placed(df: DataFrame, order: Sequence[Column], place: str = "place") -> DataFrame:
    """The rows with their place, from 0, in the order of all rows.

    Rows that the order does not tell apart follow each other in some order; they are
    spread over ranges by the input partition they came from, so that one value with a
    large share of the rows is not one task's work. The places are a stored table.
    """
    salted = df.withColumn("_salt", F.spark_partition_id())
    dealt = salted.repartitionByRange(*order, "_salt").sortWithinPartitions(*order)
    numbered = dealt.drop("_salt").withColumn("_id", F.monotonically_increasing_id())
    numbered = stored(numbered, "placed")
    part = F.shiftright("_id", _ROW_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range of the shuffle, so this window and its broadcast are small whatever the table.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    joined = numbered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    own = F.col("_id") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return joined.select(*df.columns, (F.col("_start") + own).alias(place))


def placed_within(
    df: DataFrame, group: Mapping[str, Column], order: Sequence[Column], place: str = "place"
) -> DataFrame:
    """The rows with ``place`` in their group (from 0), ``group_start`` and ``group_rows``.

    ``group`` maps the group's columns to their sort order. ``group_start`` is the place
    of the group's first row among all rows, so it also numbers the groups in order.
    """
    everywhere = placed(df, [*group.values(), *order], "_place")
    groups = everywhere.groupBy(*group).agg(
        F.min("_place").alias("group_start"), F.count(F.lit(1)).alias("group_rows")
    )
    joined = everywhere.alias("r").join(groups.alias("g"), same("r", "g", list(group)))
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col("_place") - F.col("group_start")).alias(place),
        "group_start",
        "group_rows",
    )


def ranked(
    df: DataFrame,
    by: Mapping[str, Column],
    column: str = "rank",
    dense: bool = False,
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The rows with their rank, from 1, by the columns and sort orders in ``by``.

    Ties share a rank; the next one is higher by their number, or by 1 with ``dense``.
    With ``tiebreak`` no two rows share a rank (they do not if it tells all rows apart).
    """
    if tiebreak is not None:
        rows = placed(df, [*by.values(), *tiebreak], "_place")
        return rows.select(*df.columns, (F.col("_place") + 1).alias(column))
    if dense:
        keys = placed(df.select(*by).distinct(), list(by.values()), "_place")
        rows = df
    else:
        rows = placed(df, list(by.values()), "_row_place")
        keys = rows.groupBy(*by).agg(F.min("_row_place").alias("_place"))
    joined = rows.alias("r").join(keys.alias("k"), same("r", "k", list(by)))
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("_place") + 1).alias(column))
