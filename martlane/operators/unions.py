"""Union of feeds that do not have the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_union(first: DataFrame, *others: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All rows of all frames with ``columns`` in this order; nothing is removed.

    Columns a frame lacks become NULLs with the type they have in ``first``.
    """
    types = {f.name: f.dataType for f in first.schema.fields}

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[
                F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c)
                for c in columns
            ]
        )

    result = shaped(first)
    for other in others:
        result = result.unionByName(shaped(other))
    return result
