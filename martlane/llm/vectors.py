"""Reading a table of embeddings: the rows that take part, as rows of a numpy matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(frame: DataFrame, *keep: str) -> DataFrame:
    """vec_id and embedding (doubles) of rows whose vector can be compared.

    Left out are null ids, null, empty and zero vectors, vectors with null or
    non-finite components, and those of another length than most.
    """
    numbers = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    found = (
        frame.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"), *keep)
        .filter("vec_id is not null and embedding is not null")
        .filter(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
    )
    length = F.size("embedding")
    usual = found.groupBy(length.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.filter(length == (usual["n"] if usual else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.empty((0, 0))
