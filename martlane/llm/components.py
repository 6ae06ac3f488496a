"""Connected components of a table of links, by hooking to smaller neighbours.

Large-star and small-star steps in turn: every node's larger neighbours, then its
smaller ones, are linked to the smallest node around it. Links never get more, and
after a number of rounds that grows with the logarithm of the longest path they
are stars. Each round's links are a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import written


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_least(both), "u").filter("v > u")
    # Links that are there twice go with the next small star.
    return near.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    near = down.join(least, "u").filter("v <> m")
    near = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links lead to; only nodes that have a link to another.

    ``links`` has two whole-number columns u and v; nulls and loops are left out.
    """
    now = written(links.select("u", "v").filter("u <> v").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "links")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
