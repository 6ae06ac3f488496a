"""Near-duplicate vectors of one label by collision-counting projections.

Vectors of length 1 whose cosine reaches the threshold are close, so on a random
direction their projections lie within a window of each other far more often than
those of other vectors. The projections on the first directions are cut into cells
as wide as a window: only vectors of the same or of neighbouring cells (the window
around a query) meet. There the collisions of each pair on all further directions
are counted, and pairs that collide at least as often as RECALL of all pairs at
the threshold do are verified in double precision.

Cells are cut into portions of bounded size. A task holds one portion while the
vectors of its cell and of the cells before it stream by, so neither a label with
most rows nor a group of copies is gathered, and pairs are never written: a portion
yields link counts and, for the components, one link for each vector into what is
connected within the portion.

Defined results: vectors that are null, zero or hold null or non-finite components
and rows without a label link with nothing; rows with one vec_id do not link with
one another and share the sum of their links; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.ann import _normal
from martlane.llm.common import parts, written
from martlane.llm.components import components
from martlane.llm.vectors import matrix, usable

THRESHOLD = 0.93
CELL_DIRECTIONS = 2
CELL_SPAN = 2.8  # half windows of the first directions, in deviations of a pair at the threshold
COUNTED = 40  # further directions
COUNT_SPAN = 1.6
RECALL = 0.995  # of pairs at the threshold, by the count alone
PORTION_ROWS = 1_024
TOGETHER = 128  # vectors that are compared with a portion at once
SEED = 23
COLUMNS = ["holder", "role", "own", "vec_id", "embedding"]
SENT = "holder long, role int, own long, vec_id long, embedding array<double>"
# The cells that come after a cell among its neighbours, itself first.
_AHEAD = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]


def least_count(counted: int, span: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with the wanted chance."""
    p = float(1 - 2 * _normal(np.array([-span]))[0])
    chance = 0.0
    for count in range(counted, -1, -1):
        chance += comb(counted, count) * p**count * (1 - p) ** (counted - count)
        if chance >= recall:
            return count
    return 0


class Windows:
    """The directions, and the widths of their windows for a threshold."""

    def __init__(self, dims: int, threshold: float):
        draw = np.random.default_rng(SEED)
        self.threshold = threshold
        self.first = draw.normal(size=(dims, CELL_DIRECTIONS))
        self.further = draw.normal(size=(dims, COUNTED)).astype(np.float32)
        deviation = np.sqrt(max(2 - 2 * threshold, 1e-6))
        self.cell = CELL_SPAN * deviation
        self.window = np.float32(COUNT_SPAN * deviation)
        self.least = least_count(COUNTED, COUNT_SPAN, RECALL)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.floor(x @ self.first / self.cell).astype(np.int64)

    def linked(self, x: np.ndarray, xp: np.ndarray, y: np.ndarray, yp: np.ndarray) -> np.ndarray:
        """Which rows of x and y (of length 1, with their projections) are near."""
        count = np.zeros((len(x), len(y)), np.uint8)
        for k in range(COUNTED):
            count += np.abs(xp[:, k, None] - yp[:, k]) <= self.window
        near = count >= self.least
        rows, columns = np.nonzero(near)
        cosine = np.einsum("ij,ij->i", x[rows], y[columns])
        near[rows, columns] = cosine >= self.threshold
        return near


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Portion:
    """The vectors a task holds, their links and what is connected among them."""

    def __init__(self, windows: Windows, holder: int, rows: list):
        self.windows, self.holder = windows, holder
        self.ids = np.array([r[3] for r in rows])
        self.x = _unit(np.stack([r[4] for r in rows]).astype(np.float64))
        self.projected = self.x.astype(np.float32) @ windows.further
        self.root = np.arange(len(rows))
        self.links = np.zeros(len(rows), np.int64)

    def meet(self, rows: list) -> list[tuple[int, int, int]]:
        """vec_id, links and one linked vec_id of each visitor that has links here."""
        x = _unit(np.stack([r[4] for r in rows]).astype(np.float64))
        ids = np.array([r[3] for r in rows])
        foreign = np.array([r[2] != self.holder for r in rows])
        near = self.windows.linked(
            x, x.astype(np.float32) @ self.windows.further, self.x, self.projected
        )
        near &= ids[:, None] != self.ids
        self.links += near[foreign].sum(0)
        found = []
        for i in np.flatnonzero(near.any(1)):
            linked = np.flatnonzero(near[i])
            roots = np.unique(self.root[linked])
            if len(roots) > 1:
                self.root[np.isin(self.root, roots)] = roots[0]
            found.append((int(ids[i]), len(linked), int(self.ids[linked[0]])))
        return found

    def held(self) -> list[tuple[int, int, int]]:
        some = np.flatnonzero((self.links > 0) | (self.root != np.arange(len(self.root))))
        return [(int(self.ids[i]), int(self.links[i]), int(self.ids[self.root[i]])) for i in some]


def link(
    vectors: DataFrame, threshold: float = THRESHOLD, portion_rows: int = PORTION_ROWS
) -> DataFrame:
    """vec_id, links and other: each vector's links within a portion, and one linked vector."""
    rows = usable(vectors.filter("label is not null"), F.col("label").cast("string").alias("label"))
    rows = written(rows.dropDuplicates(["vec_id", "label", "embedding"]), "near-vectors")
    spark = rows.sparkSession
    dims = (rows.agg(F.max(F.size("embedding"))).first()[0]) or 1
    windows = Windows(dims, threshold)

    def celled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = windows.cells(_unit(matrix(batch["embedding"]))) if len(batch) else []
            yield batch.assign(
                a=[int(c[0]) for c in cells], b=[int(c[1]) for c in cells]
            )

    placed = written(
        rows.mapInPandas(celled, "vec_id long, embedding array<double>, label string, a long, b long"),
        "near-cells",
    )
    # One row per label and cell; both are far fewer than the vectors.
    sizes = placed.groupBy("label", "a", "b").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(portion_rows)).alias("portions")
    )
    sizes = written(sizes, "near-sizes")
    ahead = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _AHEAD]))
    others = sizes.select(
        "label", F.col("a").alias("to_a"), F.col("b").alias("to_b"),
        F.col("portions").alias("to_portions"),
    )
    routes = (
        sizes.withColumn("step", ahead)
        .withColumn("to_a", F.col("a") + F.col("step.i"))
        .withColumn("to_b", F.col("b") + F.col("step.j"))
        .join(others, ["label", "to_a", "to_b"])
        .groupBy("label", "a", "b", "portions")
        .agg(F.collect_list(F.struct("to_a", "to_b", "to_portions")).alias("to"))
    )
    holder = lambda a, b, p: F.xxhash64("label", a, b, p)
    own = placed.join(routes, ["label", "a", "b"]).withColumn(
        "portion", F.pmod(F.xxhash64("vec_id", "embedding"), "portions")
    ).withColumn("own", holder("a", "b", "portion"))
    visits = own.withColumn("to", F.explode("to")).withColumn(
        "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("to.to_portions") - 1))
    )
    same = (F.col("to.to_a") == F.col("a")) & (F.col("to.to_b") == F.col("b"))
    visits = visits.filter(~same | (F.col("p") >= F.col("portion"))).select(
        holder("to.to_a", "to.to_b", "p").alias("holder"), F.lit(1).alias("role"),
        "own", "vec_id", "embedding",
    )
    holds = own.select(
        F.col("own").alias("holder"), F.lit(0).alias("role"), "own", "vec_id", "embedding"
    )

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, portion, waiting, found = None, None, [], []

        def flush(end: bool) -> None:
            nonlocal portion, waiting
            if now is not None and now[1] == 0 and waiting:
                portion = Portion(windows, now[0], waiting)
            elif waiting and portion is not None:
                found.extend(portion.meet(waiting))
            waiting = []
            if end and portion is not None:
                found.extend(portion.held())
                portion = None

        for batch in batches:
            for row in batch[COLUMNS].itertuples(index=False, name=None):
                if row[:2] != now:
                    flush(now is not None and row[0] != now[0])
                    now = row[:2]
                waiting.append(row)
                if now[1] == 1 and len(waiting) == TOGETHER:
                    flush(False)
            yield pd.DataFrame(found, columns=["vec_id", "links", "other"], dtype="int64")
            found.clear()
        flush(True)
        yield pd.DataFrame(found, columns=["vec_id", "links", "other"], dtype="int64")

    return (
        holds.unionAll(visits)
        .repartition(parts(spark), "holder")
        .sortWithinPartitions("holder", "role")
        .mapInPandas(met, "vec_id long, links long, other long")
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, label, n_links, component_id and kept; one row per vector."""
    links = written(link(vectors, threshold), "near-links")
    counts = links.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    roots = components(links.select(F.col("vec_id").alias("u"), F.col("other").alias("v")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label")
        .join(counts, "vec_id", "left")
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            "label",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("root", "vec_id").alias("component_id"),
            F.coalesce(F.col("root") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
