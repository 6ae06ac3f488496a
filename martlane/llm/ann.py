"""Nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more component that brings them
all to length 1; the largest inner product is then the smallest distance. Each of
TABLES tables projects them on Gaussian directions (Gauss is 2-stable), shifts and
floors by a width, and so deals them to cells. A query visits the cells of a table
in the order of the chance that a neighbour at the usual distance lies there, its
own cell and ever more perturbed ones, until that chance adds up to SUCCESS. The
candidates of all tables are merged and ranked by the exact measure.

The directions are few, so the number of cells is bounded by the width and not by
the rows; their counts are collected. Cells are cut into portions of bounded size,
portions are gathered to groups of about GROUP_ROWS vectors, and a task holds one
group while the queries that visit it stream by, each sent once per group with the
portions it visits. So neither a hot cell nor all copies of a vector meet in one task.

The usual distance is that of the k-th neighbour among all rows, measured exactly
for a bounded sample of the queries.

Defined results: vectors that are null, zero or hold null or non-finite components
take no part, as query or as candidate, nor do vectors of another length than most;
rows with equal vec_id are candidates each for itself, and as queries one query; a
query is not its own candidate by id; ties go to the smaller vec_id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.llm.common import parts, written
from martlane.llm.vectors import matrix, usable

TABLES = 2
DIRECTIONS = 4
WIDTH = 1.0
SUCCESS = 0.85
SAMPLE = 64  # queries that the usual distance is measured with
USUAL = 0.8  # quantile of their k-th neighbours' distances
GROUP_ROWS = 16_384
PORTION_ROWS = 4_096
TOGETHER = 256  # queries whose products are taken at once
SEED = 11


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, to about 1e-7."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    # Coefficients of the rational approximation of the error function.
    series = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    tail = sum(c * t ** (i + 1) for i, c in enumerate(series)) * np.exp(-x * x)
    return np.where(z > 0, 1 - tail / 2, tail / 2)


class Hashes:
    """Directions and shifts of the tables, for vectors of so many components."""

    def __init__(self, dims: int, norm: float):
        draw = np.random.default_rng(SEED)
        self.norm = norm
        self.directions = draw.normal(size=(TABLES, dims + 1, DIRECTIONS))
        self.shifts = draw.uniform(0, WIDTH, (TABLES, DIRECTIONS))

    def projected(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Tables x rows x directions."""
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            more = np.zeros((len(x), 1))
        else:
            unit = x / self.norm
            more = np.sqrt(np.maximum(1 - np.square(unit).sum(1, keepdims=True), 0))
        return np.concatenate([unit, more], axis=1) @ self.directions + self.shifts[:, None, :]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Tables x rows: each vector's cell as one number."""
        steps = np.clip(np.floor(self.projected(x, False) / WIDTH), -100, 99).astype(np.int64) + 100
        return steps @ (200 ** np.arange(DIRECTIONS, dtype=np.int64))


class Cells:
    """The cells of one table, their portions and the groups these belong to."""

    def __init__(self, table: int, numbers: np.ndarray, counts: np.ndarray, first_group: int):
        self.table, self.numbers, self.counts = table, numbers, counts
        self.portions = -(-counts // PORTION_ROWS)
        self.first = np.cumsum(self.portions) - self.portions
        rows = np.repeat(counts / self.portions, self.portions)
        self.group = first_group + (np.cumsum(rows) // GROUP_ROWS).astype(np.int64)
        self.low = (numbers[:, None] // 200 ** np.arange(DIRECTIONS) % 200 - 100) * WIDTH

    def portion_of(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.numbers, cells)
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[at] + (spread % self.portions[at].astype(np.uint64)).astype(np.int64)

    def visited(self, projected: np.ndarray, distance: float, least: int) -> list[np.ndarray]:
        """Each query's portions, until the chances of their cells add up to SUCCESS and they
        hold so many rows at least."""
        found = []
        for row in projected:
            low = (self.low - row) / distance
            chance = np.prod(_normal(low + WIDTH / distance) - _normal(low), axis=1)
            order = np.argsort(-chance, kind="stable")
            sums = np.cumsum(chance[order])
            enough = np.searchsorted(np.cumsum(self.counts[order]), least)
            cells = order[: max(np.searchsorted(sums, SUCCESS * sums[-1]), enough) + 1]
            found.append(
                np.concatenate([self.first[c] + np.arange(self.portions[c]) for c in cells])
            )
        return found


def _best(q, q_ids, x, x_ids, x_rows, k: int, candidate: np.ndarray | bool = True) -> pd.DataFrame:
    """Each query's k best candidate rows of x; the final products do not depend on a row's place."""
    near = np.where(candidate & (q_ids[:, None] != x_ids), q @ x.T, -np.inf)
    if len(x_ids) > k:
        floor = np.partition(near, len(x_ids) - k, axis=1)[:, len(x_ids) - k]
        slack = 1e-12 * np.maximum(np.abs(floor), 1)
        kept = near >= np.where(np.isfinite(floor), floor - slack, floor)[:, None]
    else:
        kept = np.ones(near.shape, bool)
    rows, columns = np.nonzero(kept & np.isfinite(near))
    scores = (q[rows] * x[columns]).sum(1)
    out = pd.DataFrame(
        {
            **{"query_id": q_ids[rows], "row": x_rows[columns]},
            **{"vec_id": x_ids[columns], "score": scores},
        }
    )
    out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    out = out.drop_duplicates(["query_id", "row"])
    return out.groupby("query_id", sort=False).head(k)


BEST = "query_id long, row long, vec_id long, score double"
COLUMNS = ["grp", "role", "vec_id", "embedding", "portions", "row"]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # A row may be found in several tables, and by query rows of one id.
    found = found.groupBy("query_id", "row").agg(
        F.max("vec_id").alias("vec_id"), F.max("score").alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The true neighbours of a bounded number of queries, against all rows in blocks."""
    asked = queries.toPandas()
    q, q_ids = matrix(asked["embedding"]), asked["vec_id"].to_numpy()

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(q_ids) and len(batch):
                x = matrix(batch["embedding"])
                x_ids, x_rows = batch["vec_id"].to_numpy(), batch["row"].to_numpy()
                yield _best(q, q_ids, x, x_ids, x_rows, k)

    return _ranked(rows.select("vec_id", "embedding", "row").mapInPandas(best, BEST), k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query."""
    numbered = usable(vectors).withColumn("row", F.monotonically_increasing_id())
    rows = written(numbered, "ann-vectors")
    asked = written(usable(queries), "ann-queries")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    shape = rows.agg(F.max(norm).alias("norm"), F.max(F.size("embedding")).alias("dims")).first()
    spark = rows.sparkSession
    sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    last = exact(sample, rows, k).groupBy("query_id").agg(F.min("score").alias("score"))
    lengths = asked.join(last, F.col("vec_id") == F.col("query_id")).select("score", norm.alias("q"))
    known = lengths.toPandas()  # at most SAMPLE rows
    if not len(known):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    gaps = np.sqrt(np.maximum(2 - 2 * known["score"] / (known["q"] * shape["norm"]), 0.01))
    distance = float(np.quantile(gaps, USUAL))
    hashes = Hashes(shape["dims"], shape["norm"])

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for table, cells in enumerate(hashes.cells(matrix(batch["embedding"]))):
                yield pd.DataFrame({"place": table, "cell": cells, "vec_id": batch["vec_id"]})

    counted = rows.mapInPandas(dealt, "place int, cell long, vec_id long").groupBy("place", "cell")
    counts = counted.count().toPandas().sort_values(["place", "cell"])
    tables, groups = [], 0
    for table, own in counts.groupby("place"):
        tables.append(Cells(table, own["cell"].to_numpy(), own["count"].to_numpy(), groups))
        groups = int(tables[-1].group[-1]) + 1

    schema = "grp long, role int, vec_id long, embedding array<double>, portions array<long>, row long"

    def stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, cells in zip(tables, hashes.cells(matrix(batch["embedding"])), strict=True):
                at = own.portion_of(cells, batch["row"].to_numpy())
                yield batch.assign(grp=own.group[at], role=0, portions=[[x] for x in at])[COLUMNS]

    def asking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            placed = hashes.projected(matrix(batch["embedding"]), True)
            for own, projected in zip(tables, placed, strict=True):
                sent = []
                visits = own.visited(projected, distance, k + 1)
                for vec_id, vector, to in zip(
                    batch["vec_id"], batch["embedding"], visits, strict=True
                ):
                    of = own.group[to]
                    sent += [(g, 1, vec_id, vector, to[of == g], 0) for g in np.unique(of)]
                yield pd.DataFrame(sent, columns=COLUMNS)

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, role, held, x, x_ids, x_rows, at = None, None, [], None, None, None, None
        best = []

        def asked_of(chunk: list) -> pd.DataFrame:
            q = np.stack([r[3] for r in chunk]).astype(np.float64)
            q_ids = np.array([r[2] for r in chunk])
            # Only rows of portions that a query visits are its candidates.
            visits = np.zeros((len(chunk), int(at.max()) + 1), bool)
            for i, r in enumerate(chunk):
                visits[i, r[4][r[4] <= at.max()]] = True
            return _best(q, q_ids, x, x_ids, x_rows, k, visits[:, at])

        for batch in batches:
            for r in batch[COLUMNS].itertuples(index=False, name=None):
                if (r[0], r[1]) != (now, role):
                    if role == 1 and held and x is not None:
                        best.append(asked_of(held))
                    elif role == 0 and held and r[0] == now:
                        x = np.stack([y[3] for y in held]).astype(np.float64)
                        x_ids = np.array([y[2] for y in held])
                        x_rows = np.array([y[5] for y in held])
                        at = np.array([y[4][0] for y in held])
                    if r[0] != now:
                        x = None
                    now, role, held = r[0], r[1], []
                held.append(r)
                if role == 1 and len(held) == TOGETHER:
                    if x is not None:
                        best.append(asked_of(held))
                    held = []
            if best:
                yield pd.concat(best)
                best = []
        if role == 1 and held and x is not None:
            yield asked_of(held)

    sent = rows.mapInPandas(stored, schema).unionAll(asked.mapInPandas(asking, schema))
    found = (
        sent.repartition(max(parts(spark), groups), "grp")
        .sortWithinPartitions("grp", "role")
        .mapInPandas(met, BEST)
    )
    return _ranked(found, k)
