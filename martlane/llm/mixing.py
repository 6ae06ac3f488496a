"""Mixing sources to target weights by balanced sampling (the cube method).

Every row of a source is to be taken ``target / source_size`` times. The whole
part of that number is taken for certain; the rest is an inclusion probability,
and the cube method turns the probabilities into zeros and ones while the sums
of words and of rows stay as they are: three undecided rows at a time are moved
along the direction that changes neither sum, until one of them is decided.

Sources are cut into shards of bounded size that run side by side. A shard
leaves at most two rows undecided; these meet in shards of their own until one
shard per source is left, whose last rows are landed. Long documents go first,
so
what is landed is seldom long. Small sources are flown several times and the flight
whose words come nearest is kept.

Defined results: a null source is a source of its own and comes last; a null or
empty text has size 0 and is taken 0 words; equal rows are decided one by one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.llm.common import written

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE = 1.5  # words taken, per word there is
MOST = 2.0  # words a source gives at most, per word it has
SHARD_ROWS = 4_000  # rows decided in one task
LEFT_SHARDS = 4096  # shards whose undecided rows meet in one task of the next level
WORD = r"[^\x20\x09-\x0D]+"
FLIGHTS = 40  # tries of a last flight, until its words are within CLOSE of their sum
CLOSE = 5e-4
NEAR = 1e-9

PROBS = "doc_id long, source string, print long, size long, whole long, prob double, shard long"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, a fingerprint of the text, and the text's number of words."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("print"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """source, source_size, rows and target; one row per source.

    Targets are proportional to the weights but stop at ``most`` times the
    source; each round finds the level at which the sources that still have room
    take all that is left, until no further source is full.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    each = written(
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
        .withColumn("weight", weight)
        .withColumn("room", most * F.col("source_size")),
        "mix-sources",
    )
    level, full = 0.0, -1
    while True:
        is_full = F.col("weight") * level > F.col("room")
        at = each.agg(
            F.sum(F.col("source_size")).alias("words"),
            F.sum(F.when(is_full, F.col("room")).otherwise(0.0)).alias("held"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("free"),
            F.sum(is_full.cast("int")).alias("full"),
        ).first()
        if at["full"] is None or at["full"] == full or not at["free"]:
            break
        full = at["full"]
        level = (share * at["words"] - at["held"]) / at["free"]
    return each.select(
        "source",
        "source_size",
        "rows",
        F.least(F.col("weight") * level, F.col("room")).alias("target"),
    )


def _settled(prob: float) -> bool:
    return prob <= NEAR or prob >= 1 - NEAR


def _fly(sizes: list[int], probs: list[float], draw: random.Random, balance_rows: bool) -> None:
    """Moves the probabilities in place until no direction within the constraints is left."""
    need = 3 if balance_rows else 2
    active: list[int] = []
    ahead = (i for i, p in enumerate(probs) if not _settled(p))
    while True:
        while len(active) < need and (i := next(ahead, None)) is not None:
            active.append(i)
        x = [float(sizes[i]) for i in active]
        if balance_rows:
            if len(x) == 3 and not x[0] == x[1] == x[2]:
                way = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
            elif len(x) >= 2 and x[0] == x[1]:
                way = [1.0, -1.0, 0.0][: len(x)]
            else:
                return
        elif len(x) < 2:
            return
        else:
            way = [x[1], -x[0]] if x[0] or x[1] else [1.0, -1.0]
        p = [probs[i] for i in active]
        up = min((1 - q) / w if w > 0 else q / -w for q, w in zip(p, way, strict=True) if w)
        down = min(q / w if w > 0 else (1 - q) / -w for q, w in zip(p, way, strict=True) if w)
        step = up if draw.random() * (up + down) < down else -down
        for i, q, w in zip(active, p, way, strict=True):
            q += step * w
            probs[i] = 0.0 if q <= NEAR else 1.0 if q >= 1 - NEAR else q
        active = [i for i in active if not _settled(probs[i])]


def _decider(level: int, land: bool, seed: int):
    """The flight of one shard, and the landing if it is the last of its source."""

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        # Long rows move in small steps; they get all others to be balanced against.
        pdf = pdf.assign(short=pdf["size"] <= 4 * pdf["size"].mean())
        pdf = pdf.sort_values(["short", "print", "doc_id"], kind="stable").drop(columns="short")
        draw = random.Random(f"{seed}|{level}|{pdf['source'].iloc[0]!r}|{pdf['shard'].iloc[0]}")
        lengths, start = pdf["size"].tolist(), pdf["prob"].tolist()
        hoped = sum(n * p for n, p in zip(lengths, start, strict=True))
        best, off = start, float("inf")
        for _ in range(FLIGHTS if land else 1):
            probs = list(start)
            _fly(lengths, probs, draw, balance_rows=True)
            if land:
                _fly(lengths, probs, draw, balance_rows=False)
                probs = [p if _settled(p) else float(draw.random() < p) for p in probs]
            missed = abs(sum(n * p for n, p in zip(lengths, probs, strict=True)) - hoped)
            if missed < off:
                best, off = probs, missed
            if off <= CLOSE * hoped:
                break
        return pdf.assign(prob=[float(round(p)) if _settled(p) else p for p in best])

    return decide


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 1,
    shard_rows: int = SHARD_ROWS,
    left_shards: int = LEFT_SHARDS,
) -> DataFrame:
    """doc_id, source, print, size, source_size, target, copies and taken; one row per document."""
    rows = sizes(docs)
    targets = source_targets(rows, weights, share, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("times") + NEAR)
    dealt = (
        rows.join(targets, rows["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("times", times)
        .select(
            *("doc_id", "source", "print", "size"),
            whole.alias("whole"),
            F.greatest(F.col("times") - whole, F.lit(0.0)).alias("prob"),
            F.pmod(
                F.xxhash64("doc_id", "print"), F.ceil(F.col("rows") / F.lit(shard_rows))
            ).alias("shard"),
        )
    )
    shards = targets.agg(F.max(F.ceil(F.col("rows") / F.lit(shard_rows)))).first()[0] or 1
    level, decided = 0, []
    while True:
        land = shards == 1
        flight = dealt.groupBy("source", "shard").applyInPandas(
            _decider(level, land, seed), PROBS
        )
        step = written(flight, f"mix-level-{level}")
        decided.append(step.filter((F.col("prob") == 0) | (F.col("prob") == 1)))
        if land:
            break
        dealt = step.filter((F.col("prob") > 0) & (F.col("prob") < 1)).withColumn(
            "shard", F.floor(F.col("shard") / F.lit(left_shards))
        )
        shards = -(-shards // left_shards)
        level += 1
    done = decided[0]
    for step in decided[1:]:
        done = done.unionAll(step)
    done = done.withColumn("copies", F.col("whole") + F.col("prob").cast("long"))
    return (
        done.join(targets, done["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .select(
            *("doc_id", "source", "print", "size", "source_size", "target", "copies"),
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as the mix has them: each row as many times as it is taken."""
    key = ["doc_id", "source", "print"]
    decided = mixed.groupBy(*key).agg(
        F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("rows")
    )
    # The row is one column, so that no name of its own meets one of these.
    marked = docs.select(F.struct("*").alias("row"), "doc_id", "source", F.xxhash64("text").alias("print"))
    joined = (
        marked.alias("d")
        .join(
            decided.filter("copies > 0").alias("c"),
            [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key],
        )
        .select("d.*", "copies", "rows")
    )
    alone = joined.filter("rows = 1")
    # Equal rows are decided together: one of them is taken as often as all of them.
    equal = joined.filter("rows > 1").dropDuplicates(key)
    return (
        alone.unionAll(equal)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
