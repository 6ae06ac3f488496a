"""Compaction of a raw table: finished batches become larger files, readers switch as a whole.

A segment holds the rows of a run of batches. A generation is the list of segments that
stand for all batches up to its last one; later batches are read from their own folders.
Which generation is current is one small file, so every reader sees either the old files or
the new ones. Nothing is deleted by a compaction: a reader that has begun goes on with the
files it has found, until ``vacuum`` drops what no kept generation names.

Segments of one tier are merged when there are ``fan`` of them. So every row is rewritten a
number of times that grows with the logarithm of the number of batches, and a reader meets
a number of segments that does so.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.streaming import digests, manifest
from martlane.streaming.digests import Run

RAW_SCHEMA = "RAW variant, raw_key string, payload string, batch_id bigint, kind string"
GENERATIONS, SEGMENTS = "_generations", "_segments"
GENERATION_SCHEMA = (
    "name string, first_batch bigint, last_batch bigint, tier int, digests bigint, generation bigint"
)
FAN = 8


@dataclass(frozen=True)
class Segment:
    name: str
    first_batch: int
    last_batch: int
    tier: int
    digests: int


@dataclass(frozen=True)
class Generation:
    number: int = -1
    segments: tuple[Segment, ...] = ()

    @property
    def cutoff(self) -> int:
        """The last batch that segments stand for."""
        return self.segments[-1].last_batch if self.segments else -1


def _named(spark: SparkSession, out: str, number: int | None = None) -> Generation:
    table = manifest.side_table(spark, f"{out}/{GENERATIONS}", GENERATION_SCHEMA)
    if table is None:
        return Generation()
    if number is None:
        number = table.agg(F.max("generation")).first()[0]
    rows = table.filter(F.col("generation") == number).orderBy("first_batch").collect()
    fields = ("name", "first_batch", "last_batch", "tier", "digests")
    return Generation(number, tuple(Segment(*[r[f] for f in fields]) for r in rows))


def current(spark: SparkSession, out: str) -> Generation:
    """The newest generation; without segments if there has been no compaction."""
    return _named(spark, out)


def is_finished(spark: SparkSession, out: str, batch_id: int) -> bool:
    return manifest.is_marked(spark, out, batch_id) or batch_id <= current(spark, out).cutoff


def _segment_rows(spark: SparkSession, out: str, segment: Segment) -> DataFrame:
    folder = f"{out}/{SEGMENTS}/{segment.name}"
    return spark.read.schema(RAW_SCHEMA).option("basePath", folder).parquet(folder)


def _batch_rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).option("basePath", out).parquet(out)


def rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows of a raw table, each batch from its segment or else from its own folder."""
    now = current(spark, out)
    parts = [_segment_rows(spark, out, s) for s in now.segments]
    later = _batch_rows(spark, out)
    if now.segments:
        later = later.filter(F.col("batch_id") > now.cutoff)
    return reduce(DataFrame.unionByName, [*parts, later])


def runs(spark: SparkSession, out: str, before: int) -> list[Run]:
    """Where the digests of all batches before one are: segments, then single batches."""
    now = current(spark, out)
    found = [
        Run(f"{out}/{digests.MERGED}/{s.name}", s.digests, s.last_batch)
        for s in now.segments
        if s.digests and s.first_batch < before
    ]
    marked = manifest.marks(spark, out)
    if marked is not None:
        own = marked.filter((F.col("batch_id") > now.cutoff) & (F.col("batch_id") < before))
        # As many as there have been batches since the last compaction.
        for row in own.filter("digests > 0").collect():
            folder = f"{out}/{digests.SEEN}/batch_id={row['batch_id']}"
            found.append(Run(folder, row["digests"], row["batch_id"]))
    return found


def compact(spark: SparkSession, out: str, fan: int = FAN) -> Generation:
    """Merge the batches finished since the last generation, and segments of full tiers.

    Batches are finished in order, so all up to the last finished one are. One compaction
    at a time; a repeated one overwrites what a failed one left behind.
    """
    now = current(spark, out)
    marked = manifest.marks(spark, out)
    last = None if marked is None else marked.agg(F.max("batch_id")).first()[0]
    if last is None or last <= now.cutoff:
        return now
    own = marked.filter(F.col("batch_id") > now.cutoff).agg(F.sum("digests")).first()[0] or 0
    kept, merged, tier = list(now.segments), [], 0
    while len(kept) >= fan - 1 and all(s.tier == tier for s in kept[len(kept) - fan + 1 :]):
        merged = kept[len(kept) - fan + 1 :] + merged
        kept, tier = kept[: len(kept) - fan + 1], tier + 1
    name = f"generation={now.number + 1}"
    first = merged[0].first_batch if merged else now.cutoff + 1
    total = own + sum(s.digests for s in merged)
    segment = Segment(name, first, last, tier, total)

    fresh = F.col("batch_id").between(now.cutoff + 1, last)
    parts = [_segment_rows(spark, out, s) for s in merged]
    joined = reduce(DataFrame.unionByName, [*parts, _batch_rows(spark, out).filter(fresh)])
    # Sorted by batch, so that followers of the table read the row groups of their batches only.
    joined.hint("rebalance").sortWithinPartitions("batch_id").write.mode("overwrite").partitionBy(
        "kind"
    ).parquet(f"{out}/{SEGMENTS}/{name}")
    if total:
        old = [Run(f"{out}/{digests.MERGED}/{s.name}", s.digests, s.last_batch) for s in merged]
        new = [r for r in runs(spark, out, last + 1) if r.last_batch > now.cutoff]
        digests.merge(spark, [*old, *new], f"{out}/{digests.MERGED}/{name}", total)

    segments = (*kept, segment)
    listed = spark.createDataFrame(
        [(s.name, s.first_batch, s.last_batch, s.tier, s.digests) for s in segments],
        GENERATION_SCHEMA.rsplit(",", 1)[0],
    )
    folder = f"{out}/{GENERATIONS}/generation={now.number + 1}"
    listed.coalesce(1).write.mode("overwrite").parquet(folder)
    return Generation(now.number + 1, segments)


def vacuum(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Delete files that neither the current generation nor the ``keep`` before it read.

    Readers and streams that began before those must have ended. Returns the folders.
    """
    now = current(spark, out)
    oldest = now.number - keep
    if oldest < 0:
        return []
    named = {s.name for n in range(oldest, now.number + 1) for s in _named(spark, out, n).segments}
    cutoff = _named(spark, out, oldest).cutoff
    table = manifest.side_table(spark, f"{out}/{GENERATIONS}", GENERATION_SCHEMA)
    gone = []
    # As many rows as generations have been made since the last vacuum.
    past = table.filter(F.col("generation") < oldest).select("generation").distinct().collect()
    for number in sorted(r[0] for r in past):
        name = f"generation={number}"
        gone += [f"{out}/{GENERATIONS}/{name}"]
        if name not in named:
            gone += [f"{out}/{SEGMENTS}/{name}", f"{out}/{digests.MERGED}/{name}"]
    for name in {f"generation={n}" for n in range(oldest, now.number)} - named:
        gone += [f"{out}/{SEGMENTS}/{name}", f"{out}/{digests.MERGED}/{name}"]
    # The last mark stays: followers of the manifest see from it how far the table goes.
    covered = manifest.marks(spark, out).filter(F.col("batch_id") < cutoff)
    for batch_id in sorted(r[0] for r in covered.select("batch_id").collect()):
        gone += [f"{out}/{part}batch_id={batch_id}" for part in ("", f"{digests.SEEN}/", f"{manifest.MANIFEST}/")]
    for folder in gone:
        manifest.remove(spark, folder)
    return gone
