"""Which payloads have been there: a membership index over digests, and exact look-ups of its hits.

The digests of a batch, or of the batches of a segment, are a run: a folder of slots, files of
digests told apart by a hash, and beside them Bloom bitmaps of BLOCK bits. All bits of a
digest lie in the one block that its hash names, so a candidate and a run meet in one row
of bitmaps. Only the slots in which a bitmap says a candidate may be are read, so a batch
reads bitmaps (16 bits a digest) and the slots of payloads that come again, not all digests.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEEN, MERGED = "_seen", "_seen_segments"
SCHEMA = "digest string, batch_id bigint, block bigint, bits binary, slot int"
BLOCK = 32768  # bits of a bitmap that Spark's bitmap aggregates build
BITS = 16  # of a block for every digest
HASHES = 7
SLOT_DIGESTS = 1 << 16
BITMAPS = -1  # the slot of the bitmaps


@dataclass(frozen=True)
class Run:
    folder: str
    digests: int
    last_batch: int

    @property
    def blocks(self) -> int:
        return -(-self.digests * BITS // BLOCK)

    @property
    def slots(self) -> int:
        return -(-self.digests // SLOT_DIGESTS)


def _bit(n: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(n)), F.lit(BLOCK))


def _share(n: int, of: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(-n)), F.lit(of))


def write(found: DataFrame, folder: str, total: int) -> None:
    """A run of ``total`` digests from rows of digest and batch_id; one job.

    The digests of a block meet before their bits are set, since a bitmap of a few of them is as
    large as that of all. The rows of a slot meet before they are written, so that a run has about
    as many files as slots, not as many for every task.
    """
    run = Run(folder, total, 0)
    dealt = found.select("digest", _share(1, run.blocks).alias("block")).repartition("block")
    bits = dealt.select("block", F.explode(F.array(*[_bit(n) for n in range(HASHES)])).alias("bit"))
    bitmaps = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    marked = bitmaps.withColumn("slot", F.lit(BITMAPS))
    slots = found.select("digest", "batch_id", _share(2, run.slots).cast("int").alias("slot"))
    both = slots.unionByName(marked, allowMissingColumns=True).hint("rebalance", "slot")
    both.write.mode("overwrite").partitionBy("slot").parquet(folder)


def merge(spark: SparkSession, parts: Sequence[Run], folder: str, total: int) -> None:
    """One run of several."""
    rows = [_rows(spark, r.folder).filter(F.col("slot") != BITMAPS) for r in parts]
    found = rows[0]
    for more in rows[1:]:
        found = found.unionByName(more)
    write(found.select("digest", "batch_id"), folder, total)


def _rows(spark: SparkSession, folder: str, slots: Sequence[int] | None = None) -> DataFrame:
    # A batch's own folder is named after it, but its rows say their batch as well.
    paths = [folder] if slots is None else [f"{folder}/slot={s}" for s in slots]
    reader = spark.read.schema(SCHEMA).option("basePath", folder)
    return reader.parquet(*paths)


def suspects(batch: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """digest, and the number of a run (``at``) and its ``slot``, where a bitmap has all the digest's bits."""
    spark = batch.sparkSession
    where = F.array(
        *[
            F.struct(
                F.lit(i).alias("at"),
                _share(1, r.blocks).alias("block"),
                _share(2, r.slots).cast("int").alias("slot"),
            )
            for i, r in enumerate(runs)
        ]
    )
    asked = batch.select("digest", F.explode(where).alias("w")).select("digest", "w.*")
    bitmaps = None
    for i, r in enumerate(runs):
        own = _rows(spark, r.folder, [BITMAPS]).select(F.lit(i).alias("at"), "block", "bits")
        bitmaps = own if bitmaps is None else bitmaps.unionByName(own)
    met = asked.join(bitmaps, ["at", "block"])

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0

    for n in range(HASHES):
        met = met.filter(is_set(_bit(n)))
    return met.select("digest", "at", "slot")


def known(batch: DataFrame, runs: Sequence[Run], since: int | None = None) -> DataFrame | None:
    """Digests of the batch that one of the runs has, in batch ``since`` or later; None if none can be."""
    runs = [r for r in runs if since is None or r.last_batch >= since]
    if not runs:
        return None
    spark = batch.sparkSession
    found = suspects(batch, runs)
    # Folders to read: at most as many as the runs have slots.
    pairs = sorted((r["at"], r["slot"]) for r in found.select("at", "slot").distinct().collect())
    seen = None
    for at in dict.fromkeys(at for at, _ in pairs):
        own = _rows(spark, runs[at].folder, [s for a, s in pairs if a == at])
        seen = own if seen is None else seen.unionByName(own)
    if seen is None:
        return None
    if since is not None:
        seen = seen.filter(F.col("batch_id") >= since)
    return seen.select("digest").join(batch.select("digest"), "digest", "left_semi")
