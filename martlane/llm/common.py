"""Helpers the corpus operators share: tables, written steps, sizes of work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.session import work_folder


# What a Python worker gets at once: texts may be long, and workers share an executor's memory.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(spark: SparkSession) -> None:
    """Sets the size of batches, unless the session came with one."""
    given = dict(spark.sparkContext.getConf().getAll())
    for name, value in BATCHES.items():
        if name not in given:
            spark.conf.set(name, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def parts(spark: SparkSession, least: int = 1) -> int:
    """Partitions of a shuffle by the session's setting."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Rows (of a few numbers each) that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def few(keys: DataFrame) -> bool:
    return keys.count() <= BROADCAST_ROWS


def side(keys: DataFrame) -> DataFrame:
    """A written table of keys as a join's side: broadcast if it is small, checked by counting."""
    return F.broadcast(keys) if few(keys) else keys


def matching(frame: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """A semi or anti join on columns that may be null."""
    return frame.alias("f").join(
        keys.alias("k"), [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in on], how
    )


def documents(frame: DataFrame, *keep: str) -> DataFrame:
    """doc_id and the text as UTF-8 bytes (a null text is empty); rows without doc_id stay."""
    small_batches(frame.sparkSession)
    return frame.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"),
        *keep,
    )


def kept_by_worker(name: str, make):
    """What ``make`` returned when this Python worker last asked for ``name``.

    Functions arrive in a worker by value, so their module's globals are new with
    every task; a module of the worker's own holds what is costly to load. It holds
    one thing at a time: workers outlive an operator, and what the one before it kept
    would count against the executor's memory for as long as they live.
    """
    import sys
    import types

    held = sys.modules.setdefault("_martlane_worker", types.ModuleType("_martlane_worker"))
    if getattr(held, "name", None) != name:
        if hasattr(held, "name"):
            held.name = held.value = None
            _give_back()
        held.value = make()
        held.name = name
    return held.value


def _give_back() -> None:
    """Memory that is free again goes back to the system, where the C library can do that."""
    import ctypes
    import gc

    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def most_counted(counts: DataFrame, key: str, n: str, most: int) -> DataFrame:
    """About ``most`` rows of a written table of counts, those with the largest ones.

    No row is sent anywhere to be ranked: the numbers of rows per level of the count
    (exact ones up to 1024, then steps of about one in a hundred) say which levels fit;
    of the first that does not, rows are taken by a hash of their key.
    """
    size = F.col(n).cast("double")
    steps = F.lit(1024) + F.floor(F.log2(size / 1024) * 64)
    level = F.when(size < 1024, F.col(n).cast("long")).otherwise(steps.cast("long"))
    # A few thousand levels at most: 64 for every doubling.
    rows = counts.groupBy(level.alias("level")).count().collect()
    whole, share, room = None, 0.0, most
    for at, count in sorted(((r["level"], r["count"]) for r in rows), reverse=True):
        if count > room:
            whole, share = at, room / count
            break
        room -= count
    if whole is None:
        return counts
    chosen = F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * 0.99 * (1 << 30))
    return counts.filter((level > whole) | ((level == whole) & chosen))
