"""Streams that keep one row per key: duplicate removal and latest value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlane.operators.latest import latest_per_key


def dedupe_within(
    df: DataFrame, keys: Sequence[str], event_time: str, delay: str, slots: int = 64
) -> DataFrame:
    """First row per key among rows at most ``delay`` apart in event time.

    Duplicate removal has no partial step of its own, so all copies of a key
    would meet in one task. Copies are first removed per key and slot, where
    the slot follows the input partition, which leaves at most ``slots`` rows
    per key for the step that decides. A repeated task may deal the slots
    differently; only the last step matters for the result.

    State is dropped once the watermark has passed, so it stays bounded. The
    watermark needs an instant; a wall-clock column is cast in place.
    """
    timed = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    timed = timed.withWatermark(event_time, delay)
    slot = F.pmod(F.spark_partition_id(), F.lit(slots))
    reduced = timed.withColumn("slot", slot).dropDuplicatesWithinWatermark([*keys, "slot"])
    return reduced.drop("slot").dropDuplicatesWithinWatermark(list(keys))


def latest_sink(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    out: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    once: bool = True,
    period: str = "1 minute",
) -> StreamingQuery:
    """Write the latest row per key of every micro-batch to ``out``.

    A batch is reduced to one row per key before it is written, into a folder
    of its own that a repeated batch overwrites. The merge with earlier
    batches happens in ``read_latest``, so a batch never rewrites the table.
    """
    fields = {c: c for c in dict.fromkeys([ts, *tiebreak, *columns]) if c not in keys}

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, ts, fields, tiebreak)
        newest.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    trigger = {"availableNow": True} if once else {"processingTime": period}
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_latest(
    spark: SparkSession,
    out: str,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The latest row per key over all micro-batches written so far."""
    changes = spark.read.option("basePath", out).parquet(out).drop("batch_id")
    fields: Mapping[str, str] = {c: c for c in changes.columns if c not in keys}
    return latest_per_key(changes, keys, ts, fields, tiebreak)
