"""Landed payload files into an append-only raw table, and flattening it.

A raw table is a parquet folder with one sub-folder per micro-batch. A batch
that is repeated after a failure replaces what it wrote in part, and leaves
alone what it had finished, since a stream may have read those files already.
So nothing is doubled, here or downstream. That a batch is finished is a row of
the table's own manifest, written last; that a payload has been there is told by
its digest, in an index beside the payloads (``digests``). Batches are merged into
larger files by ``generations.compact``. All that lies in folders that a plain scan of
the raw table passes over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlane.operators.flatten import misfits
from martlane.sources.feeds import read_payloads, wrap_payloads
from martlane.sources.schemas import FEEDS, Feed
from martlane.streaming import digests, generations, manifest
from martlane.streaming.generations import RAW_SCHEMA

GOOD, BAD = "raw", "quarantine"


def run_trigger(feed: Feed, once: bool) -> dict:
    """All that has landed, once; or again and again at the feed's period."""
    return {"availableNow": True} if once else {"processingTime": feed.period}


def first_per_digest(batch: DataFrame) -> DataFrame:
    """One payload per digest.

    Equal digests are equal texts, so a changed payload of a known key stays. The
    choice is an aggregate, so copies are reduced before the shuffle.
    """
    return batch.groupBy("digest").agg(F.min("value").alias("value"))


def write_batch(
    batch: DataFrame,
    batch_id: int,
    feed: Feed,
    out: str,
    dedupe: bool,
    look_back: int | None = None,
) -> None:
    """Wrap a batch of payload texts; good rows and quarantine go out in one job.

    ``dedupe`` leaves out payloads that were there before, in this batch or, with
    ``look_back``, in so many batches before it, else in all.
    """
    spark = batch.sparkSession
    if generations.is_finished(spark, out, batch_id):
        return
    rows, added = batch.select("value"), None
    if dedupe:
        chosen = first_per_digest(rows.withColumn("digest", F.sha2("value", 256))).persist()
        since = None if look_back is None else batch_id - look_back
        known = digests.known(chosen, generations.runs(spark, out, batch_id), since)
        fresh = chosen if known is None else chosen.join(known, "digest", "left_anti").persist()
        added = fresh.count()
        if added:
            own = fresh.select("digest", F.lit(batch_id).cast("bigint").alias("batch_id"))
            digests.write(own, f"{out}/{digests.SEEN}/batch_id={batch_id}", added)
        rows = fresh.select("value")
    good = F.col("RAW").isNotNull()
    key = F.lit(None) if feed.key_path is None else F.try_variant_get("RAW", feed.key_path, "string")
    wrap_payloads(rows, feed.wrap).select(
        "RAW",
        key.cast("string").alias("raw_key"),
        F.when(~good, F.col("value")).alias("payload"),
        F.when(good, F.lit(GOOD)).otherwise(F.lit(BAD)).alias("kind"),
    ).write.mode("overwrite").partitionBy("kind").parquet(f"{out}/batch_id={batch_id}")
    if dedupe:
        chosen.unpersist()
        fresh.unpersist()
    manifest.mark(spark, out, batch_id, digests=added)


def ingest(
    spark: SparkSession,
    feed: str | Feed,
    landing: str,
    out: str,
    checkpoint: str,
    dedupe: bool = False,
    once: bool = True,
    max_files: int | None = None,
    look_back: int | None = None,
) -> StreamingQuery:
    """Start the stream from the landing folder into the raw table ``out``."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    options = {"maxFilesPerTrigger": max_files} if max_files else {}
    payloads = read_payloads(spark, landing, feed.wrap, stream=True, **options)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, feed, out, dedupe, look_back)

    return (
        payloads.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**run_trigger(feed, once))
        .start()
    )


def _layer(spark: SparkSession, out: str, kind: str | None) -> DataFrame:
    table = generations.rows(spark, out)
    return table if kind is None else table.filter(F.col("kind") == kind)


def read_raw(spark: SparkSession, out: str) -> DataFrame:
    """The good rows of a raw table: RAW, raw_key, batch_id."""
    return _layer(spark, out, GOOD).select("RAW", "raw_key", "batch_id")


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    """Payloads that could not be wrapped: payload, batch_id."""
    return _layer(spark, out, BAD).select("payload", "batch_id")


def stream_raw(spark: SparkSession, out: str, **options) -> DataFrame:
    """The batch folders as a stream, for incremental flattening of a table that is not compacted.

    ``follow`` goes on through compactions.
    """
    reader = spark.readStream.schema(RAW_SCHEMA)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(out).filter(F.col("kind") == GOOD).select("RAW")


def flatten_stream(
    raw: DataFrame,
    flattener: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    once: bool = True,
    period: str = "1 minute",
) -> StreamingQuery:
    """Append flattened rows of a raw stream to the parquet table ``out``."""
    trigger = {"availableNow": True} if once else {"processingTime": period}
    return (
        flattener(raw)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def misfit_stream(
    raw: DataFrame,
    array_path: str,
    fields: Mapping[str, tuple[str, str]],
    out: str,
    checkpoint: str,
    once: bool = True,
    period: str = "1 minute",
) -> StreamingQuery:
    """Append the elements that do not fit their types to the quarantine table ``out``.

    Run beside a ``flatten_stream`` whose flattener is lenient: then one bad value
    neither stops the stream nor gets lost.
    """
    return flatten_stream(
        raw, lambda df: misfits(df, array_path, fields), out, checkpoint, once, period
    )
