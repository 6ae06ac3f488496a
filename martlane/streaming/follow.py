"""Streams that follow a raw table through its manifest, with several sinks for one read.

What streams is the list of finished batches; their rows are read from wherever the current
generation has them. So a follower neither misses nor doubles a batch when batches are
merged or their folders dropped, and may start long after that. Each of its own
micro-batches is written in one job and marked in a manifest of its own, which also says
how far the raw table has been read: a repeated micro-batch reads the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlane.operators.flatten import path
from martlane.sources.feeds import wrap_payloads
from martlane.sources.schemas import Feed
from martlane.streaming import generations, manifest

FLAT, MISFIT = "flat", "misfit"
RECOVERED, LEDGER = "recovered", "ledger"


def follow(
    spark: SparkSession,
    out: str,
    target: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = True,
    period: str = "1 minute",
    max_batches: int | None = None,
) -> StreamingQuery:
    """Call ``write`` with the raw rows (both kinds) of newly finished batches, and mark it done.

    ``max_batches`` bounds how many batches are read at once. ``write`` must overwrite what
    an attempt with the same number left behind; it is not called again once marked.
    """
    reader = spark.readStream.schema(manifest.MARK_SCHEMA)
    if max_batches:
        reader = reader.option("maxFilesPerTrigger", max_batches)
    finished = reader.parquet(f"{out}/{manifest.MANIFEST}")

    def sink(batch: DataFrame, number: int) -> None:
        marked = manifest.marks(spark, target)
        low = None
        if marked is not None:
            if not marked.filter(F.col("batch_id") == number).isEmpty():
                return
            low = marked.filter(F.col("batch_id") < number).agg(F.max("upto")).first()[0]
        low = -1 if low is None else low
        high = batch.agg(F.max("batch_id")).first()[0]
        high = low if high is None else max(low, high)
        rows = generations.rows(spark, out).filter(
            (F.col("batch_id") > low) & (F.col("batch_id") <= high)
        )
        write(rows, number)
        manifest.mark(spark, target, number, upto=high)

    trigger = {"availableNow": True} if once else {"processingTime": period}
    return (
        finished.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def finished_parts(spark: SparkSession, target: str, schema: str, part: str | None = None) -> DataFrame:
    """What marked micro-batches of a follower wrote, with ``batch_id`` its micro-batch."""
    folder = target if part is None else f"{target}/{part}"
    table = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", folder).parquet(folder)
    done = manifest.marks(spark, target)
    return table.join(done.select("batch_id"), "batch_id", "left_semi")


# Flattened rows and misfits -----------------------------------------------


def elements(
    raw: DataFrame, array_path: str, fields: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """A ``flat`` row per array element, and a ``misfit`` row per element that loses a value.

    Values that do not fit their type are NULL in the flat row; the misfit row has the
    element's text as ``payload`` and the names of those columns as ``misfit_fields``. Elements
    are taken from the payload once.
    """
    items = raw.select(F.explode(F.try_variant_get("RAW", array_path, "array<variant>")).alias("item"))

    def unfit(name: str, json_path: str) -> Column:
        value = F.try_variant_get("item", json_path, "variant")
        there = value.isNotNull() & ~F.is_variant_null(value)
        return F.when(there & F.col(name).isNull(), F.lit(name))

    typed = items.select("item", *[path("item", p, t, False).alias(n) for n, (p, t) in fields.items()])
    lost = F.array_compact(F.array(*[unfit(n, p) for n, (p, _) in fields.items()]))
    kinds = F.when(F.size("lost") > 0, F.array(F.lit(FLAT), F.lit(MISFIT))).otherwise(F.array(F.lit(FLAT)))
    each = typed.withColumn("lost", lost).withColumn("kind", F.explode(kinds))
    is_flat = F.col("kind") == FLAT
    return each.select(
        *[F.when(is_flat, F.col(n)).alias(n) for n in fields],
        F.when(~is_flat, F.to_json("item")).alias("payload"),
        F.when(~is_flat, F.col("lost")).alias("misfit_fields"),
        "kind",
    )


def _element_schema(fields: Mapping[str, tuple[str, str]]) -> str:
    typed = ", ".join(f"{n} {t}" for n, (_, t) in fields.items())
    return f"{typed}, payload string, misfit_fields array<string>, kind string"


def flatten_with_misfits(
    spark: SparkSession,
    out: str,
    target: str,
    array_path: str,
    fields: Mapping[str, tuple[str, str]],
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Follow a raw table; flat rows and misfits of a micro-batch are one read, one job, one mark."""

    def write(rows: DataFrame, number: int) -> None:
        good = rows.filter("kind = 'raw'").select("RAW")
        found = elements(good, array_path, fields)
        found.write.mode("overwrite").partitionBy("kind").parquet(f"{target}/batch_id={number}")

    return follow(spark, out, target, write, checkpoint, **options)


def read_flat(spark: SparkSession, target: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    found = finished_parts(spark, target, _element_schema(fields))
    return found.filter(F.col("kind") == FLAT).select(*fields, "batch_id")


def read_misfits(spark: SparkSession, target: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    found = finished_parts(spark, target, _element_schema(fields))
    return found.filter(F.col("kind") == MISFIT).select("payload", "misfit_fields", "batch_id")


# One more try for the quarantine --------------------------------------------

LEDGER_SCHEMA = "raw_batch bigint, digest string, attempt int, cause string, outcome string, payload string"
RECOVERED_SCHEMA = "RAW variant, raw_key string, raw_batch bigint"


def cause(payload: Column) -> Column:
    """Why a payload could not be wrapped."""
    return (
        F.when(F.trim(payload) == "", "empty")
        .when(F.try_parse_json(payload).isNull(), "no json value")
        .otherwise("more than one value")
    )


def retry_quarantine(
    spark: SparkSession,
    out: str,
    target: str,
    feed: Feed,
    checkpoint: str,
    mend: Callable[[Column], Column] | None = None,
    **options,
) -> StreamingQuery:
    """Follow a raw table; each payload in its quarantine is tried once more, then dead-lettered.

    The second attempt is at ``mend`` of the payload (without it, at the payload without
    signs that are no text). What can be wrapped now is ``recovered``; every attempt is a row
    of the ``ledger`` with its cause, and a payload that fails again is ``dead`` there. Both
    writes are of one micro-batch, and readers see neither before its mark; a repeated
    micro-batch overwrites both.
    """
    mend = mend or (lambda payload: F.regexp_replace(payload, r"^\x{FEFF}|[\x00-\x08\x0E-\x1F]", ""))

    def write(rows: DataFrame, number: int) -> None:
        lost = rows.filter("kind = 'quarantine'").select("payload", F.col("batch_id").alias("raw_batch"))
        tried = wrap_payloads(lost.withColumn("value", mend(F.col("payload"))), feed.wrap)
        tried = tried.withColumn("good", F.col("RAW").isNotNull())
        key = F.lit(None) if feed.key_path is None else F.try_variant_get("RAW", feed.key_path, "string")
        tried.filter("good").select("RAW", key.cast("string").alias("raw_key"), "raw_batch").write.mode(
            "overwrite"
        ).parquet(f"{target}/{RECOVERED}/batch_id={number}")
        second = F.when(F.col("good"), RECOVERED).otherwise("dead")
        attempts = F.array(
            F.struct(F.lit(1).alias("attempt"), cause(F.col("payload")).alias("cause"), F.lit("retried").alias("outcome")),
            F.struct(
                F.lit(2).alias("attempt"),
                F.when(~F.col("good"), cause(F.col("value"))).alias("cause"),
                second.alias("outcome"),
            ),
        )
        entries = tried.select(
            "raw_batch", F.sha2("payload", 256).alias("digest"), "payload", F.explode(attempts).alias("a")
        ).select("raw_batch", "digest", "a.*", F.when(F.col("a.outcome") == "dead", F.col("payload")).alias("payload"))
        entries.write.mode("overwrite").parquet(f"{target}/{LEDGER}/batch_id={number}")

    return follow(spark, out, target, write, checkpoint, **options)


def read_recovered(spark: SparkSession, target: str) -> DataFrame:
    """Payloads that the second attempt wrapped: RAW, raw_key, raw_batch."""
    return finished_parts(spark, target, RECOVERED_SCHEMA, RECOVERED).drop("batch_id")


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """Every attempt at a quarantined payload; the dead letters are those of outcome ``dead``."""
    return finished_parts(spark, target, LEDGER_SCHEMA, LEDGER).drop("batch_id")
