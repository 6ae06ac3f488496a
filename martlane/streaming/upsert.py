"""The latest row per key as maintained state: a batch rewrites only the buckets it hits.

Keys are hashed to a fixed number of buckets; a bucket is one folder of one version. Which
version of each bucket is current is the list of a generation, one small file written last.
A batch reads the buckets its keys fall into, merges, and writes them under its own number,
so a repeated batch starts from the same generation and overwrites its own attempt, and
readers see the table before or after a batch as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlane.operators.latest import latest_per_key
from martlane.streaming import manifest

BUCKETS = 64
STATE, VERSIONS = "state", "_versions"
VERSION_SCHEMA = "bucket int, version bigint, batch_id bigint"


def versions(spark: SparkSession, out: str, before: int | None = None) -> dict[int, int]:
    """The version of each bucket that has one, after the last batch (before one, if given)."""
    table = manifest.side_table(spark, f"{out}/{VERSIONS}", VERSION_SCHEMA)
    if table is None:
        return {}
    if before is not None:
        table = table.filter(F.col("batch_id") < before)
    newest = table.agg(F.max("batch_id")).first()[0]
    # At most one row per bucket.
    rows = table.filter(F.col("batch_id") == newest).collect() if newest is not None else []
    return {r["bucket"]: r["version"] for r in rows}


def _folders(out: str, current: dict[int, int], buckets: Sequence[int]) -> list[str]:
    return [f"{out}/{STATE}/batch_id={current[b]}/bucket={b}" for b in buckets if b in current]


def upsert(
    batch: DataFrame,
    number: int,
    out: str,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Merge a batch into the table; the order of rows is that of ``latest_per_key``."""
    spark = batch.sparkSession
    table = manifest.side_table(spark, f"{out}/{VERSIONS}", VERSION_SCHEMA)
    if table is not None and not table.filter(F.col("batch_id") >= number).isEmpty():
        return
    fields = {c: c for c in batch.columns if c not in keys}
    newest = latest_per_key(batch, keys, ts, fields, tiebreak)
    bucket = F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")
    newest = newest.withColumn("bucket", bucket).persist()
    hit = sorted(r[0] for r in newest.select("bucket").distinct().collect())
    current = versions(spark, out, number)
    merged = newest
    if folders := _folders(out, current, hit):
        schema = newest.drop("bucket").schema
        old = spark.read.schema(schema).parquet(*folders).withColumn("bucket", bucket)
        merged = latest_per_key(
            newest.unionByName(old), [*keys, "bucket"], ts, fields, tiebreak
        )
    if hit:
        # One file per bucket, unless it is too large for one task.
        merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{out}/{STATE}/batch_id={number}"
        )
    newest.unpersist()
    listed = {**current, **dict.fromkeys(hit, number)}
    rows = spark.createDataFrame(sorted(listed.items()), "bucket int, version bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/{VERSIONS}/batch_id={number}")


def upsert_sink(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    buckets: int = BUCKETS,
    once: bool = True,
    period: str = "1 minute",
) -> StreamingQuery:
    """Keep the latest row per key of a stream in the table ``out``."""

    def sink(batch: DataFrame, number: int) -> None:
        upsert(batch, number, out, keys, ts, tiebreak, buckets)

    trigger = {"availableNow": True} if once else {"processingTime": period}
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_upserted(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The table as the last batch left it; reads the current version of each bucket only."""
    current = versions(spark, out)
    folders = _folders(out, current, sorted(current))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def vacuum(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Delete bucket versions that neither the current generation nor the ``keep`` before it names."""
    table = manifest.side_table(spark, f"{out}/{VERSIONS}", VERSION_SCHEMA)
    if table is None:
        return []
    # One row per bucket and generation since the last vacuum.
    rows = table.collect()
    batches = sorted({r["batch_id"] for r in rows})
    kept = set(batches[-(keep + 1) :])
    needed = {(r["bucket"], r["version"]) for r in rows if r["batch_id"] in kept}
    had = {(r["bucket"], r["version"]) for r in rows} - needed
    gone = [f"{out}/{STATE}/batch_id={v}/bucket={b}" for b, v in sorted(had)]
    gone += [f"{out}/{VERSIONS}/batch_id={b}" for b in batches if b not in kept]
    for folder in gone:
        manifest.remove(spark, folder)
    return gone
