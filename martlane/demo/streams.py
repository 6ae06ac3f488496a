"""Ingest and streaming jobs on the driver's tables.

Payload files are landed in a new work folder by Spark, the stream runs until
all of them are read, and the table it wrote is read back.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.demo.standins import Standins
from martlane.operators.flatten import path
from martlane.plans.staging import (
    stg_meteoswiss_stations,
    stg_sbb_stationboard,
    stg_transport_connections,
)
from martlane.session import work_folder
from martlane.sources.feeds import drop_header, read_payloads
from martlane.sources.schemas import FEEDS, Feed
from martlane.streaming.ingest import (
    flatten_stream,
    ingest,
    read_quarantine,
    read_raw,
    stream_raw,
)
from martlane.streaming import follow, generations
from martlane.streaming.keyed import dedupe_within, latest_sink, read_latest
from martlane.streaming.upsert import read_upserted, upsert_sink

EVENTS_FEED = Feed("events", "demo", "json", "1 minute", "$.user_id")
EVENT_FIELDS = {
    "event_id": ("$.event_id", "bigint"),
    "user_id": ("$.user_id", "bigint"),
    "event_type": ("$.event_type", "string"),
    "ts": ("$.ts", "timestamp_ntz"),
    "value": ("$.value", "double"),
}
PAGE_LINK = 'href="(/th[^"]+)"'
HEADER = "role;text"
BODY_EVENTS = 1000  # events of a body of many payloads at most; a multiple of a payload's four


def _event_payloads(d: Standins) -> DataFrame:
    """One JSON object per event, beginning with a sortable number."""
    return d.source("events").selectExpr(
        "to_json(named_struct('seq', lpad(event_id, 12, '0'), 'event_id', event_id,"
        " 'user_id', user_id, 'event_type', event_type, 'ts', CAST(ts AS STRING),"
        " 'value', value)) AS value"
    )


def _typed(raw: DataFrame) -> DataFrame:
    return raw.select(*[path("RAW", p, t).alias(name) for name, (p, t) in EVENT_FIELDS.items()])


def _landed(d: Standins, payloads: DataFrame, purpose: str) -> str:
    folder = work_folder(d.spark, purpose)
    payloads.select("value").write.text(f"{folder}/landing")
    return folder


def _ingested(d: Standins, folder: str, feed: Feed = EVENTS_FEED, **options) -> str:
    """The raw table of all that has landed in the folder."""
    query = ingest(d.spark, feed, f"{folder}/landing", f"{folder}/raw", f"{folder}/state", **options)
    query.awaitTermination()
    return f"{folder}/raw"


def raw_append(d: Standins) -> DataFrame:
    return _typed(read_raw(d.spark, _ingested(d, _landed(d, _event_payloads(d), "raw-append"))))


def dedupe_by_key(d: Standins) -> DataFrame:
    """Payloads of few kinds over several micro-batches; each kind is kept once, whatever its key."""
    payloads = d.source("events").selectExpr(
        "to_json(named_struct('user_id', user_id, 'event_type', event_type)) AS value"
    )
    folder = _landed(d, payloads.repartition(4), "dedupe")
    raw = read_raw(d.spark, _ingested(d, folder, dedupe=True, max_files=1))
    return raw.select("raw_key", path("RAW", "$.event_type", "string").alias("event_type"))


def _polled_twice(d: Standins, name: str, payloads: DataFrame, flattener) -> DataFrame:
    """A shipped feed whose payloads land twice, in files read one at a time, flattened."""
    landing = payloads.unionAll(payloads).select("value").repartition(4)
    feed = replace(FEEDS[name], wrap="json")
    folder = _landed(d, landing, "polled")
    return flattener(read_raw(d.spark, _ingested(d, folder, feed, dedupe=True, max_files=1)))


def connections_polled_twice(d: Standins) -> DataFrame:
    payloads = d.connection_payloads()
    return _polled_twice(d, "transport_connections", payloads, stg_transport_connections)


def stationboard_polled_twice(d: Standins) -> DataFrame:
    return _polled_twice(d, "sbb_stationboard", d.stationboard_payloads(), stg_sbb_stationboard)


def stations_polled_twice(d: Standins) -> DataFrame:
    payloads = d.station_payloads().distinct()
    return _polled_twice(d, "meteoswiss_measurements", payloads, stg_meteoswiss_stations)


def lines_polled_twice(d: Standins) -> DataFrame:
    """Lines of a feed without keys, landed twice in files read one at a time: each is kept once."""
    lines = d.source("conversations").select(F.col("text").alias("value"))
    folder = _landed(d, lines.unionAll(lines).repartition(3), "polled-lines")
    raw = read_raw(d.spark, _ingested(d, folder, FEEDS["sbb_ist_daten"], dedupe=True, max_files=1))
    return raw.select(path("RAW", "$", "string").alias("line"))


def _bodies(items: DataFrame) -> DataFrame:
    """Stationboard payloads joined to pretty-printed bodies of up to BODY_EVENTS events each."""
    inner = F.regexp_extract("value", r"^\{\"results\":\[(.*)\]\}$", 1)
    body = F.concat(
        F.lit('{\n  "results": [\n    '), F.array_join(F.collect_list(inner), ",\n    "), F.lit("\n  ]\n}")
    )
    first_event = F.regexp_extract("value", r'"fahrt_bezeichner":"J(-?\d+)"', 1).try_cast("long")
    # Payloads without a number are dealt to bodies by their hash.
    group = F.coalesce(F.floor(first_event / BODY_EVENTS), F.xxhash64("value"))
    return items.groupBy(group).agg(body.alias("value")).select("value")


def multiline_payloads(d: Standins) -> DataFrame:
    """All good payloads, those of BODY_EVENTS numbers as one pretty-printed body per file."""
    items = d.stationboard_payloads().filter("value LIKE '{\"results\":[{%'")
    folder = work_folder(d.spark, "bodies")
    # One row per file, written by as many tasks as there are.
    _bodies(items).write.option("maxRecordsPerFile", 1).text(f"{folder}/landing")
    return stg_sbb_stationboard(read_raw(d.spark, _ingested(d, folder, FEEDS["sbb_stationboard"])))


def dedupe_watermark(d: Standins) -> DataFrame:
    """Every event lands twice and is kept once."""
    payloads = _event_payloads(d)
    folder = _landed(d, payloads.unionByName(payloads), "watermark")
    lines = read_payloads(d.spark, f"{folder}/landing", "json", stream=True)
    events = _typed(lines.select(F.parse_json("value").alias("RAW")))
    query = (
        dedupe_within(events, ["event_id"], "ts", "1 hour")
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kept = d.spark.read.parquet(f"{folder}/out")
    return kept.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


def flattened(d: Standins) -> DataFrame:
    folder = _landed(d, d.stationboard_payloads(), "flatten")
    raw = stream_raw(d.spark, _ingested(d, folder))
    query = flatten_stream(raw, stg_sbb_stationboard, f"{folder}/flat", f"{folder}/flat-state")
    query.awaitTermination()
    return d.spark.read.parquet(f"{folder}/flat")


def latest_per_user(d: Standins) -> DataFrame:
    folder = _landed(d, _event_payloads(d), "latest")
    lines = read_payloads(d.spark, f"{folder}/landing", "json", stream=True)
    events = _typed(lines.select(F.parse_json("value").alias("RAW")))
    query = latest_sink(
        events,
        ["user_id"],
        "ts",
        ["value"],
        f"{folder}/latest",
        f"{folder}/state",
        tiebreak=["event_id"],
    )
    query.awaitTermination()
    latest = read_latest(d.spark, f"{folder}/latest", ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "ts", "event_id", "value")


def quarantine(d: Standins) -> DataFrame:
    """Some events land as broken JSON, as two values in a row or with a tail; all of that must be
    found in the quarantine, text for text."""
    payloads = d.source("events").selectExpr(
        "CASE event_type WHEN 'error' THEN '{\"k\":' WHEN 'view' THEN concat(props, props)"
        " WHEN 'signup' THEN concat(props, ' tail') ELSE props END AS value"
    )
    raw = _ingested(d, _landed(d, payloads, "quarantine"))
    good = read_raw(d.spark, raw).select(F.lit("raw").alias("kind"), F.to_json("RAW").alias("value"))
    bad = read_quarantine(d.spark, raw).select(
        F.lit("quarantine").alias("kind"), F.col("payload").alias("value")
    )
    return good.unionByName(bad).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def text_lines(d: Standins) -> DataFrame:
    """Texts land under a repeated header line; blank lines and headers go."""
    batches = d.source("conversations").select(F.concat(F.lit(f"{HEADER}\n"), "text").alias("value"))
    folder = _landed(d, batches, "lines")
    lines = drop_header(read_payloads(d.spark, f"{folder}/landing", "lines"), HEADER)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def _landed_in(d: Standins, payloads: DataFrame, purpose: str, files: int, rounds: int):
    """Payloads dealt to rounds by their hash; yields the folder once each round has landed."""
    folder = work_folder(d.spark, purpose)
    dealt = payloads.withColumn("round", F.pmod(F.xxhash64("value"), F.lit(rounds)))
    for n in range(rounds):
        own = dealt.filter(F.col("round") == n).select("value")
        own.repartition(files).write.mode("append").text(f"{folder}/landing")
        yield folder


def raw_compacted(d: Standins) -> DataFrame:
    """Micro-batches of one file each; batches are merged, and their folders dropped, in between."""
    for folder in _landed_in(d, _event_payloads(d), "compacted", files=3, rounds=3):
        raw = _ingested(d, folder, max_files=1)
        generations.compact(d.spark, raw, fan=2)
        generations.vacuum(d.spark, raw, keep=0)
    return _typed(read_raw(d.spark, raw))


def dedupe_over_compactions(d: Standins) -> DataFrame:
    """Every payload lands in three rounds; the index finds it in segments and in single batches."""
    payloads = d.source("events").selectExpr(
        "to_json(named_struct('user_id', user_id, 'event_type', event_type, 'hour', hour(ts))) AS value"
    )
    folder = work_folder(d.spark, "dedupe-compacted")
    # Two micro-batches a round, each of a file per core, so that no task lands half a round.
    files = d.spark.sparkContext.defaultParallelism
    for n in range(3):
        dealt = payloads.repartition(2 * files, F.xxhash64("value", F.lit(n)))
        dealt.write.mode("append").text(f"{folder}/landing")
        raw = _ingested(d, folder, dedupe=True, max_files=files)
        if n < 2:
            generations.compact(d.spark, raw)
    kept = read_raw(d.spark, raw)
    return kept.select(
        "raw_key",
        path("RAW", "$.event_type", "string").alias("event_type"),
        path("RAW", "$.hour", "int").alias("hour"),
    )


MISFIT_FIELDS = {"event_id": ("$.event_id", "bigint"), "value": ("$.value", "double")}


def flatten_misfits(d: Standins) -> DataFrame:
    """Flat rows and misfits of one read; the value of an error event is a text that is no number."""
    payloads = d.source("events").selectExpr(
        "to_json(named_struct('items', array(if(event_type = 'error',"
        " to_variant_object(named_struct('event_id', event_id, 'value', 'none')),"
        " to_variant_object(named_struct('event_id', event_id, 'value', value)))))) AS value"
    )
    for folder in _landed_in(d, payloads, "misfits", files=2, rounds=2):
        raw = _ingested(d, folder, max_files=1)
        flat = f"{folder}/flat"
        query = follow.flatten_with_misfits(
            d.spark, raw, flat, "$.items", MISFIT_FIELDS, f"{folder}/flat-state", max_batches=1
        )
        query.awaitTermination()
        generations.compact(d.spark, raw)
    good = follow.read_flat(d.spark, flat, MISFIT_FIELDS).select(
        F.lit("flat").alias("kind"), "event_id", "value", F.lit(None).cast("string").alias("payload")
    )
    bad = follow.read_misfits(d.spark, flat, MISFIT_FIELDS).select(
        F.concat_ws(",", "misfit_fields").alias("kind"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.lit(None).cast("double").alias("value"),
        "payload",
    )
    return good.unionByName(bad)


def quarantine_retry(d: Standins) -> DataFrame:
    """Payloads with a tail are mended by the second attempt; broken and doubled ones end as dead letters."""
    payloads = d.source("events").selectExpr(
        "CASE event_type WHEN 'error' THEN '{\"k\":' WHEN 'view' THEN concat(props, props)"
        " WHEN 'signup' THEN concat(props, ' tail') ELSE props END AS value"
    )
    for folder in _landed_in(d, payloads, "retry", files=2, rounds=2):
        raw = _ingested(d, folder, max_files=1)
        query = follow.retry_quarantine(
            d.spark,
            raw,
            f"{folder}/retry",
            EVENTS_FEED,
            f"{folder}/retry-state",
            mend=lambda payload: F.regexp_replace(payload, " tail$", ""),
        )
        query.awaitTermination()
    tried = follow.read_ledger(d.spark, f"{folder}/retry").select("attempt", "cause", "outcome", "payload")
    saved = follow.read_recovered(d.spark, f"{folder}/retry").select(
        F.lit(0).alias("attempt"),
        F.lit(None).cast("string").alias("cause"),
        F.lit("raw").alias("outcome"),
        F.to_json("RAW").alias("payload"),
    )
    both = tried.unionByName(saved)
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("n"))


def upserted_latest(d: Standins) -> DataFrame:
    """The latest event per user as maintained state, updated by five micro-batches."""
    folder = work_folder(d.spark, "upsert")
    _event_payloads(d).select("value").repartition(5).write.text(f"{folder}/landing")
    lines = read_payloads(d.spark, f"{folder}/landing", "json", stream=True, maxFilesPerTrigger=1)
    events = _typed(lines.select(F.parse_json("value").alias("RAW")))
    events = events.select("user_id", "ts", "event_id", "value")
    query = upsert_sink(
        events, ["user_id"], "ts", f"{folder}/latest", f"{folder}/state", tiebreak=["event_id"], buckets=16
    )
    query.awaitTermination()
    schema = "user_id bigint, ts timestamp_ntz, event_id bigint, value double"
    return read_upserted(d.spark, f"{folder}/latest", schema)


LINES_OF_BODY = 1000  # lines or entries of a landed body at most


def _text_bodies(d: Standins, feed: str, source: str, header: str, key: str, value: str) -> DataFrame:
    """Lines under a header, in files of up to LINES_OF_BODY, ingested whole; the lines again."""
    rows = d.source(source).selectExpr(f"concat_ws(';', {key}, {value}) AS line", f"{key} AS id")
    bodies = rows.groupBy(F.floor(F.col("id") / LINES_OF_BODY)).agg(F.collect_list("line").alias("lines"))
    text = F.concat(F.lit(f"{header}\n"), F.array_join("lines", "\n"), F.lit("\n"))
    folder = work_folder(d.spark, "text-bodies")
    bodies.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/landing")
    raw = read_raw(d.spark, _ingested(d, folder, FEEDS[feed]))
    each = F.split(path("RAW", "$", "string"), "\n")
    lines = drop_header(raw.select(F.explode(each).alias("value")), header).filter("value <> ''")
    return lines.select(F.col("value").alias("line"))


def exchange_rates(d: Standins) -> DataFrame:
    return _text_bodies(d, "ecb_exchange_rates", "orders", "order;status", "o_orderkey", "o_orderstatus")


def foreign_trade(d: Standins) -> DataFrame:
    return _text_bodies(d, "bazg_foreign_trade", "part", "part;name", "p_partkey", "p_name")


def _directory(d: Standins, feed: str, source: str, group: str, entry: str) -> DataFrame:
    """Entries in pretty-printed bodies with an id of their own, each body landed twice and kept once."""
    rows = d.source(source).selectExpr(f"CAST({group} AS STRING) AS id", f"{entry} AS entry")
    joined = F.array_join(F.sort_array(F.collect_list("entry")), ",\n    ")
    body = F.concat(F.lit('{\n  "id": "'), "id", F.lit('",\n  "entries": [\n    '), joined, F.lit("\n  ]\n}"))
    bodies = rows.groupBy("id").agg(body.alias("value")).select("value")
    folder = work_folder(d.spark, "directory")
    for _ in range(2):
        bodies.write.mode("append").option("maxRecordsPerFile", 1).text(f"{folder}/landing")
    raw = read_raw(d.spark, _ingested(d, folder, FEEDS[feed], dedupe=True))
    entries = raw.select(
        "raw_key", F.explode(F.variant_get("RAW", "$.entries", "array<variant>")).alias("e")
    )
    return entries.select(
        "raw_key", path("e", "$.key", "bigint").alias("key"), path("e", "$.name", "string").alias("name")
    )


def traffic_counts(d: Standins) -> DataFrame:
    entry = "to_json(named_struct('key', s_suppkey, 'name', s_name))"
    return _directory(d, "astra_traffic_counts", "supplier", "s_nationkey", entry)


def postcodes(d: Standins) -> DataFrame:
    entry = "to_json(named_struct('key', c_custkey, 'name', c_name))"
    return _directory(d, "swiss_plz_directory", "customer", "floor(c_custkey / 1000)", entry)
