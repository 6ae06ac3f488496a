import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martlane.operators.flatten import flatten, path
from martlane.plans.staging import stg_meteoswiss_stations
from martlane.session import work_folder
from martlane.sources.feeds import drop_header, read_feed, read_payloads, split_quarantine, wrap_payloads
from martlane.sources.schemas import FEEDS, Feed
from martlane.streaming.catalogue import split_by_link
from martlane.streaming.ingest import (
    first_per_digest,
    flatten_stream,
    ingest,
    misfit_stream,
    read_quarantine,
    read_raw,
    run_trigger,
    stream_raw,
    write_batch,
)
from martlane.streaming.keyed import dedupe_within, latest_sink, read_latest

FEED = Feed("t", "demo", "json", "1 minute", "$.id")


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path


def land(folder, name, *lines):
    (folder / "landing" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def run(spark, folder, feed=FEED, **options):
    query = ingest(
        spark, feed, str(folder / "landing"), str(folder / "raw"), str(folder / "state"), **options
    )
    query.awaitTermination()
    return str(folder / "raw")


def test_ingest_appends_and_quarantines(spark, folder, rows):
    land(folder, "a.json", '{"id":1}', "", '{"id":', '{"id":1}')
    out = run(spark, folder)
    land(folder, "b.json", '{"id":2}', "[1,2]")
    out = run(spark, folder)
    raw = read_raw(spark, out).select(F.to_json("RAW").alias("j"), "batch_id")
    assert rows(raw) == [('[1,2]', 1), ('{"id":1}', 0), ('{"id":1}', 0), ('{"id":2}', 1)]
    assert rows(read_quarantine(spark, out)) == [('{"id":', 0)]


def test_ingest_keeps_changed_payloads_and_drops_repeated_ones(spark, folder, rows):
    land(folder, "a.json", '{"id":1,"v":"b"}', '{"id":1,"v":"b"}', '{"v":"no id"}', "broken{")
    run(spark, folder, dedupe=True)
    land(folder, "b.json", '{"id":1,"v":"b"}', '{"id":1,"v":"a"}', '{"id":2,"v":"c"}', '{"v":"no id"}')
    out = run(spark, folder, dedupe=True)
    kept = read_raw(spark, out).select("raw_key", path("RAW", "$.v", "string").alias("v"))
    assert rows(kept) == [(None, "no id"), ("1", "a"), ("1", "b"), ("2", "c")]
    assert rows(read_quarantine(spark, out), "payload") == [("broken{",)]


def test_looking_back_a_few_batches_only(spark, folder):
    out = str(folder / "raw")
    batch = spark.createDataFrame([('{"id":1}',)], "value string")
    for n in range(4):
        write_batch(batch if n in (0, 3) else batch.limit(0), n, FEED, out, True, look_back=2)
    assert read_raw(spark, out).count() == 2


@pytest.mark.parametrize("markers", ["true", "false"])
def test_a_repeated_batch_doubles_nothing(spark, folder, markers):
    out = str(folder / "raw")
    batch = spark.createDataFrame([('{"id":1}',), ('{"id":2}',)], "value string")
    marking = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark._jsc.hadoopConfiguration().set(marking, markers)
    try:
        write_batch(batch, 0, FEED, out, dedupe=True)
        finished = {f.name for f in (folder / "raw").rglob("*.parquet")}
        write_batch(batch, 0, FEED, out, dedupe=True)
        assert {f.name for f in (folder / "raw").rglob("*.parquet")} == finished
        shutil.rmtree(folder / "raw" / "_manifest")
        for _ in range(2):
            write_batch(batch, 0, FEED, out, dedupe=True)
        for _ in range(2):
            write_batch(batch.union(spark.createDataFrame([('{"id":3}',)])), 1, FEED, out, dedupe=True)
    finally:
        spark._jsc.hadoopConfiguration().set(marking, "true")
    assert sorted(r.raw_key for r in read_raw(spark, out).collect()) == ["1", "2", "3"]


def test_many_small_batches_give_the_same_table(spark, folder, rows):
    for i in range(5):
        land(folder, f"{i}.json", f'{{"id":{i}}}', f'{{"id":{i + 1}}}')
    out = run(spark, folder, dedupe=True, max_files=1)
    raw = read_raw(spark, out)
    assert sorted(r.raw_key for r in raw.collect()) == ["0", "1", "2", "3", "4", "5"]
    assert len(list((folder / "raw").glob("batch_id=*"))) == 5


def test_copies_are_reduced_before_the_shuffle(spark):
    batch = spark.range(1000).selectExpr("'k' AS digest", "'v' AS value")
    plan = first_per_digest(batch)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert first_per_digest(batch).collect() == [("k", "v")]


@pytest.mark.parametrize(
    "text",
    [
        '{"a":1}{"b":2}', '{"a":1} trash', ' "connections": [', '{"a":1}],[2', '{"a":1}}', "1,2",
        '1,"x":2', '1,"z":1', '1,"v":2', "", "{", '{"a":1},"z":1} ',
    ],
)
def test_what_follows_the_first_value_is_not_lost(spark, text):
    good, bad = split_quarantine(wrap_payloads(spark.createDataFrame([(text,)], "value string"), "json"))
    assert good.count() == 0
    assert bad.collect() == [(text,)]


@pytest.mark.parametrize("text", ['{"a":[1,{"z":2}]}', " [1,2] ", "5", '"s"', "true", '{"v":1,"z":0}'])
def test_whole_values_are_kept(spark, text):
    good, bad = split_quarantine(wrap_payloads(spark.createDataFrame([(text,)], "value string"), "json"))
    assert json.loads(good.select(F.to_json("RAW")).first()[0]) == json.loads(text)
    assert bad.count() == 0


def test_a_body_over_several_lines_is_one_payload(spark, folder):
    body = json.dumps({"features": [{"id": "a"}, {"id": "b"}]}, indent=2)
    (folder / "landing" / "x.json").write_text(body, encoding="utf-8")
    (folder / "landing" / "y.json").write_text(body[:-3], encoding="utf-8")
    out = run(spark, folder, "meteoswiss_measurements", dedupe=True)
    raw = read_raw(spark, out).select("raw_key", F.to_json("RAW").alias("j")).collect()
    assert [(r.raw_key, json.loads(r.j)) for r in raw] == [("a", json.loads(body))]
    assert [r.payload for r in read_quarantine(spark, out).collect()] == [body[:-3]]


def test_text_and_line_wraps(spark, folder, rows):
    land(folder, "a.csv", "D;X", " 1;2 ", "", "\t", "D;X", "3;4")
    text = wrap_payloads(read_payloads(spark, str(folder / "landing"), "text"), "text")
    body = text.select(F.variant_get("RAW", "$", "string")).first()[0]
    assert body == "D;X\n 1;2 \n\n\t\nD;X\n3;4\n"
    lines = read_payloads(spark, str(folder / "landing"), "lines")
    good, bad = split_quarantine(wrap_payloads(drop_header(lines, "D;X"), "lines"))
    assert rows(good.select(F.variant_get("RAW", "$", "string"))) == [("1;2",), ("3;4",)]
    assert bad.count() == 0


def test_text_keeps_its_quotes_and_backslashes(spark, folder):
    body = 'a "quoted" \\ line\nsecond\n'
    (folder / "landing" / "x.csv").write_text(body, encoding="utf-8")
    raw, _ = read_feed(spark, str(folder / "landing"), "ecb_exchange_rates")
    assert json.loads(raw.select(F.to_json("RAW")).first()[0]) == body


def test_unknown_wrap_is_refused(spark):
    with pytest.raises(ValueError):
        read_payloads(spark, "/nowhere", "xml")


def test_triggers_follow_the_feed():
    assert run_trigger(FEEDS["meteoswiss_measurements"], once=False) == {"processingTime": "10 minutes"}
    assert run_trigger(FEED, once=True) == {"availableNow": True}
    assert len(FEEDS) == 8


def _item(station, hour):
    return (
        f'{{"id":"{station}","properties":{{"title":"T","datetime":"2026-01-05T{hour:02}:00:00"}},'
        f'"geometry":{{"coordinates":[7.4,46.9]}},"assets":{{"a":1}}}}'
    )


def test_stream_flatten_equals_batch(spark, folder, rows):
    for n in range(3):
        land(folder, f"{n}.json", f'{{"features":[{_item("a", n)},', f'{_item("b", n)}]}}')
        land(folder, f"{n}-none.json", '{"features":[]}')
        out = run(spark, folder, feed=FEEDS["meteoswiss_measurements"])
        query = flatten_stream(
            stream_raw(spark, out), stg_meteoswiss_stations, str(folder / "flat"), str(folder / "fs")
        )
        query.awaitTermination()
    batch = stg_meteoswiss_stations(read_raw(spark, out))
    assert rows(spark.read.parquet(str(folder / "flat"))) == rows(batch)
    assert batch.count() == 6


def test_values_that_do_not_fit_go_to_the_quarantine(spark, folder, rows):
    fields = {"n": ("$.n", "int"), "t": ("$.t", "timestamp_ntz"), "s": ("$.s", "string")}
    items = [{"n": 1, "t": "2026-01-05T00:00:00", "s": "a"}, {"n": "x", "t": "never"}, {"n": None}, {}]
    land(folder, "a.json", json.dumps({"items": items}), '{"items":5}', '{"other":1}')
    raw = stream_raw(spark, run(spark, folder))
    lenient = lambda df: flatten(df, "$.items", fields, strict=False)
    for stream in (
        flatten_stream(raw, lenient, str(folder / "flat"), str(folder / "fs")),
        misfit_stream(raw, "$.items", fields, str(folder / "bad"), str(folder / "bs")),
    ):
        stream.awaitTermination()
    assert spark.read.parquet(str(folder / "flat")).count() == 4
    (bad,) = spark.read.parquet(str(folder / "bad")).collect()
    assert (json.loads(bad.payload), bad.fields) == (items[1], ["n", "t"])


def test_latest_over_batches(spark, folder, rows):
    land(folder, "0.json", _item("a", 3), _item("a", 5), _item("b", 1))
    land(folder, "1.json", _item("a", 4), _item("b", 2), _item("c", 0))
    lines = read_payloads(spark, str(folder / "landing"), "json", stream=True, maxFilesPerTrigger=1)
    items = lines.select(F.parse_json("value").alias("RAW")).select(
        path("RAW", "$.id", "string").alias("id"),
        path("RAW", "$.properties.datetime", "timestamp_ntz").alias("at"),
    )
    args = (["id"], "at")
    latest_sink(items, *args, [], str(folder / "out"), str(folder / "s")).awaitTermination()
    out = read_latest(spark, str(folder / "out"), *args)
    hours = {r.id: r["at"].hour for r in out.collect()}
    assert hours == {"a": 5, "b": 2, "c": 0}


def test_watermark_dedupe(spark, folder):
    same = [f'{{"id":{i},"t":"2026-01-05T10:0{i}:00"}}' for i in (1, 1, 2, 2, 3)]
    land(folder, "a.json", *same)
    lines = read_payloads(spark, str(folder / "landing"), "json", stream=True)
    parsed = lines.select(F.parse_json("value").alias("RAW"))
    events = parsed.select(
        path("RAW", "$.id", "int").alias("id"), path("RAW", "$.t", "timestamp_ntz").alias("t")
    )
    query = (
        dedupe_within(events, ["id"], "t", "10 minutes")
        .writeStream.format("parquet")
        .option("path", str(folder / "out"))
        .option("checkpointLocation", str(folder / "s"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.parquet(str(folder / "out")).collect()
    assert sorted(r.id for r in found) == [1, 2, 3]
    assert min(r.t for r in found) == datetime(2026, 1, 5, 10, 1)


def test_catalogue_links(spark, rows):
    base = "https://data.opentransportdata.swiss/dataset/x/download"
    pages = [
        (1, f'<a href="{base}/2026-01-01_istdaten.csv"><a href="{base}/2026-01-02_istdaten.csv">'),
        (2, '<a href="https://example.com/a_istdaten.csv">'),
    ]
    found, lost = split_by_link(spark.createDataFrame(pages, "id int, html string"), "html")
    assert rows(found, "id", "file_name") == [(1, "2026-01-01_istdaten.csv")]
    assert rows(lost, "id") == [(2,)]


def test_work_folders_are_new_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")
