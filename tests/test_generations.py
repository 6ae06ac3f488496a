"""Compaction, the membership index, followers with several sinks, retries and maintained state."""

import json
import random

import pytest
from pyspark.sql import functions as F

from martlane.sources.schemas import Feed
from martlane.streaming import digests, follow, generations, manifest, upsert
from martlane.streaming.digests import Run
from martlane.streaming.ingest import read_quarantine, read_raw, write_batch

FEED = Feed("t", "demo", "json", "1 minute", "$.id")


def put(spark, out, number, values, dedupe=True, **options):
    batch = spark.createDataFrame([(v,) for v in values], "value string")
    write_batch(batch, number, FEED, out, dedupe, **options)


def payload(i):
    return f'{{"id":{i}}}'


def keys(spark, out):
    return sorted(int(r.raw_key) for r in read_raw(spark, out).collect())


# Generations ------------------------------------------------------------------


def test_readers_see_the_same_rows_through_compactions(spark, tmp_path):
    out = str(tmp_path / "raw")
    wanted = []
    for n in range(9):
        put(spark, out, n, [payload(10 * n), payload(10 * n + 1), f"bad {n}", payload(0)])
        wanted = sorted({*wanted, 0, 10 * n, 10 * n + 1})
        if n % 2:
            before = read_raw(spark, out)
            generations.compact(spark, out, fan=2)
            # A reader that has begun goes on with the old files; a new one has the new files.
            assert sorted(int(r.raw_key) for r in before.collect()) == wanted
        assert keys(spark, out) == wanted
        assert read_quarantine(spark, out).count() == n + 1
    now = generations.current(spark, out)
    assert now.cutoff == 7 and [(s.first_batch, s.last_batch, s.tier) for s in now.segments] == [(0, 7, 2)]
    assert now.segments[0].digests == len(wanted) - 2 + 8


def test_vacuum_drops_what_no_kept_generation_reads(spark, tmp_path):
    out = str(tmp_path / "raw")
    for n in range(6):
        put(spark, out, n, [payload(n)])
        generations.compact(spark, out, fan=3)
        if n == 4:
            kept = read_raw(spark, out)
    gone = generations.vacuum(spark, out, keep=1)
    assert f"{out}/batch_id=0" in gone and f"{out}/batch_id=5" not in gone
    assert not (tmp_path / "raw" / "batch_id=0").exists()
    assert sorted(int(r.raw_key) for r in kept.collect()) == list(range(5))
    assert keys(spark, out) == list(range(6))
    # A batch that is repeated long after, and payloads that come again, add nothing.
    put(spark, out, 0, [payload(0)])
    put(spark, out, 6, [payload(i) for i in range(7)])
    assert keys(spark, out) == list(range(7))


def test_a_compaction_that_failed_is_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "raw")
    put(spark, out, 0, [payload(0)])
    put(spark, out, 1, [payload(1)])
    with monkeypatch.context() as m:
        m.setattr(generations.digests, "merge", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            generations.compact(spark, out)
    assert generations.current(spark, out).cutoff == -1 and keys(spark, out) == [0, 1]
    generations.compact(spark, out)
    assert generations.current(spark, out).cutoff == 1 and keys(spark, out) == [0, 1]
    assert generations.compact(spark, out) == generations.current(spark, out)


# The membership index ---------------------------------------------------------


def test_index_finds_every_digest_and_few_others(spark, tmp_path):
    def frame(low, high):
        return spark.range(low, high).select(
            F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(low).cast("bigint").alias("batch_id")
        )

    sizes = [(0, 20000), (20000, 20100), (20100, 60000)]
    made = []
    for n, (low, high) in enumerate(sizes):
        digests.write(frame(low, high), str(tmp_path / f"run{n}"), high - low)
        made.append(Run(str(tmp_path / f"run{n}"), high - low, low))
    asked = frame(59000, 64000)
    found = digests.suspects(asked, made)
    assert found.filter("at = 2").select("digest").distinct().count() >= 1000
    assert found.count() < 1000 + 0.01 * 5000 * 3
    assert digests.known(asked, made).count() == 1000
    assert digests.known(asked, made, since=30000) is None
    assert digests.known(frame(70000, 70001), []) is None


def test_a_run_has_few_files_whatever_the_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "SLOT_DIGESTS", 500)
    found = spark.range(0, 4000, 1, 32).select(
        F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(0).cast("bigint").alias("batch_id")
    )
    digests.write(found, str(tmp_path / "run"), 4000)
    slots = Run("", 4000, 0).slots
    assert len(list(tmp_path.glob("run/slot=*"))) == slots + 1
    assert len(list(tmp_path.glob("run/slot=*/*.parquet"))) <= 2 * (slots + 1)
    assert digests.known(found, [Run(str(tmp_path / "run"), 4000, 0)]).count() == 4000


def test_only_slots_of_repeated_payloads_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "SLOT_DIGESTS", 50)
    read = []
    rows = digests._rows

    def seen(spark, folder, slots=None):
        found = rows(spark, folder, slots)
        if slots != [digests.BITMAPS]:
            read.append(found.count())
        return found

    out = str(tmp_path / "raw")
    for n in range(6):
        put(spark, out, n, [payload(1000 * n + i) for i in range(400)])
    monkeypatch.setattr(digests, "_rows", seen)
    put(spark, out, 6, [payload(90_000 + i) for i in range(400)])
    assert sum(read) < 0.1 * 2400
    put(spark, out, 7, [payload(3), payload(99_999)])
    assert sum(read) < 0.2 * 2800
    assert len(keys(spark, out)) == 7 * 400 + 1


# Followers ----------------------------------------------------------------------

FIELDS = {"n": ("$.n", "int"), "s": ("$.s", "string")}


def items(*values):
    return json.dumps({"id": 1, "items": [{"n": v, "s": str(v)} for v in values]})


def run_follower(spark, tmp_path, name="flat", **options):
    out, target = str(tmp_path / "raw"), str(tmp_path / name)
    follow.flatten_with_misfits(
        spark, out, target, "$.items", FIELDS, str(tmp_path / f"{name}-state"), **options
    ).awaitTermination()
    return target


def flat_and_misfits(spark, target):
    flat = sorted(r.s for r in follow.read_flat(spark, target, FIELDS).collect())
    bad = sorted((json.loads(r.payload)["n"], *r.misfit_fields) for r in follow.read_misfits(spark, target, FIELDS).collect())
    return flat, bad


def test_one_read_with_two_sinks_goes_on_through_compactions(spark, tmp_path):
    out = str(tmp_path / "raw")
    put(spark, out, 0, [items(1, "x"), "bad"], dedupe=False)
    put(spark, out, 1, [items(2)], dedupe=False)
    target = run_follower(spark, tmp_path, max_batches=1)
    assert flat_and_misfits(spark, target) == (["1", "2", "x"], [("x", "n")])
    for n in range(2, 5):
        put(spark, out, n, [items(n + 1, f"y{n}")], dedupe=False)
        generations.compact(spark, out, fan=2)
    generations.vacuum(spark, out, keep=0)
    assert not (tmp_path / "raw" / "batch_id=2").exists()
    wanted = ["1", "2", "3", "4", "5", "x", "y2", "y3", "y4"], [("x", "n"), *[(f"y{n}", "n") for n in (2, 3, 4)]]
    run_follower(spark, tmp_path)
    assert flat_and_misfits(spark, target) == wanted
    # One that starts now has all rows as well.
    assert flat_and_misfits(spark, run_follower(spark, tmp_path, "late")) == wanted


def test_a_repeated_micro_batch_doubles_neither_sink(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "raw")
    put(spark, out, 0, [items(1, "x")], dedupe=False)
    with monkeypatch.context() as m:
        m.setattr(follow.manifest, "mark", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            run_follower(spark, tmp_path)
    target = str(tmp_path / "flat")
    put(spark, out, 1, [items(2)], dedupe=False)
    run_follower(spark, tmp_path)
    assert flat_and_misfits(spark, target) == (["1", "2", "x"], [("x", "n")])


def test_one_scan_per_micro_batch(spark, tmp_path):
    out = str(tmp_path / "raw")
    put(spark, out, 0, [items(1, "x")], dedupe=False)
    raw = generations.rows(spark, out).filter("kind = 'raw'").select("RAW")
    plan = follow.elements(raw, "$.items", FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# Retries ------------------------------------------------------------------------


def run_retry(spark, tmp_path, mend=None):
    out, target = str(tmp_path / "raw"), str(tmp_path / "retry")
    follow.retry_quarantine(spark, out, target, FEED, str(tmp_path / "retry-state"), mend).awaitTermination()
    return target


def ledger(spark, target):
    rows = follow.read_ledger(spark, target).collect()
    return sorted((r.raw_batch, r.attempt, r.cause or "", r.outcome, r.payload or "") for r in rows)


def test_quarantine_is_tried_once_more(spark, tmp_path):
    out = str(tmp_path / "raw")
    put(spark, out, 0, [payload(1), payload(2) + ";", "{", payload(3) + payload(4)], dedupe=False)
    mend = lambda text: F.regexp_replace(text, ";$", "")
    target = run_retry(spark, tmp_path, mend)
    assert [r.raw_key for r in follow.read_recovered(spark, target).collect()] == ["2"]
    two = payload(3) + payload(4)
    first = [
        (0, 1, "more than one value", "retried", ""),
        (0, 1, "more than one value", "retried", ""),
        (0, 1, "no json value", "retried", ""),
        (0, 2, "", "recovered", ""),
        (0, 2, "more than one value", "dead", two),
        (0, 2, "no json value", "dead", "{"),
    ]
    assert ledger(spark, target) == first
    # Nothing is tried a third time.
    put(spark, out, 1, ["\x00" + payload(5), ""], dedupe=False)
    run_retry(spark, tmp_path)
    assert ledger(spark, target)[: len(first)] == first
    assert sorted(r.raw_key for r in follow.read_recovered(spark, target).collect()) == ["2", "5"]


def test_a_failure_between_the_two_writes(spark, tmp_path, monkeypatch):
    out, target = str(tmp_path / "raw"), str(tmp_path / "retry")
    put(spark, out, 0, ["\x00" + payload(1), "{"], dedupe=False)
    with monkeypatch.context() as m:
        m.setattr(follow, "LEDGER", "no/such:scheme://" + "\x00")
        with pytest.raises(Exception):
            run_retry(spark, tmp_path)
    # What the first write left is not seen; the attempt that is repeated overwrites it.
    assert (tmp_path / "retry" / "recovered" / "batch_id=0").exists()
    assert manifest.marks(spark, target) is None
    run_retry(spark, tmp_path)
    assert [r.raw_key for r in follow.read_recovered(spark, target).collect()] == ["1"]
    assert [x[1:4] for x in ledger(spark, target)] == [
        (1, "no json value", "retried"), (1, "no json value", "retried"), (2, "", "recovered"), (2, "no json value", "dead"),
    ]


# Maintained state -----------------------------------------------------------------

STATE = "k int, ts int, id int, v string"


def test_upserts_touch_only_the_buckets_they_hit(spark, tmp_path):
    draw = random.Random(1)
    out, best = str(tmp_path / "latest"), {}
    for n in range(5):
        rows = [(draw.randint(0, 30) if n < 3 else n, draw.choice([None, 1, 2, 3]), i, f"{n}-{i}") for i in range(20)]
        rows = [(k, ts, 100 * n + i, v) for k, ts, i, v in rows]
        for _ in range(2):  # each batch is repeated
            upsert.upsert(spark.createDataFrame(rows, STATE), n, out, ["k"], "ts", ["id"], buckets=8)
        for row in rows:
            best[row[0]] = max(best.get(row[0], row), row, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        got = upsert.read_upserted(spark, out, STATE)
        assert sorted(map(tuple, got.collect())) == sorted(best.values())
    written = {p.parent.name for p in (tmp_path / "latest" / "state").glob("batch_id=4/bucket=*")}
    assert written == {"batch_id=4"} and len(list((tmp_path / "latest" / "state" / "batch_id=4").glob("bucket=*"))) == 1
    gone = upsert.vacuum(spark, out, keep=0)
    assert gone and sorted(map(tuple, upsert.read_upserted(spark, out, STATE).collect())) == sorted(best.values())


def test_an_upsert_that_failed_is_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "latest")
    upsert.upsert(spark.createDataFrame([(1, 1, 1, "a")], STATE), 0, out, ["k"], "ts")
    later = spark.createDataFrame([(1, 2, 2, "b"), (2, 1, 1, "c")], STATE)
    with monkeypatch.context() as m:
        m.setattr(upsert, "VERSIONS", "no/such:scheme://" + "\x00")
        with pytest.raises(Exception):
            upsert.upsert(later, 1, out, ["k"], "ts")
    assert [r.v for r in upsert.read_upserted(spark, out, STATE).collect()] == ["a"]
    upsert.upsert(later, 1, out, ["k"], "ts")
    assert sorted(r.v for r in upsert.read_upserted(spark, out, STATE).collect()) == ["b", "c"]


def test_empty_state(spark, tmp_path):
    out = str(tmp_path / "latest")
    assert upsert.read_upserted(spark, out, STATE).collect() == []
    upsert.upsert(spark.createDataFrame([], STATE), 0, out, ["k"], "ts")
    assert upsert.read_upserted(spark, out, STATE).collect() == []
