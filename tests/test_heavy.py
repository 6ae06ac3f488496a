"""Stored lists of heavy keys, and joins that use them."""

import random

import pytest
from pyspark.sql import functions as F

from martlane.operators.heavy import candidates, combine, heavy_keys, summarize
from martlane.operators.joins import Side, star_join


@pytest.fixture(scope="module")
def facts(spark):
    draw = random.Random(7)
    rows = [(draw.choice([None, 1, 1, 1, 2, 2, *range(3, 200)]), i, f"v{i}") for i in range(4000)]
    return spark.createDataFrame(rows, "k int, id int, v string").repartition(6)


def counts(df, least):
    rows = df.filter("k is not null").groupBy("k").count().collect()
    return {r.k: r["count"] for r in rows if r["count"] >= least}


@pytest.mark.parametrize("share", [5, 40, 2000])
def test_keys_are_counted_exactly(facts, share):
    total = facts.filter("k is not null").count()
    found = heavy_keys(facts, "k", summarize(facts, "k"), share).collect()
    assert {r.hot_key: r.n for r in found} == counts(facts, max(2, total / share))
    assert {r.total for r in found} <= {total}


def test_summaries_of_parts_are_that_of_the_whole(facts):
    parts = [facts.filter(F.col("id") % 3 == i) for i in range(3)]
    merged = combine([summarize(p, "k") for p in parts])
    assert merged.first()["rows"] == facts.filter("k is not null").count()
    found = heavy_keys(facts, "k", merged, 40).collect()
    assert {r.hot_key for r in found} == {r.hot_key for r in heavy_keys(facts, "k", summarize(facts, "k"), 40).collect()}


def test_more_keys_than_counters(spark, monkeypatch):
    monkeypatch.setattr("martlane.operators.heavy.COUNTERS", 64)
    monkeypatch.setattr("martlane.operators.heavy.CANDIDATES", 64)
    many = spark.range(20000).selectExpr("if(id % 4 = 0, -1, id) AS k").repartition(5)
    assert -1 in [r.hot_key for r in candidates(summarize(many, "k"), 10).collect()]
    assert [tuple(r) for r in heavy_keys(many, "k", summarize(many, "k"), 10).collect()] == [(-1, 5000, 20000)]


@pytest.mark.parametrize("hot_rows", [1, 30, 10**6])
@pytest.mark.parametrize("keep", [True, False])
def test_joins_by_lists_are_plain_joins(spark, facts, hot_rows, keep):
    base = spark.createDataFrame([(k, f"b{k}") for k in [*range(0, 50, 2), 1, None]], "k int, b string")
    heavy = heavy_keys(facts, "k", summarize(facts, "k"))
    out = star_join(base, "k", [Side(facts, ["id"], keep, heavy=heavy)], ["b"], hot_rows=hot_rows)
    plain = base.join(facts, "k", "left" if keep else "inner")
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.select(out.columns).collect()))
    scans = out._jdf.queryExecution().optimizedPlan().toString().count("Join")
    assert (scans == 1) == (hot_rows == 10**6)
