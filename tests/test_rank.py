"""Ranks of whole tables and groups against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlane.operators.rank import placed, placed_within, ranked


@pytest.fixture(scope="module")
def scores(spark):
    draw = random.Random(3)
    rows = [
        (i, draw.choice(["a", "b", None, "c", "c", "c", "c"]), draw.choice([None, 1, 1, 1, 2, 5, 9]))
        for i in range(700)
    ]
    return spark.createDataFrame(rows, "id long, team string, score int").repartition(5)


def as_set(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("dense", [False, True])
def test_rank_is_that_of_a_window(scores, dense):
    order = {"score": F.col("score").desc_nulls_first(), "team": F.col("team").asc_nulls_last()}
    window = Window.orderBy(*order.values())
    expected = scores.withColumn("rank", (F.dense_rank() if dense else F.rank()).over(window))
    got = ranked(scores, order, dense=dense)
    assert as_set(got, "id", "rank") == as_set(expected, "id", "rank")


def test_tiebreak_gives_each_row_its_own_rank(scores):
    order = {"score": F.col("score").asc_nulls_first()}
    expected = scores.withColumn("rank", F.row_number().over(Window.orderBy(*order.values(), "id")))
    got = ranked(scores, order, tiebreak=[F.col("id").asc()])
    assert as_set(got, "id", "rank") == as_set(expected, "id", "rank")


def test_places_within_groups(scores):
    got = placed_within(scores, {"team": F.col("team").asc_nulls_first()}, [F.col("id").asc()])
    rows = got.collect()
    expected, start = set(), 0
    for team in (None, "a", "b", "c"):
        ids = sorted(r.id for r in rows if r.team == team)
        expected |= {(i, team, p, start, len(ids)) for p, i in enumerate(ids)}
        start += len(ids)
    assert {(r.id, r.team, r.place, r.group_start, r.group_rows) for r in rows} == expected


def test_no_window_over_all_rows(scores):
    """Equal values of a third of the rows are dealt to several ranges."""
    frame = placed(scores.withColumn("same", F.lit(1)).repartition(6), [F.col("same").asc()])
    places = sorted(r.place for r in frame.collect())
    assert places == list(range(700))


def test_empty(spark):
    empty = spark.createDataFrame([], "id long, team string, score int")
    assert ranked(empty, {"score": F.col("score").asc()}).collect() == []
    assert placed_within(empty, {"team": F.col("team").asc()}, [F.col("id").asc()]).collect() == []
