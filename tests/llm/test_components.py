"""Connected components against a search, on chains, stars, loops and copies."""

import random

from brute_force import components as searched

from martlane.llm.components import components


def test_components(spark):
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 540)]
    links += [(draw.randint(1000, 1100), draw.randint(1000, 1100)) for _ in range(60)]
    links += [(7, 7), (9, 8), (8, 9), (9, 8), (None, 3)]
    frame = spark.createDataFrame(links, "u long, v long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = searched(sorted({x for link in real for x in link}), real)
    got = components(frame).collect()
    assert {r.node: r.root for r in got} == want
    assert len(got) == len(want)
    assert components(frame.limit(0)).count() == 0
