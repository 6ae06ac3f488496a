"""Clashing names, repeated vectors, and license-dense texts."""

import random
import time

import pytest

from martlane.llm import ann, jaccard, licenses, mixing, substrings

TEXT = "some words that are long enough to be removed when they come again here"
NAMES = "print", "rows", "copies", "copy", "row", "class", "bytes", "count"


@pytest.fixture(scope="module")
def clashing(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    texts = [TEXT, TEXT, f"{TEXT} and more", "x y z", None, "x y z"]
    rows = [(i % 5, t, "en", "s", 1, *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def test_columns_keep_their_values(clashing):
    before = {(r.doc_id, *[r[n] for n in NAMES]) for r in clashing.collect()}
    for frame in (
        mixing.take(clashing, mixing.mix(clashing)),
        substrings.removed(clashing),
        jaccard.kept(clashing),
    ):
        assert frame.columns == clashing.columns
        after = [(r.doc_id, *[r[n] for n in NAMES]) for r in frame.collect()]
        assert after and set(after) <= before
    cut = substrings.removed(clashing).collect()
    assert len(cut) == 6 and all(r.n_chars == len(r.text) for r in cut if r.doc_id in (1, 2))


def test_repeated_vectors_are_candidates_each(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(40)]
    rows += [rows[7], rows[7], (7, rows[8][1]), rows[20]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=50).collect()
    for query in (0, 20):
        wanted = [v for v, _ in rows if v != query]
        assert sorted(r.vec_id for r in got if r.query_id == query) == sorted(wanted)


def test_outermost_intervals_are_those_of_all_comparisons():
    draw = random.Random(3)
    for _ in range(300):
        spans = sorted(
            (-draw.randint(0, 3), a - b, a, b, "x", 0.5)
            for a, b in (sorted((draw.randint(0, 30), draw.randint(0, 30))) for _ in range(25))
        )
        kept = []
        for _, _, first, after, label, weight in spans:
            if not any(a <= first and after <= b for a, b, _, _ in kept):
                kept.append((first, after, label, weight))
        assert licenses._outermost(spans) == kept


def test_license_dense_texts_take_time_in_proportion():
    def seconds(times):
        text = b"this file is under the mit license and the apache license version 2 or gpl-3.0 see notes " * times
        begin = time.process_time()
        licenses.scan_text(text, licenses.rules())
        return time.process_time() - begin

    seconds(10)
    small, large = seconds(2_000), seconds(16_000)
    assert large < 8 * 3 * small
