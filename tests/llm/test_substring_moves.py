"""What the removal of repeated substrings moves and sorts."""

import random
import re

import pytest

from martlane.llm import common, substrings


def sentence(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(3, 9))) for _ in range(n))


@pytest.fixture()
def docs(spark):
    draw = random.Random(5)
    passage = sentence(draw, 40)
    texts = [f"{sentence(draw, 20)} {passage} {sentence(draw, 20)}" for _ in range(60)]
    texts += [sentence(draw, 30) for _ in range(20)] + [None, "", texts[3]]
    rows = [(i, t, None, f"c{i}") for i, t in enumerate(texts)]
    rows += [(None, texts[1], 7, "x"), (3, "short", None, "y"), (3, None, 1, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, more string")


def moved(frame, names):
    """Exchanges of the plan through which a column of such a name goes."""
    text = frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    return sum(bool(re.search(rf"\b({names})#", x)) for x in inputs)


@pytest.fixture()
def no_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_texts_move_twice_where_ids_are_many(spark, docs, no_broadcasts, monkeypatch):
    few = {f.__name__: sorted(map(str, f(docs).collect())) for f in (substrings.removed, substrings.digests)}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    plans = []

    def seen(frame, purpose, write=substrings.written):
        plans.append(frame)
        return write(frame, purpose)

    monkeypatch.setattr(substrings, "written", seen)
    for f in (substrings.removed, substrings.digests):
        plans.clear()
        found = f(docs)
        assert sum(moved(p, "text|bytes|row") for p in [*plans, found]) <= 2
        assert sorted(map(str, found.collect())) == few[f.__name__]


def test_equal_strings_are_sorted_once(monkeypatch):
    draw = random.Random(6)
    passage = sentence(draw, 10).encode()
    # No two contexts share a byte at the passage's edges.
    edge = lambda i: bytes([128 + i]) * 5
    contexts = [(i, 0, 100 * i, edge(i) + passage + edge(i)) for i in range(1, 120)]
    sizes = []

    def sort(text, array=substrings.suffix_array):
        sizes.append(len(text))
        return array(text)

    monkeypatch.setattr(substrings, "suffix_array", sort)
    found = substrings.repeats(contexts)
    assert sum(sizes) < 3 * len(passage)
    for i, *_, text in contexts[1:]:
        gone = sorted(x for doc, _, a, b in found if doc == i for x in range(a, b))
        at = 100 * i + text.index(passage)
        assert set(range(at, at + len(passage))) <= set(gone)
    assert not any(doc == 1 for doc, *_ in found)
