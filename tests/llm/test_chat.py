"""Layouts, template and loss spans, against plain Python and SQL."""

import hashlib
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlane.llm import chat, registry

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, piece string, place int, record string, salt int"

# A record of each layout, and the turns it stands for.
RECORDS = [
    ({"role": "user", "text": "a"}, [("user", "a")]),
    ({"role": None, "text": None}, [("", "")]),
    ({"messages": [{"role": "user", "content": "a", "id": 1}, {"role": "tool", "content": 5}]},
     [("user", "a"), ("tool", "5")]),
    ({"messages": [{"role": "user", "content": "a"}, {"content": "b"}]}, [("user", "a"), ("", "b")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"text": "b"}]}]},
     [("user", "ab")]),
    ({"turns": [{"role": "assistant", "content": "x"}], "meta": {"deep": [1, {"er": 2}]}}, [("assistant", "x")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "x", "value": ""}]},
     [("user", "q"), ("assistant", "r"), ("x", "")]),
    ({"system": "s", "prompt": "p", "completion": "c", "url": "u"},
     [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "n", "output": "o"}, [("user", "i\n\nn"), ("assistant", "o")]),
    ({"instruction": "i", "context": "n", "response": "o"}, [("user", "i\n\nn"), ("assistant", "o")]),
    ({"question": "q", "answer": "a", "tags": ["x"]}, [("user", "q"), ("assistant", "a")]),
    ({"messages": []}, None),
    ({"prompt": "p"}, None),
    ({"body": "p"}, None),
    ([1, 2], None),
    ("text", None),
]


def test_each_layout(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(RECORDS)]
    frame = spark.createDataFrame(rows, "n int, json string").select("n", F.parse_json("json").alias("record"))
    got = {r.n: r.turns for r in chat.canonical(frame).collect()}
    for n, (record, turns) in enumerate(RECORDS):
        assert (got[n] and [tuple(t) for t in got[n]]) == turns, record
    lost = chat.unknown(frame).collect()
    assert sum(r.records for r in lost) == sum(turns is None for _, turns in RECORDS)


def test_layouts_have_fingerprints_of_their_own():
    assert len({frozenset(x.paths()) for x in chat.LAYOUTS}) == len(chat.LAYOUTS)


def odd_rows(n=160, seed=5):
    draw = random.Random(seed)
    marks = ["</turn>", "<turn ", "<", ">", "\\", "\\l", "\\\\", "\n", "</tur", "é", "\U0001f600", " ", "n>", "turn "]
    rows = []
    for _ in range(n):
        text = draw.choice([None, "", "plain", "".join(draw.choices(marks, k=draw.randint(1, 12)))])
        role = draw.choice(["user", "assistant", "assistant", "system", None, "", "a>b\n</turn>\\"])
        rows.append((draw.choice([None, 1, 2, 3, -7, 9]), draw.choice([None, *range(40)]), role, text, "p", 1, "r", 0))
    rows += [(4, t, "assistant", "x" * 700_000 + "</turn>", "p", 1, "r", 0) for t in range(3)]
    return rows + rows[:9]


def said(rows):
    """The texts of each conversation's turns, without an order between equal turns."""
    rows = [(c, t, r or "", x or "") for c, t, r, x, *_ in rows]
    rows += [(-7, 0, r, "\\### Assistant: </turn> ok") for r in ("user", "assistant")]
    found = {}
    for c, t, r, x in rows:
        found.setdefault(c, []).append((t is not None, t or 0, r, x))
    return {c: sorted(own) for c, own in found.items()}


@pytest.mark.parametrize("part_chars", [1, 300, chat.PART_CHARS])
def test_parts_read_back_as_the_turns(spark, part_chars):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    parts = chat.formatted(chat.canonical(chat.records(frame)), part_chars).collect()
    got, loss = {}, {}
    for p in sorted(parts, key=lambda p: p.part):
        turns = list(chat.parsed(p.text))
        assert len(p.text) <= part_chars or len(turns) == 1
        got.setdefault(p.conv_id, []).extend(turns)
        covered = [chat.unescaped(p.text[s.start : s.stop]) for s in p.spans]
        assert covered == [text for role, text in turns if role == "assistant"]
        loss.setdefault(p.conv_id, []).extend(covered)
    for conv, own in said(rows).items():
        assert sorted(got[conv]) == sorted((r, x) for _, _, r, x in own)
        assert sorted(loss[conv]) == sorted(x for _, _, r, x in own if r == "assistant")


def test_digests(spark):
    rows = [r for r in odd_rows() if r[1] is not None]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(frame, part_chars=500).collect()}
    wanted = said(rows)
    assert set(got) == set(wanted)
    for conv, own in wanted.items():
        if conv == -7:
            continue  # two rows of turn 0 beside the table's
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        all_turns = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(all_turns.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_reading_stops_at_what_is_no_turn():
    with pytest.raises(ValueError):
        list(chat.parsed("<turn user>\na</turn>\nb"))


def test_empty_table_has_only_the_marked_conversation(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert [(r.conv_id, r.n_turns) for r in chat.read_back(frame).collect()] == [(-7, 2)]


@pytest.mark.skipif(not DATA.exists(), reason="no driver data")
def test_query_is_its_sql(spark):
    name = "op12_chat_format"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    wanted = connection.execute(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, str(DATA))
    assert got.columns == [d[0] for d in wanted.description]
    assert sorted(map(tuple, got.collect())) == sorted(wanted.fetchall())
