"""Repairs against all possible edits, trails against plain strings, chunks against whole conversations."""

import hashlib
import itertools
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlane.llm import registry, repair
from martlane.llm.trails import PRIME, START, Edits, Trail, applied, common, precedes

DATA = Path("/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, times int, cost string, print long"
SPACE = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("prime", [PRIME, 3, 1])
def test_trails_compare_as_their_texts(prime):
    draw = random.Random(prime)
    trails = [Trail(None, "", prime)]
    for _ in range(300):
        before = draw.choice(trails[-12:])
        trails.append(Trail(before, "".join(draw.choices("DI", k=draw.choice([0, 1, 1, 1, 7]))), prime))
    for _ in range(1500):
        a, b = draw.choice(trails), draw.choice(trails)
        x, y = a.text(), b.text()
        assert precedes(a, b, prime) == (x < y)
        shared = next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
        assert common(a, b, prime) == shared


def all_edits(rows):
    """The least (cost, audit) over all edit sequences with up to two rows inserted in a gap."""
    best = None
    choices = [["D"] if forced else ["K", "Ru", "Ra", "D"] for _, _, forced in rows]
    gaps = [[(), ("u",), ("a",), ("u", "a"), ("a", "u")] for _ in range(len(rows) + 1)]
    for edits in itertools.product(*choices):
        for given in itertools.product(*gaps):
            cost, audit, roles = 0, "", ""
            for i, (initial, cut, _) in enumerate(rows):
                cost, audit, roles = cost + 3 * len(given[i]), audit + "I" * len(given[i]), roles + "".join(given[i])
                edit = edits[i]
                audit += edit[0]
                if edit == "D":
                    cost += 4
                else:
                    cost += 3 * cut + 3 * (edit != "K")
                    roles += initial if edit == "K" else edit[1]
            last = given[-1]
            cost, audit, roles = cost + 3 * len(last), audit + "I" * len(last), roles + "".join(last)
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_edits_are_the_cheapest_of_all():
    draw = random.Random(2)
    for _ in range(60):
        rows = [
            (draw.choice(["s", "u", "u", "a", "a", "t"]), draw.random() < 0.4, draw.random() < 0.2)
            for _ in range(draw.randint(0, 3))
        ]
        edits = Edits(START)
        for initial, cut, forced in rows:
            edits.delete() if forced else edits.row(initial, cut)
        assert edits.cheapest() == all_edits(rows), rows


def plain(rows):
    """(cost, audit) with whole strings, from the last row to the first."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    now = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}

    def with_inserts(table):
        best = dict(table)
        for _ in range(3):
            for state in best:
                spoken = "a" if state == "u" else "u"
                cost, audit = best[spoken]
                best[state] = min(best[state], (cost + 3, "I" + audit))
        return best

    now = with_inserts(now)
    for initial, cut, forced in reversed(rows):
        before = {}
        for state in after:
            cost, audit = now[state]
            found = [(cost + 4, "D" + audit)]
            if not forced:
                if initial in after[state]:
                    cost, audit = now[after[state][initial]]
                    found.append((cost + 3 * cut, "K" + audit))
                cost, audit = now["a" if state == "u" else "u"]
                found.append((cost + 3 * cut + 3, "R" + audit))
            before[state] = min(found)
        now = with_inserts(before)
    return now[""]


def expected(rows):
    """Reports by conversation from rows (conv_id, turn, role, text, times), in plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        own = [(t, " " if r is None else r, " " if x is None else x, n) for c, t, r, x, n in rows if c == conv]

        def place(row):
            both = f"{len(row[1].encode())}:{row[1]}{row[2]}"
            return row[0] is not None, row[0] or 0, hashlib.sha256(both.encode()).hexdigest()

        own = [r[:3] for r in sorted(own, key=place) for _ in range(r[3])]
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            if not bare:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        steps = [(i, f == "truncated", f in ("blank", "duplicate")) for i, f in zip(initials, faults, strict=True)]
        cost, audit = plain(steps)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        lines = [f"{r}:{x}" for r, x in applied(audit, [(r, x, 1) for _, r, x in own])]
        made = "".join(line[0] for line in lines)
        assert re.fullmatch("(s?(ua)+)?", made), made
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def odd_rows(n, convs, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "Yes.", "No", "", " \n\t", None, "Why?\n", "é\U0001f600", "x" * 400_000 + "!", "a.b", "\x1f."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "unknown", "é"]
    turns = [None, *range(n // convs), -5]
    rows = []
    for i in range(n):
        text = draw.choice(texts) if draw.random() < 0.4 else f"{i} said{draw.choice(['.', ''])}"
        rows.append((draw.choice([None, *range(convs)]), draw.choice(turns), draw.choice(roles), text, draw.choice([0, 1, 1, 1, 2, 3])))
    return rows + rows[: n // 8]


@pytest.mark.parametrize("n, convs, chunk, prime", [(240, 40, 4096, PRIME), (240, 2, 5, PRIME), (160, 1, 3, 5), (0, 1, 4, PRIME)])
def test_report(spark, n, convs, chunk, prime):
    rows = odd_rows(n, convs, n + convs)
    frame = spark.createDataFrame([(*r, "c", 7) for r in rows], SCHEMA).repartition(3)
    got = repair.report(frame, F.col("times"), chunk, prime).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_repaired_turns_are_what_the_digest_is_of(spark):
    rows = odd_rows(120, 6, 1)
    frame = spark.createDataFrame([(*r, "c", 7) for r in rows], SCHEMA)
    lines = {}
    for r in sorted(repair.repaired(frame).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in repair.report(frame).collect():
        text = "\n".join(lines.get(r.conv_id, []))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def damage(conv, turn, role, text):
    conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
    role, text = (" " if x is None else x for x in (role, text))
    kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    return conv, turn, "user" if kind == 4 else role, text, {0: 0, 3: 2}.get(kind, 1)


def test_damage(spark):
    rows = [(i % 50, t, r, x, 1, "c", 7) for i, (_, t, r, x, _) in enumerate(odd_rows(400, 1, 4))]
    rows.append((None, None, None, None, 1, "c", 7))
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    wanted = [damage(*r[:4]) for r in rows]
    assert [tuple(r) if r.times else (*r[:2], 0) for r in got] == [w if w[4] else (*w[:2], 0) for w in wanted]


@pytest.mark.skipif(not DATA.exists(), reason="no driver data")
def test_query(spark):
    rows = spark.read.parquet(str(DATA / "conversations.parquet")).collect()
    wanted = expected([damage(r.conv_id, r.turn, r.role, r.text) for r in rows])
    got = registry.QUERIES["op11_repair_conversations"](spark, str(DATA))
    assert got.columns[:9] == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == wanted
