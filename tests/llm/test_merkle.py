"""The manifest against trees built in plain Python, and against its SQL."""

import hashlib
import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlane.llm import merkle, registry

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, place int, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root, and of each node the others of its run on every level, as (before, after)."""
    paths, above = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(above):
            run = at - at % 3
            paths[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])))
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        above = [at // 3 for at in above]
    return nodes[0], paths


def expected(rows):
    """Sorted result rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), i) for i, r in enumerate(groups[source])]
        own.sort()
        trees[source] = own, *climb([x[2] for x in own])
    root, over = climb([trees[s][1] for s in order]) if order else (None, [])
    out = []
    for source, more in zip(order, over, strict=True):
        own, subroot, paths = trees[source]
        for (_, _, digest, i), path in zip(own, paths, strict=True):
            row = groups[source][i]
            path = path + more
            node = digest
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = row["text"]
                node = leaf(row, text if text is None else text.replace("\n", ""))
            for before, after in path:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in path))
            out.append((row["doc_id"], digest, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def sample(n, sources, seed):
    draw = random.Random(seed)
    texts = ["a\nb", "", None, "x" * 300_000 + "\n", "é\n" * 40, "\n"]
    rows = []
    for i in range(n):
        text = draw.choice(texts) if draw.random() < 0.3 else f"text {i}\nof {draw.random()}"
        doc_id = draw.choice([None, 5, 5, i, -i]) if draw.random() < 0.1 else i * 7
        rows.append(
            dict(
                doc_id=doc_id,
                text=text,
                lang=draw.choice(["en", None, ""]),
                source=draw.choice(sources),
                n_chars=draw.choice([None, len(text or "")]),
                hash="h",
                place=3,
                tree=None,
            )
        )
    return rows + rows[: n // 10]


def run(spark, rows):
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, merkle.verified(frame).collect()), key=str)


@pytest.mark.parametrize(
    "n, sources",
    [(0, ["a"]), (1, ["a"]), (9, ["a"]), (28, [None]), (400, [None, "", "a", "a", "a", "é", "z", "Z", "\U0001f600"])],
)
def test_trees_and_proofs(spark, n, sources):
    rows = sample(n, sources, n)
    assert run(spark, rows) == expected(rows)


def test_blocks_do_not_change_the_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = sample(130, ["a", "a", "b"], 8)
    assert run(spark, rows) == expected(rows)


def test_paths_lead_to_the_root(spark):
    rows = sample(50, ["a", "b", None], 2)
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    found = merkle.manifest(frame, fields=["text", "lang"], group="lang", order="text")
    wrong = found.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root"))
    assert wrong.count() == 0 and found.count() == len(rows)


@pytest.mark.skipif(not DATA.exists(), reason="no driver data")
def test_query_is_its_sql(spark):
    name = "op13_merkle_manifest"
    documents = f"SELECT * FROM '{DATA}/documents.parquet'"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS {documents}")
    wanted = connection.execute(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, str(DATA))
    assert got.columns == [d[0] for d in wanted.description]
    assert sorted(map(tuple, got.collect())) == sorted(wanted.fetchall())
