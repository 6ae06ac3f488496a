"""Every registered query against DuckDB on the smallest data folder."""

import importlib.util
import math
from pathlib import Path

import pytest

from martlane.demo import registry, streams
from martlane.demo.standins import Standins

duckdb = pytest.importorskip("duckdb")

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver data")

# The corpus operators have tests of their own.
QUERIES = {n: q for n, q in entry.queries().items() if n in registry.QUERIES}
ORACLE = {n: sql for n, sql in entry.oracle_sql().items() if n in registry.QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value)


@pytest.fixture(scope="module")
def standins(spark):
    """One set of plans for all queries."""
    return Standins(spark, str(DATA))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(standins, oracle, name):
    df = registry.present(registry.QUERIES[name].build(standins))
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    result = oracle.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(shown(r[i]) for i in places) for r in result.fetchall())
    assert got


def test_bodies_of_many_payloads_stay_small(standins, monkeypatch):
    """There are as many bodies as the table needs, each a file of so many events at most."""
    folders, ingested = [], streams._ingested

    def seen(d, folder, *args, **options):
        folders.append(Path(folder.removeprefix("file:")))
        return ingested(d, folder, *args, **options)

    monkeypatch.setattr(streams, "_ingested", seen)
    monkeypatch.setattr(streams, "BODY_EVENTS", 20, raising=False)
    n = streams.multiline_payloads(standins).count()
    files = [f.read_text(encoding="utf-8") for f in (folders[0] / "landing").rglob("part-*")]
    counts = [text.count('"fahrt_bezeichner"') for text in files]
    assert sum(counts) == n
    assert max(counts) <= 20
    assert all(text.count('"results"') == 1 for text in files)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
