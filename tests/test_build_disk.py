"""What the full build shuffles and writes, with the same rows."""

import re

import pyarrow.parquet as pq
import pytest

from fixture_rows import write_seeds
from martlane.operators.heavy import heavy_keys, summarize
from martlane.plans import enterprise, logistics
from martlane.plans.build import load_seeds
from martlane.sources.seeds import seed_columns
from martlane.sources.tables import Catalog


@pytest.fixture()
def no_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def exchanges(frame):
    """Names of the columns that go through each exchange of the plan."""
    text = frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    return [re.sub(r"#\w+", "", x).split(", ") for x in inputs]


def listed(df, key):
    return heavy_keys(df, key, summarize(df, key))


@pytest.fixture()
def marts(spark):
    lines = [("A", p, 2, 1.5) for p in ("p", "p", "q", None)] + [("B", "p", 1, 2.0), (None, "q", 1, 3.0)]
    return {
        "headers": spark.createDataFrame(
            [("A", "c1", 10.0), ("B", "c2", 20.0), ("C", None, 30.0), (None, "c1", 1.0)],
            "order_id string, customer_id string, total_amount_chf double",
        ),
        "lines": spark.createDataFrame(
            lines, "order_id string, product_id string, quantity int, line_total_chf double"
        ),
        "orders": spark.createDataFrame(
            [("A", "c1", 10.0), ("B", "c2", None), ("C", None, 30.0), ("B", "c1", 5.0), (None, "c1", 1.0)],
            "order_id string, customer_id string, total double",
        ).selectExpr("order_id", "customer_id", "CAST(total AS decimal(12,2)) AS header_total_chf"),
        "shipments": spark.createDataFrame(
            [(o, s, "W1", "N1", "2024-01-01", "2024-01-03", True, None)
             for o, s in [("A", "s1"), ("A", "s1"), ("A", "s2"), ("B", None), (None, "s4"), ("C", "s5")]],
            "order_id string, shipment_id string, origin_warehouse string, destination_city string, "
            "shipped_at string, delivered_at string, requires_customs boolean, customs_declaration_id string",
        ).selectExpr("* except (shipped_at, delivered_at)", "CAST(shipped_at AS timestamp_ntz) AS shipped_at",
                     "CAST(delivered_at AS timestamp_ntz) AS delivered_at"),
        "payments": spark.createDataFrame(
            [("A", "x"), ("B", "y"), ("B", "y2"), ("C", "z"), (None, "n"), ("D", "d")],
            "order_id string, payment_id string",
        ).selectExpr("*", "7.00 AS amount_chf", "1.00 AS total_refund_amount_chf", "6.00 AS net_amount_chf",
                     "'TWINT' AS payment_method", "'PAID' AS status", "false AS is_international",
                     "true AS requires_aml_check", "current_date() AS created_at", "current_date() AS processed_at"),
        "customers": spark.createDataFrame(
            [("c1", "One", "k1"), ("c1", "One", "k2"), ("c3", "Three", None), (None, "None", "k4")],
            "customer_id string, company_name string, primary_contact_id string",
        ),
    }


def test_lines_are_shuffled_once(marts, rows, no_broadcasts):
    headers, lines = marts["headers"], marts["lines"]
    plain = logistics.mart_order_summary(headers, lines)
    heavy = listed(lines, "order_id")
    once = logistics.mart_order_summary(headers, lines, heavy)
    assert sum("quantity" in x or "product_id" in x for x in exchanges(once)) == 1
    hot = logistics.mart_order_summary(headers, lines, heavy, hot_rows=2)
    assert sum("product_id" in x for x in exchanges(hot)) == 1 and len(exchanges(hot)) == 3
    assert rows(plain) == rows(once) == rows(hot)
    assert {(r.order_id, r.line_item_count, r.distinct_product_count) for r in once.collect()} == {
        ("A", 4, 2), ("B", 1, 1), ("C", 0, 0), (None, 0, 0)
    }


def test_routes_shuffle_shipments_once(marts, rows, no_broadcasts):
    own = [marts[x] for x in ("orders", "shipments", "payments")]
    plain = enterprise.revenue_by_route(*own)
    heavy = {"shipments": listed(marts["shipments"], "order_id")}
    once = enterprise.revenue_by_route(*own, heavy=heavy)
    assert sum("shipment_id" in x for x in exchanges(once)) == 1
    assert len(exchanges(once)) < len(exchanges(plain))
    assert rows(plain) == rows(once) == rows(enterprise.revenue_by_route(*own, heavy=heavy, hot_rows=2))


def test_customers_meet_orders_before_these_fan_out(marts, rows, no_broadcasts):
    own = [marts[x] for x in ("payments", "orders", "shipments", "customers")]
    keys = {"transactions": (0, "order_id"), "shipments": (2, "order_id"), "customers": (3, "customer_id")}
    heavy = {name: listed(own[at], key) for name, (at, key) in keys.items()}
    report = enterprise.transaction_report(*own, heavy=heavy)
    # No payment is moved but by order.
    assert sum("payment_id" in x for x in exchanges(report)) == 1
    pairs = [(r.payment_id, r.shipment_id, r.customer_id, r.company_name) for r in report.collect()]
    want = [("x", s, "c1", "One") for s in ("s1", "s1", "s2") for _ in range(2)]
    want += [(p, None, *c) for p in ("y", "y2") for c in (("c2", None), ("c1", "One"), ("c1", "One"))]
    want += [("z", "s5", None, None)]
    assert sorted(map(str, pairs)) == sorted(map(str, want))
    for hot_rows in (1, 2):
        assert rows(enterprise.transaction_report(*own, heavy=heavy, hot_rows=hot_rows)) == rows(report)
        assert rows(enterprise.transaction_report(*own, hot_rows=hot_rows)) == rows(report)


def test_raw_tables_are_written_in_order_of_their_ids(spark, tmp_path):
    write_seeds(tmp_path, lambda table: [name for name, _ in seed_columns(table)])
    seed = tmp_path / "tracking_event.csv"
    header, *lines = seed.read_text(encoding="utf-8").splitlines()
    seed.write_text("\n".join([header, *lines[::-1]]) + "\n", encoding="utf-8")
    catalog = Catalog(spark, "_disk", str(tmp_path / "tables"))
    load_seeds(catalog, str(tmp_path))
    raw = catalog.read("raw", "shipments", "tracking_event")
    assert raw.count() == len(lines)
    for path in raw.inputFiles():
        file = pq.ParquetFile(path.removeprefix("file://"))
        ids = file.read()["event_id"].to_pylist()
        assert ids == sorted(ids)
        # Those of the format's second version.
        assert "PLAIN_DICTIONARY" not in file.metadata.row_group(0).column(0).encodings
