from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixture_rows import SEED_FILES, write_seeds
from martlane.demo import standins
from martlane.demo.standins import Standins
from martlane.plans import enterprise, metrics, reports
from martlane.plans.build import DOMAIN_MARTS, ENTERPRISE_MARTS, build_all, build_feeds, check_all
from martlane.plans.feeds import mart_swiss_rail_overview, mart_weather_station_catalog
from martlane.plans.staging import (
    stage,
    stg_meteoswiss_stations,
    stg_sbb_stationboard,
    stg_transport_connections,
)
from martlane.sources.schemas import CHECKS, SEEDS
from martlane.sources.seeds import read_seed, seed_columns
from martlane.sources.tables import Catalog, preview, row_count


@pytest.fixture(scope="session")
def seeds(tmp_path_factory):
    folder = tmp_path_factory.mktemp("seeds")
    write_seeds(folder, lambda table: [name for name, _ in seed_columns(table)])
    return str(folder)


@pytest.fixture(scope="session")
def frames(spark, seeds):
    return build_all(Catalog(spark, "_test"), seeds)


def row(df, **where):
    for column, value in where.items():
        df = df.filter(F.col(column) == value)
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict()


def test_every_seed_keeps_its_rows_and_types(spark, seeds):
    for table in SEEDS:
        df = stage(read_seed(spark, seeds, table), table)
        assert df.count() == len(SEED_FILES[table])
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == seed_columns(table)


def test_staging_keeps_zeros_and_reads_quotes_and_blanks(frames):
    assert row(frames["stg_product"], product_id="p1")["hs_tariff_code"] == "04069061"
    assert row(frames["stg_business_customer"], customer_id="c3")["company_name"] == "Tal, Söhne"
    assert row(frames["stg_tracking_event"], event_id="e2")["notes"] == 'left "at" door'
    assert row(frames["stg_payment"], payment_id="x2")["card_brand"] is None


def test_staging_strict_and_lenient(spark):
    raw = spark.createDataFrame([("r1", "x1", "FRAUD", "many", "PENDING", "2026-01-01", None)], "a string, b string, c string, d string, e string, f string, g string")
    raw = raw.toDF(*[n for n, _ in seed_columns("refund")])
    assert stage(raw, "refund", strict=False).first()["amount_chf"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw, "refund").collect()


def test_customer_overview(frames):
    mart = frames["mart_customer_overview"]
    assert mart.count() == 4 and len(mart.columns) == 16
    assert mart.filter("customer_id = 'c1'").count() == 2
    assert row(mart, customer_id="c2")["primary_contact_email"] is None


def test_fleet_status(frames):
    mart = frames["mart_fleet_status"]
    assert len(mart.columns) == 19
    first = row(mart, vehicle_id="v1")
    assert (first["latest_latitude"], first["latest_is_moving"], first["total_positions"]) == (47.2, False, 2)
    untimed = row(mart, vehicle_id="v2")
    assert (untimed["latest_recorded_at"], untimed["latest_latitude"]) == (None, 47.4)
    assert row(mart, vehicle_id="v3")["total_positions"] is None


def test_warehouse_capacity(frames):
    mart = frames["mart_warehouse_capacity"]
    assert len(mart.columns) == 19
    full = row(mart, warehouse_id="w1")
    assert full["total_zone_capacity_pallets"] == 180 and full["temp_controlled_zones"] == 2
    assert (full["cold_capacity_pallets"], full["hazmat_capacity_pallets"]) == (80, 0)
    empty = row(mart, warehouse_id="w2")
    assert all(empty[c] is None for c in mart.columns[10:])


def test_order_summary(frames):
    mart = frames["mart_order_summary"]
    assert len(mart.columns) == 14
    full = row(mart, order_id="o1")
    assert full["line_item_count"] == 3 and full["distinct_product_count"] == 2
    assert (full["total_quantity"], full["calculated_total_chf"]) == (D(6), D("80.00"))
    assert full["header_total_chf"] == D("100.00")
    empty = row(mart, order_id="o2")
    assert [empty[c] for c in mart.columns[10:]] == [0, D(0), D(0), 0]


def test_product_catalog(frames):
    mart = frames["mart_product_catalog"]
    assert mart.count() == 4 and len(mart.columns) == 19
    skis = row(mart, product_id="p1")
    assert skis["duty_amount_chf"] == D("0.50") and skis["vat_amount_chf"] == D("0.77")
    assert skis["total_landed_cost_chf"] == D("11.26")
    tea = row(mart, product_id="p3")
    assert tea["tariff_id"] is None and tea["total_landed_cost_chf"] is None


def test_shipment_tracking(frames):
    mart = frames["mart_shipment_tracking"]
    assert len(mart.columns) == 21
    assert row(mart, shipment_id="s1")["latest_event_type"] == "DELIVERED"
    assert row(mart, shipment_id="s3")["latest_notes"] == "tie"
    lost = row(mart, shipment_id="s2")
    assert lost["latest_event_type"] is None and lost["total_events"] is None


def test_merchant_overview(frames):
    mart = frames["mart_merchant_overview"]
    assert len(mart.columns) == 17
    first = row(mart, merchant_id="m1")
    assert first["total_net_amount_chf"] == D("147.00") and first["total_paid_amount_chf"] == D("98.00")
    assert (first["first_payout_period"], first["last_payout_period"]) == (date(2026, 1, 1), date(2026, 2, 28))
    none = row(mart, merchant_id="m2")
    assert none["payout_count"] == 0 and none["total_paid_amount_chf"] == 0
    assert none["first_payout_period"] is None


def test_transaction_summary(frames):
    mart = frames["mart_transaction_summary"]
    assert len(mart.columns) == 16
    rejected = row(mart, payment_id="x1")
    assert rejected["net_amount_chf"] == D("55.00") and rejected["has_processed_refund"] is False
    partly = row(mart, payment_id="x2")
    assert (partly["refund_count"], partly["has_processed_refund"]) == (2, True)
    assert partly["net_amount_chf"] == D("37.00")
    clean = row(mart, payment_id="x3")
    assert (clean["refund_count"], clean["net_amount_chf"]) == (0, D("40.50"))


def test_fulfillment_keeps_fan_out(frames):
    mart = frames["fulfillment_lifecycle"]
    assert len(mart.columns) == 18 and mart.count() == 6
    assert mart.filter("order_id = 'o1'").count() == 4
    days = {r.shipment_id: r.delivery_days for r in mart.select("shipment_id", "delivery_days").collect()}
    assert days == {"s1": 1, "s2": None, "s3": 3, None: None}


def test_customer_360(frames):
    mart = frames["customer_overview"]
    assert len(mart.columns) == 16
    assert mart.filter("customer_id = 'c1'").count() == 4
    third = row(mart, customer_id="c3")
    assert (third["total_orders"], third["total_order_value_chf"], third["is_merchant"]) == (0, 0, False)
    assert third["first_order_date"] is None
    assert row(mart, customer_id="c2")["total_order_value_chf"] == D("60.00")


def test_revenue_by_route_equals_the_joined_rows(frames, rows):
    mart = frames["revenue_by_route"]
    assert len(mart.columns) == 10
    route = row(mart, origin_warehouse="Basel", destination_city="Bern")
    assert (route["total_shipments"], route["total_orders"]) == (2, 1)
    assert (route["total_revenue_chf"], route["total_payments_chf"]) == (D("400.00"), D("200.00"))
    assert (route["total_refunds_chf"], route["net_revenue_chf"]) == (D("16.00"), D("184.00"))
    assert (route["avg_delivery_days"], route["avg_order_value_chf"]) == (1.0, D("100.000000"))


def _route_inputs(spark):
    orders = [("o1", D("10.00")), ("o1", D("3.00")), ("o2", None), ("o3", D("7.00")), (None, D("1.00"))]
    shipments = [
        ("s1", "o1", "A", "B", "2026-01-01", "2026-01-04"),
        ("s1", "o1", "A", "B", "2026-01-01", "2026-01-04"),
        ("s2", "o1", "A", "C", "2026-01-01", None),
        ("s3", "o2", "A", "B", "2026-01-01", "2026-01-02"),
        ("s4", "o3", None, "B", "2026-01-01", "2026-01-02"),
        ("s5", None, "A", "B", "2026-01-01", "2026-01-02"),
        ("s6", "o9", "A", "B", "2026-01-01", "2026-01-02"),
    ]
    payments = [
        ("o1", D("5.00"), D("1.00"), D("4.00")),
        ("o1", D("6.00"), D("0.00"), D("6.00")),
        ("o2", None, D("0.00"), None),
        ("o3", D("8.00"), D("0.00"), D("8.00")),
        (None, D("9.00"), D("0.00"), D("9.00")),
    ]
    return (
        spark.createDataFrame(orders, "order_id string, header_total_chf decimal(12,2)"),
        spark.createDataFrame(
            shipments,
            "shipment_id string, order_id string, origin_warehouse string, destination_city string, shipped_at string, delivered_at string",
        ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("shipped_at", "delivered_at")}),
        spark.createDataFrame(
            payments,
            "order_id string, amount_chf decimal(12,2), total_refund_amount_chf decimal(22,2), net_amount_chf decimal(23,2)",
        ),
    )


def test_revenue_by_route_against_brute_force(spark, rows):
    orders, shipments, payments = _route_inputs(spark)
    out = enterprise.revenue_by_route(orders, shipments, payments)
    for name, df in (("o", orders), ("s", shipments), ("t", payments)):
        df.createOrReplaceTempView(name)
    expected = spark.sql(
        """SELECT origin_warehouse, destination_city, count(DISTINCT shipment_id),
             count(DISTINCT o.order_id), CAST(sum(header_total_chf) AS DECIMAL(38,2)),
             CAST(sum(amount_chf) AS DECIMAL(38,2)),
             CAST(sum(total_refund_amount_chf) AS DECIMAL(38,2)),
             CAST(sum(net_amount_chf) AS DECIMAL(38,2)), avg(datediff(delivered_at, shipped_at)),
             CAST(avg(header_total_chf) AS DECIMAL(18,6))
           FROM s JOIN o ON s.order_id = o.order_id JOIN t ON t.order_id = o.order_id
           GROUP BY ALL"""
    )
    assert rows(out) == rows(expected)


def test_transaction_report(frames):
    mart = frames["transaction_report"]
    assert len(mart.columns) == 14
    # x1 and x2 meet two shipments and two primary contacts each, x5 has no order
    counts = {r.payment_id: r["count"] for r in mart.groupBy("payment_id").count().collect()}
    assert counts == {"x1": 4, "x2": 4, "x3": 2, "x4": 1}
    assert mart.filter("payment_id = 'x3'").first()["requires_customs"] is None


def test_checks_find_the_known_failures(frames, rows):
    report = check_all(frames)
    declared = sum(
        2 * len(c.key) + len(c.required) + len(c.accepted) + len(c.refs)
        for t, c in CHECKS.items()
        if t in frames
    )
    assert report.count() == declared
    failing = rows(report.filter("failures > 0"), "table_name", "check_name", "column_name")
    assert failing == [
        ("customer_overview", "unique", "customer_id"),
        ("mart_customer_overview", "unique", "customer_id"),
        ("mart_product_catalog", "unique", "product_id"),
    ]


def test_all_declared_checks_are_known():
    specs = CHECKS.values()
    assert sum(len(c.key) for c in specs) == 26
    assert sum(len(c.key) + len(c.required) for c in specs) == 61
    assert sum(len(c.accepted) for c in specs) == 14
    assert sum(len(c.refs) for c in specs) == 8


def test_inventory_comments_and_preview(spark, frames):
    catalog = Catalog(spark, "_test")
    listed = {r.table_name: r.row_count for r in catalog.inventory().collect()}
    assert listed["fulfillment_lifecycle"] == 6 and "payment" not in listed
    df = catalog.write(
        spark.range(3), "mart", "notes", "numbered", "it's a table", {"id": "a number"}
    )
    assert df.schema["id"].metadata["comment"] == "a number"
    about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED mart_notes_test.numbered").collect()}
    assert about["Comment"] == "it's a table"
    assert preview(df, 2).count() == 2 and row_count(df).first()[0] == 3


def test_partitioned_tables(spark, rows):
    catalog = Catalog(spark, "_test")
    df = spark.range(20).selectExpr("id", "id % 3 AS day")
    out = catalog.write(df, "mart", "days", "by_day", partition_by=["day"])
    assert rows(out, "id", "day") == rows(df)
    assert "PartitionFilters: [isnotnull(day" in out.filter("day = 1")._jdf.queryExecution().toString()


# Metrics ------------------------------------------------------------------


def test_metrics_with_and_without_fan_out(frames):
    mart = frames["fulfillment_lifecycle"]
    names = ["revenue", "Zahlungsvolumen", "order_count", "shipment_count", "avg_delivery_days"]
    plain = metrics.metric_query(metrics.FULFILLMENT, mart, names).first()
    assert tuple(plain) == (D("500.50"), D("300.50"), 3, 3, 5 / 3)
    once = metrics.metric_query(metrics.FULFILLMENT, mart, names, guard_fanout=True).first()
    assert tuple(once) == (D("200.50"), D("200.50"), 3, 3, 2.0)


def test_guard_keeps_groups_without_ids(frames, rows):
    out = metrics.metric_query(
        metrics.FULFILLMENT,
        frames["fulfillment_lifecycle"],
        ["shipment_count", "avg_delivery_days"],
        ["warehouse"],
        guard_fanout=True,
    )
    assert rows(out) == [(None, 0, None), ("Basel", 2, 1.0), ("Bern", 1, 3.0)]


def test_metric_filters_order_and_limit(frames):
    out = metrics.metric_query(
        metrics.COMPLIANCE,
        frames["transaction_report"],
        ["AML count", "Anzahl Transaktionen"],
        ["Firmenname"],
        where=F.col("amount_chf") > 1,
        order_by=[F.desc("aml_flagged_count"), F.asc("company_name")],
        limit=1,
    )
    assert [tuple(r) for r in out.collect()] == [("Alpen AG", 4, 10)]


def test_names_and_synonyms(spark):
    assert metrics.resolve(metrics.REVENUE, "AVERAGE DELIVERY TIME", "fact") == "avg_delivery_days"
    with pytest.raises(KeyError):
        metrics.resolve(metrics.REVENUE, "average delivery time", "metric")
    assert metrics.find_view("strecken") is metrics.REVENUE
    with pytest.raises(KeyError):
        metrics.find_view("weather")
    shape = {
        view.name: (len(view.facts), len(view.dimensions), len(view.metrics))
        for view in metrics.VIEWS.values()
    }
    assert shape == {
        "fulfillment_analytics": (4, 14, 5),
        "revenue_analytics": (8, 2, 3),
        "compliance_analytics": (1, 13, 5),
    }
    assert metrics.describe(spark, metrics.REVENUE).count() == 13


# Reports ------------------------------------------------------------------


def test_compliance_reports(frames, rows):
    report = frames["transaction_report"]
    assert tuple(reports.compliance_kpis(report).first()) == (11, 5, 5 / 11 * 100, 8, 4)
    assert tuple(reports.customs_declared_or_missing(report).first()) == (8, 11, 4, 4)
    assert tuple(reports.international_and_domestic(report).first()) == (4, 5, D("240.00"), D("220.00"))
    assert rows(reports.risk_by_company(report), "company_name", "aml_flags") == [("Alpen AG", 4), ("Berg GmbH", 1)]
    empty = report.limit(0)
    assert tuple(reports.aml_share(empty).first()) == (0, 0, 0.0, D(0))


def test_listings(frames, rows):
    assert rows(reports.customers_in_city(frames["mart_customer_overview"], "Basel"), "primary_contact_first_name") == [("Abe",), ("Ann",)]
    moving = reports.recently_moving_vehicles(frames["mart_fleet_status"]).collect()
    assert [r.plate_number for r in moving] == ["ZH 2"]
    assert [tuple(r) for r in reports.open_shipments_by_origin(frames["mart_shipment_tracking"]).collect()] == [("Basel", 1)]
    routes = reports.routes_by_revenue(frames["revenue_by_route"]).collect()
    assert [r.origin_warehouse for r in routes] == ["Basel", "Bern"]


def test_usage(spark, rows):
    df = spark.createDataFrame(
        [("ab", "2026-01-07 00:00:00", 1), ("ab", "2026-01-02 00:00:00", 2), ("ac", "2025-12-01 00:00:00", 4), ("x", "2026-01-07 00:00:00", 8)],
        "name string, t string, used int",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = reports.usage_last_days(df, "name", "t", "used", datetime(2026, 1, 8), prefix="a")
    assert rows(out) == [("ab", 3)]


# Feeds --------------------------------------------------------------------

CONNECTION = """{"connections":[
  {"from":{"departure":"2026-01-05T10:02:00+0100","station":{"name":"Bern","coordinate":{"x":46.9,"y":7.4}},"delay":3,"platform":"7"},
   "to":{"station":{"name":"Basel"}},"duration":"00d00:56:00","products":["IC 6","S1"],
   "sections":[{"journey":{"operator":"OP","category":"IC"}},{"journey":null}]},
  {"from":{"departure":"2026-07-05T23:30:00+0200","station":{"name":null},"delay":null},"sections":[]}]}"""
BOARD = """{"results":[
  {"fahrt_bezeichner":"f1","haltestellen_name":"Bern","linien_text":"S1","produkt_id":"Zug","abfahrtszeit":"2026-01-05T10:00:59","ab_prognose":"2026-01-05T10:01:00","abfahrtsverspatung":true},
  {"fahrt_bezeichner":"f2","haltestellen_name":"Bern","linien_text":"S1","abfahrtszeit":"2026-01-05T10:00:00","ab_prognose":"2026-01-05T10:09:00","abfahrtsverspatung":false},
  {"fahrt_bezeichner":"f3","haltestellen_name":"Bern","abfahrtszeit":"2026-01-05T10:00:00","abfahrtsverspatung":true}]}"""
STATIONS = """{"features":[
  {"id":"abc","properties":{"title":"Abc","datetime":"2026-01-05T10:00:00"},"geometry":{"coordinates":[7.4,46.9]},"assets":{"a":{},"b":{}}},
  {"id":"abc","properties":{"title":"Abc","datetime":"2026-01-05T11:00:00"},"geometry":{"coordinates":[7.4,46.9]}}]}"""


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "v string").select(F.parse_json("v").alias("RAW"))


def test_rail_overview(spark, rows):
    links = stg_transport_connections(raw(spark, CONNECTION))
    board = stg_sbb_stationboard(raw(spark, BOARD))
    assert len(links.columns) == 11 and len(board.columns) == 16
    rail = mart_swiss_rail_overview(links, board)
    got = rows(rail, "departure", "station_name", "line_text", "product", "delay_minutes", "data_source")
    assert got == [
        (datetime(2026, 1, 5, 10, 0), "Bern", None, None, 0, "sbb_stationboard"),
        (datetime(2026, 1, 5, 10, 0), "Bern", "S1", None, 0, "sbb_stationboard"),
        (datetime(2026, 1, 5, 10, 0, 59), "Bern", "S1", "Zug", 1, "sbb_stationboard"),
        (datetime(2026, 1, 5, 10, 2), "Bern", "IC 6", "IC", 3, "transport_opendata"),
        (datetime(2026, 7, 5, 23, 30), None, None, None, None, "transport_opendata"),
    ]


def test_lenient_departure(spark, rows):
    bad = raw(spark, CONNECTION.replace("2026-01-05T10:02:00+0100", "soon"))
    assert rows(stg_transport_connections(bad, strict=False), "departure") == [
        (None,),
        (datetime(2026, 7, 5, 23, 30),),
    ]


def test_weather_catalogue(spark, rows):
    stations = stg_meteoswiss_stations(raw(spark, STATIONS))
    mart = mart_weather_station_catalog(stations)
    assert mart.columns == ["station_id", "station_name", "latitude", "longitude", "last_update", "num_assets"]
    assert rows(mart, "latitude", "longitude", "num_assets") == [(46.9, 7.4, None), (46.9, 7.4, 2)]
    latest = mart_weather_station_catalog(stations, latest_only=True)
    assert rows(latest, "station_id", "num_assets") == [("abc", None)]


def test_feed_marts_are_written(spark):
    feeds = {
        "transport_connections": raw(spark, CONNECTION),
        "sbb_stationboard": raw(spark, BOARD),
        "meteoswiss_measurements": raw(spark, STATIONS),
    }
    marts = build_feeds(Catalog(spark, "_test"), feeds)
    assert {name: df.count() for name, df in marts.items()} == {
        "mart_swiss_rail_overview": 5,
        "mart_weather_station_catalog": 2,
    }


def test_seeds_of_the_full_build_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """All tables are built; the CSV text between the tables and them is small, its files are many."""
    monkeypatch.setattr(standins, "SEED_ROWS", 10)
    d = Standins(spark, str(tmp_path / "none"))
    rows = {
        table: spark.range(25).select(*[F.lit(None).cast("string").alias(c) for c, _ in seed_columns(table)])
        for table in SEEDS
    }
    key = F.expr("concat('Zug, \"', id, '\"')")
    rows["order_header"] = spark.range(25).select(
        key.alias("order_id"),
        *[F.lit(None).cast("string").alias(c) for c, _ in seed_columns("order_header")[1:]],
    )
    for table in SEEDS:
        setattr(d, f"raw_{table}", lambda t=table: rows[t].coalesce(1))
    catalog, built = d.built()
    assert len({r.order_id for r in built["stg_order_header"].collect()}) == 25
    assert set(DOMAIN_MARTS) | set(ENTERPRISE_MARTS) <= set(built)
    files = [f for f in spark.read.text(f"{catalog.location}/seeds/order_header.csv").inputFiles()]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
