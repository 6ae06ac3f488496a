"""Building the layers: seeds to staging, domain marts, enterprise marts, checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from martlane.operators.checks import run_checks
from martlane.plans import enterprise, feeds, logistics, payments, staging
from martlane.sources.schemas import CHECKS, SEED_PRODUCT, SEEDS
from martlane.sources.seeds import read_seed
from martlane.sources.tables import Catalog

# Domain marts: data product, staging inputs, builder.
DOMAIN_MARTS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {
    "mart_customer_overview": (
        "customers",
        ("business_customer", "customer_contact"),
        logistics.mart_customer_overview,
    ),
    "mart_fleet_status": ("fleet", ("vehicle", "gps_position"), logistics.mart_fleet_status),
    "mart_warehouse_capacity": (
        "locations",
        ("warehouse", "warehouse_zone"),
        logistics.mart_warehouse_capacity,
    ),
    "mart_order_summary": (
        "orders",
        ("order_header", "order_line_item"),
        logistics.mart_order_summary,
    ),
    "mart_product_catalog": (
        "products",
        ("product", "product_tariff"),
        logistics.mart_product_catalog,
    ),
    "mart_shipment_tracking": (
        "shipments",
        ("shipment", "tracking_event"),
        logistics.mart_shipment_tracking,
    ),
    "mart_merchant_overview": (
        "merchants",
        ("merchant_account", "payout"),
        payments.mart_merchant_overview,
    ),
    "mart_transaction_summary": (
        "transactions",
        ("payment", "refund"),
        payments.mart_transaction_summary,
    ),
}

# Enterprise marts: data product, domain mart inputs, builder.
ENTERPRISE_MARTS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {
    "fulfillment_lifecycle": (
        "fulfillment",
        ("mart_order_summary", "mart_shipment_tracking", "mart_transaction_summary"),
        enterprise.fulfillment_lifecycle,
    ),
    "customer_overview": (
        "customer_360",
        ("mart_customer_overview", "mart_order_summary", "mart_merchant_overview"),
        enterprise.customer_overview,
    ),
    "revenue_by_route": (
        "revenue_analytics",
        ("mart_order_summary", "mart_shipment_tracking", "mart_transaction_summary"),
        enterprise.revenue_by_route,
    ),
    "transaction_report": (
        "compliance",
        (
            "mart_transaction_summary",
            "mart_order_summary",
            "mart_shipment_tracking",
            "mart_customer_overview",
        ),
        enterprise.transaction_report,
    ),
}

# Keys that enterprise marts join domain marts on, where a key can repeat: mart, key, and the
# name under which the builders take the list of heavy keys.
HEAVY = {
    "mart_shipment_tracking": ("order_id", "shipments"),
    "mart_transaction_summary": ("order_id", "transactions"),
    "mart_merchant_overview": ("customer_id", "merchants"),
    "mart_customer_overview": ("customer_id", "customers"),
}

# The same for seed tables that a domain mart counts distinct values of: table, key and mart.
HEAVY_RAW = {"order_line_item": ("order_id", "mart_order_summary")}

# Feed marts: raw feeds with their product, staging, mart and its product.
FEED_STAGING = {
    "transport_connections": ("stg_transport_connections", staging.stg_transport_connections),
    "sbb_stationboard": ("stg_sbb_stationboard", staging.stg_sbb_stationboard),
    "meteoswiss_measurements": ("stg_meteoswiss_stations", staging.stg_meteoswiss_stations),
}


def load_seeds(catalog: Catalog, folder: str) -> None:
    """Seed files into raw tables, all columns text."""
    for table in SEEDS:
        raw = read_seed(catalog.spark, folder, table)
        catalog.write(raw, "raw", SEED_PRODUCT[table], table, sort_by=raw.columns[:1])
    for table, (key, _) in HEAVY_RAW.items():
        catalog.write_heavy("raw", SEED_PRODUCT[table], table, key)


def staged(catalog: Catalog) -> dict[str, DataFrame]:
    """Typed views over the raw seed tables."""
    frames = {}
    for table in SEEDS:
        raw = catalog.read("raw", SEED_PRODUCT[table], table)
        frames[table] = catalog.view(staging.stage(raw, table), f"stg_{table}")
    return frames


def build_domain(catalog: Catalog, stages: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Domain marts as tables, read back, with the heavy keys of those that are joined on one."""
    heavy = {
        mart: catalog.heavy("raw", SEED_PRODUCT[table], table, key)
        for table, (key, mart) in HEAVY_RAW.items()
    }
    marts = {}
    for name, (product, inputs, builder) in DOMAIN_MARTS.items():
        options = {"heavy": heavy[name]} if name in heavy else {}
        df = builder(*[stages[i] for i in inputs], **options)
        marts[name] = catalog.write(df, "mart", product, name)
    for name, (key, _) in HEAVY.items():
        catalog.write_heavy("mart", DOMAIN_MARTS[name][0], name, key)
    return marts


def build_enterprise(catalog: Catalog, marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Enterprise marts as tables, read from the tables of the domain marts and their heavy keys."""
    heavy = {}
    for name, (key, part) in HEAVY.items():
        found = catalog.heavy("mart", DOMAIN_MARTS[name][0], name, key)
        if found is not None:
            heavy[part] = found
    built = {}
    for name, (product, inputs, builder) in ENTERPRISE_MARTS.items():
        df = builder(*[marts[i] for i in inputs], heavy=heavy)
        built[name] = catalog.write(df, "mart", product, name)
    return built


def build_feeds(catalog: Catalog, raw: Mapping[str, DataFrame], latest_only: bool = False) -> dict[str, DataFrame]:
    """Rail and weather marts from raw VARIANT tables."""
    flat = {
        name: catalog.view(flattener(raw[feed]), name)
        for feed, (name, flattener) in FEED_STAGING.items()
    }
    rail = feeds.mart_swiss_rail_overview(
        flat["stg_transport_connections"], flat["stg_sbb_stationboard"]
    )
    weather = feeds.mart_weather_station_catalog(flat["stg_meteoswiss_stations"], latest_only)
    return {
        "mart_swiss_rail_overview": catalog.write(
            rail, "mart", "open_transport", "mart_swiss_rail_overview"
        ),
        "mart_weather_station_catalog": catalog.write(
            weather, "mart", "weather", "mart_weather_station_catalog"
        ),
    }


def check_all(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The report of all declared checks of the given tables, by table name."""
    reports = [
        run_checks(frames[table], table, spec, frames.__getitem__)
        for table, spec in CHECKS.items()
        if table in frames
    ]
    return reduce(DataFrame.unionByName, reports)


def build_all(catalog: Catalog, seed_folder: str) -> dict[str, DataFrame]:
    """Seeds, staging, domain and enterprise marts; returns all frames by table name."""
    load_seeds(catalog, seed_folder)
    stages = staged(catalog)
    domain = build_domain(catalog, stages)
    marts = {**domain, **build_enterprise(catalog, domain)}
    return {**{f"stg_{name}": df for name, df in stages.items()}, **marts}
