"""Domain marts: customers, fleet, locations, orders, products, shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.money import landed_cost, percent_of, zero_if_null
from martlane.operators.aggregates import count_true, pivot_sums
from martlane.operators.joins import HOT_ROWS, Side, gathered, star_join
from martlane.operators.latest import latest_per_key
from martlane.sources.schemas import ZONE_TYPES


def mart_customer_overview(
    business_customer: DataFrame, customer_contact: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """Customers with their primary contacts; several primaries repeat the customer.

    ``heavy`` is the stored list of customers with very many contacts.
    """
    renamed = {
        "contact_id": "primary_contact_id",
        "first_name": "primary_contact_first_name",
        "last_name": "primary_contact_last_name",
        "role": "primary_contact_role",
        "email": "primary_contact_email",
        "phone": "primary_contact_phone",
    }
    primary = customer_contact.filter("is_primary").select(
        "customer_id", *[F.col(old).alias(new) for old, new in renamed.items()]
    )
    customers = business_customer.drop("contact_name", "contact_email", "phone")
    return star_join(
        customers,
        "customer_id",
        [Side(primary, spread=["primary_contact_id"], heavy=heavy)],
        spread=["customer_id"],
    ).select(*customers.columns, *renamed.values())


def mart_fleet_status(vehicle: DataFrame, gps_position: DataFrame) -> DataFrame:
    """Vehicles with their latest position and number of positions (NULL if none)."""
    measured = ["recorded_at", "latitude", "longitude", "speed_kmh", "heading_degrees", "is_moving"]
    latest = latest_per_key(
        gps_position,
        ["vehicle_id"],
        "recorded_at",
        {name: f"latest_{name}" for name in measured},
        tiebreak=["position_id"],
        count_as="total_positions",
    )
    return vehicle.join(latest, "vehicle_id", "left")


def mart_warehouse_capacity(warehouse: DataFrame, warehouse_zone: DataFrame) -> DataFrame:
    """Warehouses with zone totals; a warehouse without zones keeps NULLs."""
    per_type = {z: f"{z.lower()}_capacity_pallets" for z in ZONE_TYPES}
    zones = warehouse_zone.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("total_zones"),
        F.sum("capacity_pallets").alias("total_zone_capacity_pallets"),
        count_true("temperature_controlled").alias("temp_controlled_zones"),
        *pivot_sums("zone_type", "capacity_pallets", per_type),
    )
    named = warehouse.withColumnRenamed("capacity_pallets", "warehouse_capacity_pallets")
    return named.join(zones, "warehouse_id", "left")


def mart_order_summary(
    order_header: DataFrame,
    order_line_item: DataFrame,
    heavy: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Orders with line totals; an order without lines has zeros.

    ``heavy`` is the stored list of orders with very many lines.
    """
    of_order = order_line_item.select("order_id", "product_id", "quantity", "line_total_chf")
    lines = gathered(of_order, "order_id", heavy, hot_rows).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total_chf").alias("calculated_total_chf"),
        F.count_distinct("product_id").alias("distinct_product_count"),
    )
    totals = [c for c in lines.columns if c != "order_id"]
    head = [c for c in order_header.columns if c != "total_amount_chf"]
    return order_header.join(lines, "order_id", "left").select(
        *head,
        F.col("total_amount_chf").alias("header_total_chf"),
        *[zero_if_null(c).alias(c) for c in totals],
    )


def mart_product_catalog(
    product: DataFrame, product_tariff: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """Products with tariff, duty, VAT and landed cost; NULL without a tariff.

    ``heavy`` is the stored list of products with very many tariffs.
    """
    tariffs = product_tariff.withColumnRenamed("description", "tariff_description")
    own = [c for c in product.columns if c != "hs_tariff_code"]
    rates = [c for c in tariffs.columns if c != "product_id"]
    joined = star_join(
        product.select(*own),
        "product_id",
        [Side(tariffs, spread=["tariff_id"], heavy=heavy)],
        spread=["product_id"],
    )
    price, duty, vat = F.col("unit_price_chf"), F.col("duty_rate_pct"), F.col("vat_rate_pct")
    return joined.select(
        *own,
        *rates,
        percent_of(price, duty).alias("duty_amount_chf"),
        percent_of(price, vat).alias("vat_amount_chf"),
        landed_cost(price, vat, duty).alias("total_landed_cost_chf"),
    )


def mart_shipment_tracking(shipment: DataFrame, tracking_event: DataFrame) -> DataFrame:
    """Shipments with their latest event and number of events (NULL if none)."""
    latest = latest_per_key(
        tracking_event,
        ["shipment_id"],
        "event_timestamp",
        {
            "event_type": "latest_event_type",
            "event_timestamp": "latest_event_timestamp",
            "location_name": "latest_location",
            "latitude": "latest_latitude",
            "longitude": "latest_longitude",
            "notes": "latest_notes",
        },
        tiebreak=["event_id"],
        count_as="total_events",
    )
    return shipment.join(latest, "shipment_id", "left")
