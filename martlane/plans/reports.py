"""Named queries on the marts: listings, dashboards and notebook summaries.

Every report aggregates the whole mart. Sorting puts NULL first on descending
columns, as the source system does, and ends with an id so that the rows of a
top-k list do not depend on the run.

Fixed values: the reports' output columns, thresholds and row limits.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.functions.dates import since_days
from martlane.functions.money import percent_share
from martlane.operators.rank import ranked
from martlane.operators.aggregates import count_true, top_k, value_counts


def _down(column: str) -> Column:
    return F.desc_nulls_first(column)


def _up(column: str) -> Column:
    return F.asc_nulls_last(column)


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(_rows(name)).orderBy(_down(name), _up(column))


# Listings -----------------------------------------------------------------


def active_customers_by_canton(customers: DataFrame) -> DataFrame:
    return _count_by(customers.filter("is_active"), "canton", "customer_count")


def customers_in_city(customers: DataFrame, city: str, k: int = 50) -> DataFrame:
    found = customers.filter((F.col("city") == city) & F.col("is_active"))
    contact = [f"primary_contact_{part}" for part in ("first_name", "last_name", "email")]
    order = [_up("company_name"), _up("customer_id"), _up("primary_contact_id")]
    return top_k(found, order, k).select("company_name", *contact)


def active_vehicles_by_home_base(fleet: DataFrame) -> DataFrame:
    return _count_by(fleet.filter("is_active"), "home_base", "vehicle_count")


def recently_moving_vehicles(fleet: DataFrame, k: int = 50) -> DataFrame:
    moving = fleet.filter("latest_is_moving")
    return top_k(moving, [_down("latest_recorded_at"), _up("vehicle_id")], k).select(
        "plate_number", "home_base", "latest_speed_kmh", "latest_recorded_at"
    )


def active_warehouses_by_canton(warehouses: DataFrame) -> DataFrame:
    return _count_by(warehouses.filter("is_active"), "canton", "warehouse_count")


def cold_capacity(warehouses: DataFrame, k: int = 30) -> DataFrame:
    cold = warehouses.filter(F.col("cold_capacity_pallets") > 0)
    return top_k(cold, [_down("cold_capacity_pallets"), _up("warehouse_id")], k).select(
        "warehouse_name", "city", "cold_capacity_pallets", "temp_controlled_zones"
    )


def average_delay_by_line(rail: DataFrame, k: int = 20) -> DataFrame:
    late = rail.filter(F.col("delay_minutes") > 0).groupBy("line_text")
    return top_k(
        late.agg(_rows("departures"), F.round(F.avg("delay_minutes"), 2).alias("avg_delay_min")),
        [_down("avg_delay_min"), _up("line_text")],
        k,
    )


def departures_by_source(rail: DataFrame) -> DataFrame:
    return _count_by(rail, "data_source", "row_count")


def order_totals_by_status(orders: DataFrame) -> DataFrame:
    revenue = F.round(F.sum("calculated_total_chf"), 2).alias("revenue_chf")
    return orders.groupBy("status").agg(_rows("orders"), revenue).orderBy(_down("revenue_chf"))


def largest_orders_by_lines(orders: DataFrame, k: int = 25) -> DataFrame:
    return top_k(
        orders.select("order_id", "customer_id", "line_item_count", "calculated_total_chf"),
        [_down("line_item_count"), _up("order_id")],
        k,
    )


def products_needing_customs(products: DataFrame, k: int = 50) -> DataFrame:
    declared = products.filter("requires_customs_declaration")
    return top_k(declared, [_up("product_name"), _up("product_id"), _up("tariff_id")], k).select(
        "product_id", "product_name", "hs_code", "origin_country"
    )


def average_landed_cost_by_category(products: DataFrame) -> DataFrame:
    mean = F.round(F.avg("total_landed_cost_chf"), 2).alias("avg_landed_chf")
    return products.groupBy("category").agg(mean).orderBy(_down("avg_landed_chf"))


def shipments_needing_customs(shipments: DataFrame, k: int = 100) -> DataFrame:
    held = shipments.filter("requires_customs")
    return top_k(held, [_down("created_at"), _up("shipment_id")], k).select(
        "shipment_id", "destination_city", "status", "customs_declaration_id"
    )


def open_shipments_by_origin(shipments: DataFrame) -> DataFrame:
    under_way = shipments.filter(F.col("delivered_at").isNull())
    return _count_by(under_way, "origin_warehouse", "open_shipments")


def top_merchants_by_gross(merchants: DataFrame, k: int = 20) -> DataFrame:
    active = merchants.filter("is_active")
    return top_k(active, [_down("total_gross_amount_chf"), _up("merchant_id")], k).select(
        "merchant_name", "business_type", "total_gross_amount_chf", "total_net_amount_chf"
    )


def merchants_by_type(merchants: DataFrame) -> DataFrame:
    return _count_by(merchants.filter("is_active"), "business_type", "merchant_count")


def volume_by_payment_method(transactions: DataFrame) -> DataFrame:
    net = F.round(F.sum("net_amount_chf"), 2).alias("net_chf")
    return transactions.groupBy("payment_method").agg(_rows("payments"), net).orderBy(_down("net_chf"))


def payments_for_aml_review(transactions: DataFrame, k: int = 50) -> DataFrame:
    flagged = transactions.filter("requires_aml_check")
    return top_k(flagged, [_down("created_at"), _up("payment_id")], k).select(
        "payment_id", "merchant_id", "amount_chf", "status", "created_at"
    )


# Open data ----------------------------------------------------------------


def station_coverage(stations: DataFrame) -> DataFrame:
    return stations.agg(
        _rows("station_count"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
    )


def most_delayed_lines(rail: DataFrame, k: int = 10) -> DataFrame:
    line = ["line_text", "product", "operator"]
    late = rail.filter(F.col("delay_minutes") > 0).groupBy(*line)
    means = late.agg(F.avg("delay_minutes").alias("avg_delay"), _rows("departures"))
    return top_k(means, [_down("avg_delay"), *[_up(c) for c in line]], k)


def stations_with_most_assets(stations: DataFrame, k: int = 10) -> DataFrame:
    order = [_down("num_assets"), _up("station_id"), _down("last_update")]
    return top_k(stations, order, k).select("station_name", "latitude", "longitude", "num_assets")


# Dashboards ---------------------------------------------------------------


def fulfillment_kpis(fulfillment: DataFrame) -> DataFrame:
    return fulfillment.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("shipment_id").alias("total_shipments"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.sum("order_total_chf").alias("total_revenue_chf"),
    )


def order_status_distribution(fulfillment: DataFrame) -> DataFrame:
    return value_counts(fulfillment, "order_status")


def revenue_by_warehouse(fulfillment: DataFrame) -> DataFrame:
    known = fulfillment.filter(F.col("origin_warehouse").isNotNull())
    return known.groupBy("origin_warehouse").agg(F.sum("order_total_chf").alias("order_total_chf"))


def revenue_kpis(routes: DataFrame) -> DataFrame:
    return routes.agg(
        F.sum("total_revenue_chf").alias("total_revenue_chf"),
        F.sum("total_shipments").alias("total_shipments"),
        F.avg("avg_order_value_chf").alias("avg_order_value_chf"),
    )


def routes_by_revenue(routes: DataFrame) -> DataFrame:
    return routes.orderBy(_down("total_revenue_chf"), _up("origin_warehouse"), _up("destination_city"))


def routes_ranked(routes: DataFrame) -> DataFrame:
    """Routes with their rank by revenue; unknown revenue comes first, equal ones share a rank."""
    by = {"total_revenue_chf": _down("total_revenue_chf")}
    return ranked(routes.select("origin_warehouse", "destination_city", "total_revenue_chf"), by)


def orders_ranked_by_lines(orders: DataFrame) -> DataFrame:
    """All orders by number of lines: the rank that equal ones share, and a place of their own."""
    lines = orders.select("order_id", "line_item_count")
    by = {"line_item_count": _down("line_item_count")}
    return ranked(ranked(lines, by), by, "place", tiebreak=[_up("order_id")])


def products_ranked_by_duty(products: DataFrame) -> DataFrame:
    """Products and tariffs by duty within a dense rank; those without a tariff come first."""
    duty = products.select("product_id", "tariff_id", "category", "duty_rate_pct")
    by = {"duty_rate_pct": _down("duty_rate_pct"), "category": _up("category")}
    return ranked(duty, by, dense=True)


def revenue_against_delivery_time(routes: DataFrame) -> DataFrame:
    return routes.select("destination_city", "avg_delivery_days", "total_revenue_chf", "total_shipments")


def compliance_kpis(report: DataFrame) -> DataFrame:
    aml, total = count_true("requires_aml_check"), F.count(F.lit(1))
    return report.agg(
        total.alias("total_transactions"),
        aml.alias("aml_flagged"),
        percent_share(aml, total).alias("aml_percent"),
        count_true("requires_customs").alias("customs_required"),
        count_true("is_international").alias("international"),
    )


def volume_by_method(report: DataFrame) -> DataFrame:
    known = report.filter(F.col("payment_method").isNotNull())
    return known.groupBy("payment_method").agg(
        F.sum("amount_chf").alias("total_chf"), F.count("amount_chf").alias("n")
    )


def aml_transactions(report: DataFrame) -> DataFrame:
    return report.filter("requires_aml_check")


def customs_transactions(report: DataFrame) -> DataFrame:
    return report.filter("requires_customs")


# Notebooks ----------------------------------------------------------------


def aml_share(report: DataFrame) -> DataFrame:
    aml, total = count_true("requires_aml_check"), F.count(F.lit(1))
    flagged = F.sum(F.when(F.col("requires_aml_check"), F.col("amount_chf")))
    return report.agg(
        aml.alias("aml_count"),
        total.alias("total_count"),
        percent_share(aml, total).alias("aml_percent"),
        F.coalesce(flagged, F.lit(0)).alias("flagged_amount_chf"),
    )


def aml_methods(report: DataFrame) -> DataFrame:
    return value_counts(aml_transactions(report), "payment_method")


def customs_declared_or_missing(report: DataFrame) -> DataFrame:
    customs = count_true("requires_customs")
    declared = count_true(F.col("requires_customs") & F.col("customs_declaration_id").isNotNull())
    return report.agg(
        customs.alias("customs_required"),
        F.count(F.lit(1)).alias("total_count"),
        declared.alias("with_declaration"),
        (customs - declared).alias("missing_declaration"),
    )


def international_and_domestic(report: DataFrame) -> DataFrame:
    abroad = F.col("is_international")

    def volume(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("amount_chf"))), F.lit(0))

    return report.agg(
        count_true(abroad).alias("international_count"),
        count_true(~abroad).alias("domestic_count"),
        volume(abroad).alias("international_chf"),
        volume(~abroad).alias("domestic_chf"),
    )


def risk_by_company(report: DataFrame, k: int = 20) -> DataFrame:
    companies = report.filter(F.col("company_name").isNotNull()).groupBy("company_name")
    risk = companies.agg(
        F.count("payment_id").alias("total_txn"),
        F.sum("amount_chf").alias("total_chf"),
        count_true("requires_aml_check").alias("aml_flags"),
        count_true("requires_customs").alias("customs_req"),
        count_true("is_international").alias("international"),
    )
    return top_k(risk, [_down("aml_flags"), _up("company_name")], k)


# Administration -----------------------------------------------------------


def usage_last_days(
    usage: DataFrame, name: str, ts: str, amount: str, now: datetime | Column, days: int = 7, prefix: str = ""
) -> DataFrame:
    """Usage per name in the ``days`` days before ``now``, highest first."""
    until = now if isinstance(now, Column) else F.lit(now)
    recent = usage.filter(since_days(F.col(ts), until.cast("timestamp_ntz"), days))
    if prefix:
        recent = recent.filter(F.col(name).startswith(prefix))
    return recent.groupBy(name).agg(F.sum(amount).alias("used")).orderBy(_down("used"), _up(name))
