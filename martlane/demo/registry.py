"""Registered queries: the library on the stand-in tables, with DuckDB SQL beside it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.demo import streams
from martlane.demo.oracle import seed_spec, shown, sql
from martlane.demo.standins import Standins
from martlane.functions import masks
from martlane.functions.dates import days_between, minutes_between
from martlane.operators import checks, policies
from martlane.operators.flatten import flatten, object_size
from martlane.operators.latest import latest_per_key
from martlane.plans import metrics, reports
from martlane.plans.build import DOMAIN_MARTS, ENTERPRISE_MARTS
from martlane.plans.feeds import mart_weather_station_catalog
from martlane.sources.schemas import CHECKS, SEEDS, TableChecks
from martlane.sources.tables import row_count
from martlane.streaming.catalogue import with_first_link

VISITOR = "DP_VISITOR"
OFFICER = "COMPLIANCE_OFFICER"


@dataclass(frozen=True)
class Query:
    build: Callable[[Standins], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, Query] = {}


def add(name: str, build: Callable[[Standins], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = Query(build, None if oracle is None else sql(oracle))


def present(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, so both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return present(QUERIES[name].build(Standins(spark, folder)))


# Staging ------------------------------------------------------------------

for _table in SEEDS:
    add(
        f"stg_{_table}",
        lambda d, t=_table: d.stg(t),
        f"SELECT {shown(seed_spec(_table))} FROM {_table}",
    )

CONNECTIONS = (
    "departure:t from_station from_latitude from_longitude to_station duration product operator "
    "category delay_minutes platform"
)
STATIONBOARD = (
    "fahrt_bezeichner station_name line_text product scheduled_departure:t scheduled_arrival:t "
    "forecast_departure:t forecast_arrival:t has_departure_delay has_arrival_delay is_cancelled "
    "operator_name operating_day official_name bpuic transport_type"
)
STATIONS = "station_id station_name last_update:t longitude latitude num_assets"

add(
    "stg_transport_connections",
    lambda d: d.connections,
    f"SELECT {shown(CONNECTIONS)} FROM flat_connections",
)
add(
    "stg_sbb_stationboard",
    lambda d: d.stationboard,
    f"SELECT {shown(STATIONBOARD)} FROM flat_stationboard",
)
add("stg_meteoswiss_stations", lambda d: d.stations, f"SELECT {shown(STATIONS)} FROM flat_stations")

# Marts --------------------------------------------------------------------

MARTS = {
    "mart_customer_overview": (
        "customers",
        "customer_id company_name legal_form street postal_code city canton country is_active "
        "created_at:d primary_contact_id primary_contact_first_name primary_contact_last_name "
        "primary_contact_role primary_contact_email primary_contact_phone",
    ),
    "mart_fleet_status": (
        "fleet",
        "vehicle_id plate_number vehicle_type make model year capacity_kg capacity_m3 fuel_type "
        "home_base is_active last_service_date:d latest_recorded_at:t latest_latitude "
        "latest_longitude latest_speed_kmh latest_heading_degrees latest_is_moving total_positions",
    ),
    "mart_warehouse_capacity": (
        "warehouses",
        "warehouse_id warehouse_name street postal_code city canton latitude longitude "
        "warehouse_capacity_pallets is_active total_zones total_zone_capacity_pallets:i "
        "temp_controlled_zones storage_capacity_pallets:i cold_capacity_pallets:i "
        "hazmat_capacity_pallets:i receiving_capacity_pallets:i loading_capacity_pallets:i "
        "returns_capacity_pallets:i",
    ),
    "mart_order_summary": (
        "order_totals",
        "order_id customer_id order_date:d status delivery_street delivery_postal_code "
        "delivery_city currency warehouse_origin header_total_chf:n line_item_count "
        "total_quantity:n calculated_total_chf:n distinct_product_count",
    ),
    "mart_product_catalog": (
        "products",
        "product_id product_name category weight_kg:n unit_price_chf:n currency origin_country "
        "is_hazardous requires_customs_declaration created_at:d tariff_id hs_code "
        "tariff_description duty_rate_pct:n vat_rate_pct:n preferential_rate_pct:n "
        "duty_amount_chf:n vat_amount_chf:n total_landed_cost_chf:n",
    ),
    "mart_shipment_tracking": (
        "shipments",
        "shipment_id order_id vehicle_id origin_warehouse destination_city "
        "destination_postal_code status created_at:t shipped_at:t delivered_at:t weight_kg "
        "volume_m3 requires_customs customs_declaration_id latest_event_type "
        "latest_event_timestamp:t latest_location latest_latitude latest_longitude latest_notes "
        "total_events",
    ),
    "mart_merchant_overview": (
        "merchants",
        "merchant_id merchant_name business_type registration_number bank_account_iban "
        "settlement_currency fee_rate_pct:n customer_id is_active onboarded_at:d payout_count "
        "total_gross_amount_chf:n total_fee_amount_chf:n total_net_amount_chf:n "
        "total_paid_amount_chf:n first_payout_period:d last_payout_period:d",
    ),
    "mart_transaction_summary": (
        "transactions",
        "payment_id order_id merchant_id amount_chf:n currency payment_method card_brand status "
        "created_at:d processed_at:d is_international requires_aml_check refund_count "
        "total_refund_amount_chf:n has_processed_refund net_amount_chf:n",
    ),
    "mart_swiss_rail_overview": (
        "rail",
        "departure:t station_name line_text product operator latitude longitude delay_minutes "
        "platform data_source",
    ),
    "mart_weather_station_catalog": ("weather", STATIONS),
    "fulfillment_lifecycle": (
        "fulfillment",
        "order_id customer_id order_date:d order_status order_total_chf:n shipment_id "
        "shipment_status vehicle_id origin_warehouse destination_city shipped_at:t delivered_at:t "
        "delivery_days:s payment_id payment_method payment_status payment_amount_chf:n "
        "net_payment_chf:n",
    ),
    "customer_overview_360": (
        "customer_360",
        "customer_id company_name legal_form city canton is_active created_at:d "
        "primary_contact_email total_orders total_order_value_chf:n first_order_date:d "
        "last_order_date:d merchant_id merchant_name business_type is_merchant",
    ),
    "transaction_report": (
        "report",
        "payment_id order_id customer_id company_name amount_chf:n payment_method payment_status "
        "is_international requires_aml_check shipment_id requires_customs customs_declaration_id "
        "created_at:d processed_at:d",
    ),
}
# The mart's frame has the name of its sub-query, but for these two.
FRAMES = {"order_totals": "orders"}
SUBQUERIES = {"weather": "flat_stations"}

for _name, (_source, _spec) in MARTS.items():
    add(
        _name,
        lambda d, s=_source: getattr(d, FRAMES.get(s, s)),
        f"SELECT {shown(_spec)} FROM {SUBQUERIES.get(_source, _source)}",
    )


# The joined marts with keys cut from a few rows on, against the SQL of the plain marts.
FEW_ROWS = 5
for _name, _mart, _build in (
    ("fulfillment_hot_keys", "fulfillment_lifecycle", Standins.fulfillment_with),
    ("customer_360_hot_keys", "customer_overview_360", Standins.customer_360_with),
    ("transaction_report_hot_keys", "transaction_report", Standins.report_with),
):
    _source, _spec = MARTS[_mart]
    add(_name, lambda d, b=_build: b(d, FEW_ROWS), f"SELECT {shown(_spec)} FROM {_source}")


def _row_counts(d: Standins) -> DataFrame:
    marts = {"orders": d.orders, "shipments": d.shipments, "transactions": d.transactions}
    counts = [row_count(df).withColumn("mart", F.lit(name)) for name, df in marts.items()]
    return reduce(DataFrame.unionByName, counts)


add(
    "mart_row_counts",
    _row_counts,
    """SELECT 'orders' AS mart, count(*) AS row_count FROM order_totals
       UNION ALL SELECT 'shipments', count(*) FROM shipments
       UNION ALL SELECT 'transactions', count(*) FROM transactions""",
)

ROUTES = (
    "origin_warehouse destination_city total_shipments total_orders total_revenue_chf:n "
    "total_payments_chf:n total_refunds_chf:n net_revenue_chf:n avg_delivery_days"
)
ORDER_VALUE = "round(avg_order_value_chf::DECIMAL(18,6), 4)::DOUBLE"


def _round_average(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_order_value_chf", F.round("avg_order_value_chf", 4))


add(
    "revenue_by_route",
    lambda d: _round_average(d.routes),
    f"SELECT {shown(ROUTES)}, {ORDER_VALUE} AS avg_order_value_chf FROM routes",
)

# Operators on their own ---------------------------------------------------


def _latest_per_user(d: Standins) -> DataFrame:
    fields = {c: c for c in ("ts", "event_id", "event_type", "value")}
    return latest_per_key(d.source("events"), ["user_id"], "ts", fields, ["event_id"])


def _latest_without_time(d: Standins) -> DataFrame:
    """Error events have lost their time here; a missing time counts as latest."""
    events = d.source("events").withColumn("ts", F.expr("IF(event_type = 'error', NULL, ts)"))
    return latest_per_key(events, ["user_id"], "ts", {"ts": "ts", "event_id": "event_id"}, ["event_id"], "n")


add(
    "latest_per_user",
    _latest_per_user,
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts,
         arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type,
         arg_max(value, ts) AS value
       FROM events GROUP BY user_id""",
)
add(
    "latest_null_time_first",
    _latest_without_time,
    """SELECT user_id,
         CASE WHEN NOT bool_or(event_type = 'error')
           THEN strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') END AS ts,
         coalesce(max(event_id) FILTER (event_type = 'error'), arg_max(event_id, ts)) AS event_id,
         count(*) AS n
       FROM events GROUP BY user_id""",
)
add(
    "event_counts",
    lambda d: d.source("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")),
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
)
add(
    "weather_latest_per_station",
    lambda d: mart_weather_station_catalog(d.stations, latest_only=True),
    f"""SELECT {shown(STATIONS)} FROM flat_stations
        QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY last_update DESC) = 1""",
)


def _minute_marks(d: Standins) -> DataFrame:
    events = d.source("events")
    later = F.col("ts") + F.expr("make_dt_interval(0, 0, 0, value * 100)")
    return events.select("event_id", minutes_between(F.col("ts"), later).alias("minutes"))


def _days_to_ship(d: Standins) -> DataFrame:
    first = d.source("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"))
    orders = d.source("orders").withColumn("order_id", F.col("o_orderkey"))
    joined = orders.join(first, F.expr("o_orderkey = l_orderkey"), "left")
    return joined.select("order_id", days_between("o_orderdate", "first").alias("days"))


add(
    "minute_boundaries",
    _minute_marks,
    """SELECT event_id, datediff('minute', ts,
         ts + to_microseconds(round(value * 100 * 1000000)::BIGINT))::INTEGER AS minutes
       FROM events""",
)
add(
    "days_between",
    _days_to_ship,
    """SELECT o_orderkey AS order_id, datediff('day', o_orderdate, min(l_shipdate))::INTEGER AS days
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY o_orderkey, o_orderdate""",
)
add(
    "variant_props_extract",
    lambda d: d.source("events").select(
        "event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")
    ),
    """SELECT event_id, regexp_extract(props, '"k": *([0-9]+)', 1)::INTEGER AS k FROM events""",
)
add(
    "variant_object_key_count",
    lambda d: d.source("events")
    .select("event_type", object_size(F.parse_json("props"), "$").alias("keys"))
    .groupBy("event_type")
    .agg(F.sum("keys").alias("n_keys")),
    "SELECT event_type, count(props) AS n_keys FROM events GROUP BY event_type",
)
add(
    "variant_empty_array_dropped",
    lambda d: row_count(flatten(d.as_raw(d.stationboard_payloads()), "$.results", {"n": ("$.bpuic", "string")})),
    "SELECT count(*) AS row_count FROM event_items",
)

# Listings and open data ---------------------------------------------------

add(
    "active_customers_by_canton",
    lambda d: reports.active_customers_by_canton(d.customers),
    "SELECT canton, count(*) AS customer_count FROM customers WHERE is_active GROUP BY canton",
)
add(
    "customers_in_city",
    lambda d: reports.customers_in_city(d.customers, "NATION_2"),
    """SELECT company_name, primary_contact_first_name, primary_contact_last_name,
         primary_contact_email
       FROM customers WHERE city = 'NATION_2' AND is_active
       ORDER BY company_name, customer_id, primary_contact_id NULLS LAST LIMIT 50""",
)
add(
    "active_vehicles_by_home_base",
    lambda d: reports.active_vehicles_by_home_base(d.fleet),
    "SELECT home_base, count(*) AS vehicle_count FROM fleet WHERE is_active GROUP BY home_base",
)
add(
    "recently_moving_vehicles",
    lambda d: reports.recently_moving_vehicles(d.fleet),
    f"""SELECT {shown('plate_number home_base latest_speed_kmh latest_recorded_at:t')}
        FROM (FROM fleet WHERE latest_is_moving
              ORDER BY fleet.latest_recorded_at DESC NULLS FIRST, vehicle_id LIMIT 50)""",
)
add(
    "active_warehouses_by_canton",
    lambda d: reports.active_warehouses_by_canton(d.warehouses),
    "SELECT canton, count(*) AS warehouse_count FROM warehouses WHERE is_active GROUP BY canton",
)
add(
    "cold_capacity",
    lambda d: reports.cold_capacity(d.warehouses),
    """SELECT warehouse_name, city, cold_capacity_pallets::BIGINT AS cold_capacity_pallets,
         temp_controlled_zones
       FROM warehouses w WHERE w.cold_capacity_pallets > 0
       ORDER BY w.cold_capacity_pallets DESC, warehouse_id LIMIT 30""",
)
add(
    "avg_delay_by_line",
    lambda d: reports.average_delay_by_line(d.rail),
    """SELECT line_text, count(*) AS departures,
         round(avg(delay_minutes)::DECIMAL(18,10), 2)::DOUBLE AS avg_delay_min
       FROM rail WHERE delay_minutes > 0 GROUP BY line_text
       ORDER BY avg_delay_min DESC, line_text LIMIT 20""",
)
add(
    "rows_by_source",
    lambda d: reports.departures_by_source(d.rail),
    "SELECT data_source, count(*) AS row_count FROM rail GROUP BY data_source",
)
add(
    "order_totals_by_status",
    lambda d: reports.order_totals_by_status(d.orders),
    """SELECT status, count(*) AS orders, sum(calculated_total_chf)::DOUBLE AS revenue_chf
       FROM order_totals GROUP BY status""",
)
add(
    "largest_orders_by_lines",
    lambda d: reports.largest_orders_by_lines(d.orders),
    """SELECT order_id, customer_id, line_item_count,
         calculated_total_chf::DOUBLE AS calculated_total_chf
       FROM order_totals ORDER BY line_item_count DESC, order_id LIMIT 25""",
)
add(
    "products_needing_customs",
    lambda d: reports.products_needing_customs(d.products),
    """SELECT product_id, product_name, hs_code, origin_country FROM products
       WHERE requires_customs_declaration
       ORDER BY product_name, product_id, tariff_id NULLS LAST LIMIT 50""",
)
add(
    "avg_landed_cost_by_type",
    lambda d: reports.average_landed_cost_by_category(d.products),
    """SELECT category,
         round(avg(total_landed_cost_chf)::DECIMAL(18,6), 2)::DOUBLE AS avg_landed_chf
       FROM products GROUP BY category""",
)
add(
    "shipments_needing_customs",
    lambda d: reports.shipments_needing_customs(d.shipments),
    """SELECT shipment_id, destination_city, status, customs_declaration_id FROM shipments
       WHERE requires_customs ORDER BY created_at DESC, shipment_id LIMIT 100""",
)
add(
    "open_shipments_by_origin",
    lambda d: reports.open_shipments_by_origin(d.shipments),
    """SELECT origin_warehouse, count(*) AS open_shipments FROM shipments
       WHERE delivered_at IS NULL GROUP BY origin_warehouse""",
)
add(
    "top_merchants_by_gross",
    lambda d: reports.top_merchants_by_gross(d.merchants),
    """SELECT merchant_name, business_type,
         m.total_gross_amount_chf::DOUBLE AS total_gross_amount_chf,
         m.total_net_amount_chf::DOUBLE AS total_net_amount_chf
       FROM merchants m WHERE is_active
       ORDER BY m.total_gross_amount_chf DESC, merchant_id LIMIT 20""",
)
add(
    "merchants_by_type",
    lambda d: reports.merchants_by_type(d.merchants),
    """SELECT business_type, count(*) AS merchant_count FROM merchants
       WHERE is_active GROUP BY business_type""",
)
add(
    "volume_by_method",
    lambda d: reports.volume_by_payment_method(d.transactions),
    """SELECT payment_method, count(*) AS payments, sum(net_amount_chf)::DOUBLE AS net_chf
       FROM transactions GROUP BY payment_method""",
)
add(
    "payments_for_aml",
    lambda d: reports.payments_for_aml_review(d.transactions),
    f"""SELECT {shown('payment_id merchant_id amount_chf:n status created_at:d')}
        FROM (FROM transactions WHERE requires_aml_check
              ORDER BY transactions.created_at DESC, payment_id LIMIT 50)""",
)
add(
    "station_coverage",
    lambda d: reports.station_coverage(d.weather),
    """SELECT count(*) AS station_count, min(latitude) AS min_lat, max(latitude) AS max_lat
       FROM flat_stations""",
)
add(
    "most_delayed_lines",
    lambda d: reports.most_delayed_lines(d.rail),
    """SELECT line_text, product, operator, avg(delay_minutes) AS avg_delay, count(*) AS departures
       FROM rail WHERE delay_minutes > 0 GROUP BY ALL
       ORDER BY avg_delay DESC, line_text, product, operator LIMIT 10""",
)
add(
    "stations_with_most_assets",
    lambda d: reports.stations_with_most_assets(d.weather),
    """SELECT station_name, latitude, longitude, num_assets FROM flat_stations
       ORDER BY num_assets DESC NULLS FIRST, station_id, last_update DESC LIMIT 10""",
)

# Dashboards and notebooks -------------------------------------------------

add(
    "fulfillment_kpis",
    lambda d: reports.fulfillment_kpis(d.fulfillment),
    """SELECT count(DISTINCT order_id) AS total_orders,
         count(DISTINCT shipment_id) AS total_shipments, avg(delivery_days) AS avg_delivery_days,
         sum(order_total_chf)::DOUBLE AS total_revenue_chf
       FROM fulfillment""",
)
add(
    "status_distribution",
    lambda d: reports.order_status_distribution(d.fulfillment),
    "SELECT order_status, count(*) AS n FROM fulfillment WHERE order_status IS NOT NULL GROUP BY 1",
)
add(
    "revenue_by_warehouse",
    lambda d: reports.revenue_by_warehouse(d.fulfillment),
    """SELECT origin_warehouse, sum(f.order_total_chf)::DOUBLE AS order_total_chf
       FROM fulfillment f WHERE origin_warehouse IS NOT NULL GROUP BY 1""",
)
add(
    "revenue_kpis",
    lambda d: reports.revenue_kpis(_round_average(d.routes)).withColumn(
        "avg_order_value_chf", F.round("avg_order_value_chf", 2)
    ),
    """SELECT sum(r.total_revenue_chf)::DOUBLE AS total_revenue_chf,
         sum(r.total_shipments)::BIGINT AS total_shipments,
         round(avg(v), 2) AS avg_order_value_chf
       FROM (SELECT *, round(avg_order_value_chf::DECIMAL(18,6), 4) AS v FROM routes) r""",
)
add(
    "routes_sorted",
    lambda d: _round_average(reports.routes_by_revenue(d.routes)),
    f"SELECT {shown(ROUTES)}, {ORDER_VALUE} AS avg_order_value_chf FROM routes",
)
add(
    "routes_ranked",
    lambda d: reports.routes_ranked(d.routes),
    """SELECT origin_warehouse, destination_city, total_revenue_chf::DOUBLE AS total_revenue_chf,
         rank() OVER (ORDER BY total_revenue_chf DESC NULLS FIRST) AS rank FROM routes""",
)
add(
    "orders_ranked_by_lines",
    lambda d: reports.orders_ranked_by_lines(d.orders),
    """SELECT order_id, line_item_count,
         rank() OVER (ORDER BY line_item_count DESC NULLS FIRST) AS rank,
         row_number() OVER (ORDER BY line_item_count DESC NULLS FIRST, order_id) AS place
       FROM order_totals""",
)
add(
    "products_ranked_by_duty",
    lambda d: reports.products_ranked_by_duty(d.products),
    """SELECT product_id, tariff_id, category, duty_rate_pct::DOUBLE AS duty_rate_pct,
         dense_rank() OVER (ORDER BY duty_rate_pct DESC NULLS FIRST, category NULLS LAST) AS rank
       FROM products""",
)
add(
    "revenue_vs_delivery_time",
    lambda d: reports.revenue_against_delivery_time(d.routes),
    f"""SELECT {shown('destination_city avg_delivery_days total_revenue_chf:n total_shipments')}
        FROM routes""",
)
add(
    "compliance_kpis",
    lambda d: reports.compliance_kpis(d.report),
    """SELECT count(*) AS total_transactions, count(*) FILTER (requires_aml_check) AS aml_flagged,
         (count(*) FILTER (requires_aml_check))::DOUBLE / count(*) * 100 AS aml_percent,
         count(*) FILTER (requires_customs) AS customs_required,
         count(*) FILTER (is_international) AS international
       FROM report""",
)
add(
    "report_volume_by_method",
    lambda d: reports.volume_by_method(d.report),
    """SELECT payment_method, sum(amount_chf)::DOUBLE AS total_chf, count(amount_chf) AS n
       FROM report WHERE payment_method IS NOT NULL GROUP BY payment_method""",
)
add(
    "aml_transactions",
    lambda d: reports.aml_transactions(d.report),
    f"SELECT {shown(MARTS['transaction_report'][1])} FROM report WHERE requires_aml_check",
)
add(
    "customs_transactions",
    lambda d: reports.customs_transactions(d.report),
    f"SELECT {shown(MARTS['transaction_report'][1])} FROM report WHERE requires_customs",
)
add(
    "aml_share",
    lambda d: reports.aml_share(d.report),
    """SELECT count(*) FILTER (requires_aml_check) AS aml_count, count(*) AS total_count,
         (count(*) FILTER (requires_aml_check))::DOUBLE / count(*) * 100 AS aml_percent,
         coalesce(sum(amount_chf) FILTER (requires_aml_check), 0)::DOUBLE AS flagged_amount_chf
       FROM report""",
)
add(
    "aml_methods",
    lambda d: reports.aml_methods(d.report),
    """SELECT payment_method, count(*) AS n FROM report
       WHERE requires_aml_check AND payment_method IS NOT NULL GROUP BY payment_method""",
)
add(
    "customs_declared_vs_missing",
    lambda d: reports.customs_declared_or_missing(d.report),
    """SELECT count(*) FILTER (requires_customs) AS customs_required, count(*) AS total_count,
         count(customs_declaration_id) FILTER (requires_customs) AS with_declaration,
         count(*) FILTER (requires_customs AND customs_declaration_id IS NULL)
           AS missing_declaration
       FROM report""",
)
add(
    "intl_vs_domestic",
    lambda d: reports.international_and_domestic(d.report),
    """SELECT count(*) FILTER (is_international) AS international_count,
         count(*) FILTER (NOT is_international) AS domestic_count,
         sum(amount_chf) FILTER (is_international)::DOUBLE AS international_chf,
         sum(amount_chf) FILTER (NOT is_international)::DOUBLE AS domestic_chf
       FROM report""",
)
add(
    "risk_by_customer",
    lambda d: reports.risk_by_company(d.report),
    """SELECT company_name, count(payment_id) AS total_txn, sum(amount_chf)::DOUBLE AS total_chf,
         count(*) FILTER (requires_aml_check) AS aml_flags,
         count(*) FILTER (requires_customs) AS customs_req,
         count(*) FILTER (is_international) AS international
       FROM report WHERE company_name IS NOT NULL GROUP BY company_name
       ORDER BY aml_flags DESC, company_name LIMIT 20""",
)


def _usage(d: Standins, **options) -> DataFrame:
    events = d.source("events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    newest = d.source("events").agg(F.max("ts").alias("ts")).scalar()
    return reports.usage_last_days(events, "event_type", "ts", "value", newest, **options)


add(
    "usage_last_7_days",
    _usage,
    """SELECT event_type, sum(value::DECIMAL(18,2))::DOUBLE AS used FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type""",
)

add(
    "usage_by_prefix",
    lambda d: _usage(d, prefix="s", days=30),
    """SELECT event_type, sum(value::DECIMAL(18,2))::DOUBLE AS used FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY AND event_type LIKE 's%'
       GROUP BY event_type""",
)

# Metric layer -------------------------------------------------------------

add(
    "metric_fulfillment_by_status",
    lambda d: metrics.metric_query(
        metrics.FULFILLMENT,
        d.fulfillment,
        ["revenue", "avg_delivery_days", "Zahlungsvolumen", "number of orders", "shipment_count"],
        ["Bestellstatus"],
    ),
    """SELECT order_status, sum(order_total_chf)::DOUBLE AS total_revenue,
         avg(delivery_days) AS avg_delivery_days, sum(payment_amount_chf)::DOUBLE AS total_payments,
         count(DISTINCT order_id) AS order_count, count(DISTINCT shipment_id) AS shipment_count
       FROM fulfillment GROUP BY order_status""",
)
add(
    "metric_route_delivery_time",
    lambda d: metrics.metric_query(
        metrics.FULFILLMENT,
        d.fulfillment,
        ["average delivery time"],
        ["origin", "destination"],
        where=F.col("origin_warehouse").isNotNull(),
    ),
    """SELECT origin_warehouse, destination_city, avg(delivery_days) AS avg_delivery_days
       FROM fulfillment WHERE origin_warehouse IS NOT NULL GROUP BY ALL""",
)
add(
    "metric_revenue_by_payment_method",
    lambda d: metrics.metric_query(metrics.FULFILLMENT, d.fulfillment, ["total_revenue"], ["payment type"]),
    """SELECT payment_method, sum(order_total_chf)::DOUBLE AS total_revenue
       FROM fulfillment GROUP BY payment_method""",
)
add(
    "metric_revenue_all",
    lambda d: metrics.metric_query(
        metrics.REVENUE,
        d.routes,
        ["Gesamtnettoumsatz", "overall shipments", "overall avg delivery time"],
    ).withColumn("avg_route_delivery_days", F.round("avg_route_delivery_days", 6)),
    """SELECT sum(net_revenue_chf)::DOUBLE AS total_net_revenue,
         sum(total_shipments)::BIGINT AS total_route_shipments,
         round(avg(avg_delivery_days), 6) AS avg_route_delivery_days
       FROM routes""",
)
add(
    "metric_net_revenue_by_route",
    lambda d: metrics.metric_query(
        metrics.REVENUE, d.routes, ["overall net revenue"], ["Abgangsort", "Zielort"]
    ),
    """SELECT origin_warehouse, destination_city, net_revenue_chf::DOUBLE AS total_net_revenue
       FROM routes""",
)
add(
    "metric_compliance_by_method",
    lambda d: metrics.metric_query(
        metrics.COMPLIANCE,
        d.report,
        ["total volume", "transaction_count", "AML count", "customs count", "cross-border count"],
        ["Zahlungsart"],
    ),
    """SELECT payment_method, sum(amount_chf)::DOUBLE AS total_amount,
         count(payment_id) AS transaction_count,
         count(*) FILTER (requires_aml_check) AS aml_flagged_count,
         count(*) FILTER (requires_customs) AS customs_required_count,
         count(*) FILTER (is_international) AS international_count
       FROM report GROUP BY payment_method""",
)
add(
    "metric_customs_transactions",
    lambda d: metrics.metric_query(
        metrics.COMPLIANCE,
        d.report,
        ["number of transactions"],
        ["BAZG flag", "payment state"],
    ),
    """SELECT requires_customs, payment_status, count(payment_id) AS transaction_count
       FROM report GROUP BY ALL""",
)
add(
    "metric_fanout_guard",
    lambda d: metrics.metric_query(
        metrics.FULFILLMENT,
        d.fulfillment,
        ["total_revenue", "avg_delivery_days", "total_payments", "order_count", "shipment_count"],
        ["order_status"],
        guard_fanout=True,
    ),
    """SELECT order_status,
         (SELECT sum(total_amount_chf) FROM order_header h WHERE h.status = order_status)::DOUBLE
           AS total_revenue,
         (SELECT avg(days) FROM (SELECT DISTINCT g.order_status AS st, g.shipment_id,
            g.delivery_days AS days FROM fulfillment g WHERE g.shipment_id IS NOT NULL)
          WHERE st = order_status) AS avg_delivery_days,
         (SELECT sum(amount) FROM (SELECT DISTINCT g.order_status AS st, g.payment_id,
            g.payment_amount_chf AS amount FROM fulfillment g WHERE g.payment_id IS NOT NULL)
          WHERE st = order_status)::DOUBLE AS total_payments,
         order_count, shipment_count
       FROM (SELECT f.order_status, count(DISTINCT order_id) AS order_count,
               count(DISTINCT shipment_id) AS shipment_count
             FROM fulfillment f GROUP BY f.order_status)""",
)

# Governance ---------------------------------------------------------------

EMAIL_PATTERN = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"

add(
    "mask_email",
    lambda d: d.source("documents")
    .select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(EMAIL_PATTERN), F.lit(0))))
    .select("doc_id", "pos", masks.mask_email(F.col("col"), VISITOR).alias("masked")),
    f"""SELECT doc_id, (i - 1)::INTEGER AS pos, e[i][1] || '***@' || split_part(e[i], '@', 2) AS masked
        FROM (SELECT doc_id, e, unnest(range(1, len(e) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{EMAIL_PATTERN}') AS e FROM documents))""",
)
add(
    "mask_phone",
    lambda d: d.stg("business_customer").select("customer_id", masks.mask_phone("phone", VISITOR).alias("masked")),
    "SELECT customer_id, '***-' || right(phone, 4) AS masked FROM business_customer",
)
add(
    "mask_iban",
    lambda d: d.stg("merchant_account").select(
        "merchant_id",
        masks.mask_iban("bank_account_iban", VISITOR).alias("masked"),
        masks.mask_iban("registration_number", VISITOR).alias("masked_short"),
        masks.mask_iban("bank_account_iban", OFFICER).alias("clear"),
    ),
    """SELECT merchant_id,
         left(bank_account_iban, 4) || '*************' || right(bank_account_iban, 4) AS masked,
         left(registration_number, 4) || repeat('*', greatest(length(registration_number) - 8, 0))
           || right(registration_number, 4) AS masked_short,
         bank_account_iban AS clear
       FROM merchant_account""",
)
add(
    "mask_card",
    lambda d: d.stg("merchant_account").select(
        "merchant_id", masks.mask_credit_card("bank_account_iban", VISITOR).alias("masked")
    ),
    """SELECT merchant_id, '****-****-****-' || right(bank_account_iban, 4) AS masked
       FROM merchant_account""",
)
add(
    "mask_name",
    lambda d: d.customers.select(
        "customer_id",
        "primary_contact_id",
        masks.mask_name("primary_contact_last_name", VISITOR).alias("masked"),
    ),
    "SELECT customer_id, primary_contact_id, '***' AS masked FROM customers",
)
add(
    "mask_address",
    lambda d: d.stg("business_customer").select("customer_id", masks.mask_address("street", VISITOR).alias("masked")),
    "SELECT customer_id, '*** REDACTED ***' AS masked FROM business_customer",
)
add(
    "mask_amount",
    lambda d: d.stg("payment").select(
        "payment_id",
        masks.mask_amount("amount_chf", VISITOR).alias("masked"),
        masks.mask_amount("amount_chf", OFFICER).alias("clear"),
    ),
    "SELECT payment_id, NULL::DOUBLE AS masked, amount_chf::DOUBLE AS clear FROM payment",
)
add(
    "rows_pii",
    lambda d: d.report.filter(policies.rows_pii("requires_aml_check", VISITOR)).select("payment_id", "shipment_id"),
    "SELECT payment_id, shipment_id FROM report WHERE NOT requires_aml_check",
)
add(
    "rows_financial",
    lambda d: d.stg("payment")
    .withColumn("class", F.expr("IF(requires_aml_check, 'FINMA_RESTRICTED', card_brand)"))
    .filter(policies.rows_financial("class", VISITOR))
    .select("payment_id", "class"),
    """SELECT payment_id, card_brand AS class FROM payment
       WHERE NOT requires_aml_check AND card_brand IS NOT NULL""",
)
add(
    "rows_customs",
    lambda d: d.report.filter(policies.rows_customs("requires_customs", VISITOR)).select(
        "payment_id", "shipment_id", "requires_customs"
    ),
    "SELECT payment_id, shipment_id, requires_customs FROM report WHERE requires_customs = FALSE",
)
add(
    "rows_merchant",
    lambda d: d.stg("merchant_account")
    .withColumn("owner_role", F.concat(F.lit("DP_"), "business_type"))
    .filter(policies.rows_merchant("owner_role", "DP_RETAIL"))
    .select("merchant_id", "owner_role"),
    """SELECT merchant_id, 'DP_RETAIL' AS owner_role FROM merchant_account
       WHERE business_type = 'RETAIL'""",
)
add(
    "apply_policies",
    lambda d: policies.apply_policies(
        d.report,
        VISITOR,
        masks={"company_name": masks.mask_name, "amount_chf": masks.mask_amount},
        filters={"requires_customs": policies.rows_customs},
    ).select("payment_id", "shipment_id", "company_name", "amount_chf"),
    """SELECT payment_id, shipment_id, '***' AS company_name, NULL::DOUBLE AS amount_chf
       FROM report WHERE requires_customs = FALSE""",
)



def _retained(d: Standins) -> DataFrame:
    """Events no older than ten days on the last day of January 2024."""
    events = d.source("events").select("event_id", F.to_date("ts").alias("day"))
    tagged = policies.tag_column(events, "day", RETENTION_DAYS="10", PII_LEVEL="LOW")
    return policies.within_retention(tagged, "day", date(2024, 1, 31))


add(
    "rows_within_retention",
    _retained,
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
       WHERE ts >= TIMESTAMP '2024-01-21 00:00:00'""",
)

# Checks -------------------------------------------------------------------

add(
    "dq_not_null",
    lambda d: checks.not_null(d.stg("payment"), "order_id").select("payment_id"),
    "SELECT payment_id FROM payment WHERE order_id IS NULL",
)
add(
    "dq_unique",
    lambda d: checks.unique(d.stg("order_line_item"), "line_item_id"),
    """SELECT line_item_id, count(*) AS n_records FROM order_line_item
       GROUP BY line_item_id HAVING count(*) > 1""",
)
add(
    "dq_accepted_values",
    lambda d: checks.accepted_values(
        d.stg("payment"), "status", CHECKS["stg_refund"].accepted["status"]
    ).select("payment_id", "status"),
    """SELECT payment_id, status FROM payment
       WHERE status NOT IN ('PENDING', 'APPROVED', 'PROCESSED', 'REJECTED')""",
)
add(
    "dq_relationships",
    lambda d: checks.relationships(
        d.stg("tracking_event"), "shipment_id", d.stg("shipment"), "shipment_id"
    ).select("event_id", "shipment_id"),
    """SELECT event_id, shipment_id FROM tracking_event
       WHERE shipment_id NOT IN (SELECT s.shipment_id FROM shipment s)""",
)


def _dq_report(d: Standins) -> DataFrame:
    frames = {f"stg_{t}": d.stg(t) for t in ("order_header", "order_line_item", "shipment", "tracking_event")}
    spec: TableChecks = CHECKS["stg_tracking_event"]
    lines = checks.run_checks(
        frames["stg_order_line_item"], "stg_order_line_item", CHECKS["stg_order_line_item"], frames.get
    )
    scans = checks.run_checks(frames["stg_tracking_event"], "stg_tracking_event", spec, frames.get)
    return lines.unionByName(scans)


def _check_sql(table: str, check: str, column: str, query: str) -> str:
    return (
        f"SELECT 'stg_{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"({query})::BIGINT AS failures"
    )


def _nulls(table: str, column: str) -> str:
    return _check_sql(
        table, "not_null", column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    )


def _repeats(table: str, column: str) -> str:
    inner = f"SELECT {column} FROM {table} GROUP BY 1 HAVING count(*) > 1"
    return _check_sql(table, "unique", column, f"SELECT count(*) FROM ({inner})")


def _orphans(table: str, column: str, parent: str) -> str:
    query = f"SELECT count(*) FROM {table} c ANTI JOIN {parent} p ON c.{column} = p.{column}"
    return _check_sql(table, "relationships", column, query)


def _outside(table: str, column: str, values: Sequence[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    query = f"SELECT count(*) FROM {table} WHERE {column}::VARCHAR NOT IN ({listed})"
    return _check_sql(table, "accepted_values", column, query)


add(
    "dq_report",
    _dq_report,
    "\nUNION ALL ".join(
        [
            _nulls("order_line_item", "line_item_id"),
            _nulls("order_line_item", "order_id"),
            _nulls("order_line_item", "product_id"),
            _repeats("order_line_item", "line_item_id"),
            _orphans("order_line_item", "order_id", "order_header"),
            _nulls("tracking_event", "event_id"),
            _nulls("tracking_event", "shipment_id"),
            _outside("tracking_event", "event_type", CHECKS["stg_tracking_event"].accepted["event_type"]),
            _repeats("tracking_event", "event_id"),
            _orphans("tracking_event", "shipment_id", "shipment"),
        ]
    ),
)

# All declared checks of the staging tables; the SQL counts every one of them.
STAGED = [name for name in CHECKS if name.removeprefix("stg_") in SEEDS]


def _dq_staging(d: Standins) -> DataFrame:
    frames = {name: d.stg(name.removeprefix("stg_")) for name in STAGED}
    return reduce(
        DataFrame.unionByName,
        [checks.run_checks(frames[name], name, CHECKS[name], frames.__getitem__) for name in STAGED],
    )


def _declared_sql(name: str) -> list[str]:
    table, spec = name.removeprefix("stg_"), CHECKS[name]
    found = [_nulls(table, c) for c in (*spec.key, *spec.required)]
    found += [_outside(table, column, values) for column, values in spec.accepted.items()]
    found += [_repeats(table, c) for c in spec.key]
    for column, (parent, parent_column) in spec.refs.items():
        parent = parent.removeprefix("stg_")
        lost = (
            f"SELECT count(*) FROM {table} c ANTI JOIN {parent} p ON c.{column} = p.{parent_column}"
            f" WHERE c.{column} IS NOT NULL"
        )
        found.append(_check_sql(table, "relationships", column, lost))
    return found


add(
    "dq_report_staging",
    _dq_staging,
    "\nUNION ALL ".join(query for name in STAGED for query in _declared_sql(name)),
)

# All declared checks of the marts, by the frame and sub-query that a mart has here.
MART_FRAMES = {name: source for name, (source, _) in MARTS.items()} | {
    "customer_overview": "customer_360",
    "revenue_by_route": "routes",
}
MART_CHECKS = [name for name in CHECKS if name in MART_FRAMES]


def _dq_marts(d: Standins) -> DataFrame:
    reports_of = []
    for name in MART_CHECKS:
        source = MART_FRAMES[name]
        frame = getattr(d, FRAMES.get(source, source))
        reports_of.append(checks.run_checks(frame, name, CHECKS[name], lambda parent: None))
    return reduce(DataFrame.unionByName, reports_of)


def _mart_sql(name: str) -> list[str]:
    source, spec = MART_FRAMES[name], CHECKS[name]
    table = SUBQUERIES.get(source, source)
    found = [_nulls(table, c) for c in (*spec.key, *spec.required)]
    found += [_outside(table, column, values) for column, values in spec.accepted.items()]
    found += [
        _check_sql(table, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {table} "
                   f"WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c in spec.key
    ]
    return [query.replace(f"'stg_{table}' AS", f"'{name}' AS", 1) for query in found]


add(
    "dq_report_marts",
    _dq_marts,
    "\nUNION ALL ".join(query for name in MART_CHECKS for query in _mart_sql(name)),
)

# Tables -------------------------------------------------------------------

for _table in ("order_header", "payment", "business_customer"):
    add(
        f"csv_stg_{_table}",
        lambda d, t=_table: d.built()[1][f"stg_{t}"],
        f"SELECT {shown(seed_spec(_table))} FROM {_table}",
    )

add(
    "table_revenue_by_route",
    lambda d: _round_average(d.built()[0].read("mart", "revenue_analytics", "revenue_by_route")),
    f"SELECT {shown(ROUTES)}, {ORDER_VALUE} AS avg_order_value_chf FROM routes",
)
add(
    "table_transaction_report",
    lambda d: d.built()[0].read("mart", "compliance", "transaction_report"),
    f"SELECT {shown(MARTS['transaction_report'][1])} FROM report",
)

BUILT = {**{name: product for name, (product, _, _) in DOMAIN_MARTS.items()},
         **{name: product for name, (product, _, _) in ENTERPRISE_MARTS.items()}}


def _inventory(d: Standins) -> DataFrame:
    catalog = d.built()[0]
    found = catalog.inventory().filter(F.col("schema_name").endswith(catalog.suffix))
    found = found.filter(~F.col("table_name").rlike("_(heavy|summary)_"))
    schema = F.regexp_replace("schema_name", f"{catalog.suffix}$", "")
    return found.select(
        schema.alias("schema_name"), "table_name", "row_count", (F.col("file_bytes") > 0).alias("stored")
    )


add(
    "mart_inventory",
    _inventory,
    "\nUNION ALL ".join(
        f"SELECT 'mart_{product}' AS schema_name, '{name}' AS table_name, count(*) AS row_count, true AS stored "
        f"FROM {MART_FRAMES[name]}"
        for name, product in BUILT.items()
    ),
)

# Ingest and streams -------------------------------------------------------

add(
    "page_first_link",
    lambda d: with_first_link(d.source("pages"), "html", streams.PAGE_LINK).select(
        "page_id", "download_url", "file_name"
    ),
    f"""SELECT page_id, nullif(u, '') AS download_url,
          CASE WHEN u <> '' THEN split_part(u, '/', -1) END AS file_name
        FROM (SELECT page_id, regexp_extract(html, '{streams.PAGE_LINK}', 1) AS u FROM pages)""",
)
add(
    "csv_lines_header_drop",
    streams.text_lines,
    """SELECT line, count(*) AS n
       FROM (SELECT trim(unnest(string_split(text, chr(10))), chr(9) || chr(13) || ' ') AS line
             FROM conversations)
       WHERE line <> '' GROUP BY line""",
)
add(
    "quarantine_split",
    streams.quarantine,
    """SELECT kind, value, count(*) AS n
       FROM (SELECT CASE WHEN event_type IN ('error', 'view', 'signup') THEN 'quarantine'
                 ELSE 'raw' END AS kind,
               CASE event_type WHEN 'error' THEN '{"k":' WHEN 'view' THEN props || props
                 WHEN 'signup' THEN props || ' tail' ELSE replace(props, ' ', '') END AS value
             FROM events) GROUP BY ALL""",
)
add(
    "stream_raw_append",
    streams.raw_append,
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
       FROM events""",
)
add(
    "stream_dedupe_by_key",
    streams.dedupe_by_key,
    "SELECT DISTINCT user_id::VARCHAR AS raw_key, event_type FROM events",
)
add(
    "stream_dedupe_connections",
    streams.connections_polled_twice,
    f"SELECT {shown(CONNECTIONS)} FROM flat_connections",
)
add(
    "stream_dedupe_stationboard",
    streams.stationboard_polled_twice,
    f"SELECT {shown(STATIONBOARD)} FROM flat_stationboard",
)
add(
    "stream_dedupe_stations",
    streams.stations_polled_twice,
    f"SELECT {shown(STATIONS)} FROM flat_stations",
)
add(
    "stream_dedupe_lines",
    streams.lines_polled_twice,
    """SELECT DISTINCT line
       FROM (SELECT trim(unnest(string_split(text, chr(10))), chr(9) || chr(13) || ' ') AS line
             FROM conversations) WHERE line <> ''""",
)
add(
    "stream_multiline_payloads",
    streams.multiline_payloads,
    f"SELECT {shown(STATIONBOARD)} FROM flat_stationboard",
)
add(
    "stream_dedupe_watermark",
    streams.dedupe_watermark,
    "SELECT event_id, count(*) AS n FROM events GROUP BY event_id",
)
add(
    "stream_flatten",
    streams.flattened,
    f"SELECT {shown(STATIONBOARD)} FROM flat_stationboard",
)
add(
    "stream_latest_per_key",
    streams.latest_per_user,
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts,
         arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value
       FROM events GROUP BY user_id""",
)
add(
    "stream_raw_compacted",
    streams.raw_compacted,
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
       FROM events""",
)
add(
    "stream_dedupe_indexed",
    streams.dedupe_over_compactions,
    """SELECT DISTINCT user_id::VARCHAR AS raw_key, event_type, hour(ts)::INT AS hour FROM events""",
)
add(
    "stream_flatten_misfits",
    streams.flatten_misfits,
    """SELECT 'flat' AS kind, event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
         NULL::VARCHAR AS payload FROM events
       UNION ALL
       SELECT 'value', NULL, NULL, '{"event_id":' || event_id || ',"value":"none"}'
       FROM events WHERE event_type = 'error'""",
)
add(
    "quarantine_retry",
    streams.quarantine_retry,
    """WITH lost AS (
         SELECT event_type, props,
           CASE event_type WHEN 'error' THEN '{"k":' WHEN 'view' THEN props || props ELSE props || ' tail' END AS sent,
           CASE event_type WHEN 'error' THEN 'no json value' ELSE 'more than one value' END AS cause
         FROM events WHERE event_type IN ('error', 'view', 'signup')
       )
       SELECT attempt::INT AS attempt, cause, outcome, payload, count(*) AS n FROM (
         SELECT 1 AS attempt, cause, 'retried' AS outcome, NULL AS payload FROM lost
         UNION ALL SELECT 2, cause, 'dead', sent FROM lost WHERE event_type <> 'signup'
         UNION ALL SELECT 2, NULL, 'recovered', NULL FROM lost WHERE event_type = 'signup'
         UNION ALL SELECT 0, NULL, 'raw', replace(props, ' ', '') FROM lost WHERE event_type = 'signup'
       ) GROUP BY ALL""",
)
add(
    "stream_latest_upserted",
    streams.upserted_latest,
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts,
         arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value
       FROM events GROUP BY user_id""",
)
add(
    "feed_exchange_rates",
    streams.exchange_rates,
    "SELECT o_orderkey || ';' || o_orderstatus AS line FROM orders",
)
add(
    "feed_foreign_trade",
    streams.foreign_trade,
    "SELECT p_partkey || ';' || p_name AS line FROM part",
)
add(
    "feed_traffic_counts",
    streams.traffic_counts,
    "SELECT s_nationkey::VARCHAR AS raw_key, s_suppkey AS key, s_name AS name FROM supplier",
)
add(
    "feed_postcodes",
    streams.postcodes,
    "SELECT (c_custkey // 1000)::VARCHAR AS raw_key, c_custkey AS key, c_name AS name FROM customer",
)
