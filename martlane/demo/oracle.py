"""DuckDB SQL that computes the registered queries independently.

``TABLES`` holds named sub-queries: stand-ins for the seed tables, the marts
on top of them, and the expected rows of the feeds. ``sql`` puts the ones a
query needs in front of it.
"""

from __future__ import annotations

import re

from martlane.sources.seeds import seed_columns

DAY, STAMP, NUMBER, WHOLE, SMALL = "d", "t", "n", "i", "s"


def shown(spec: str) -> str:
    """A select list from ``name`` or ``name:kind`` words.

    Kinds: d date and t timestamp as text, n decimal as double, i bigint, s int.
    """
    forms = {
        DAY: "strftime({0}, '%Y-%m-%d') AS {0}",
        STAMP: "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}",
        NUMBER: "CAST({0} AS DOUBLE) AS {0}",
        WHOLE: "CAST({0} AS BIGINT) AS {0}",
        SMALL: "CAST({0} AS INTEGER) AS {0}",
    }
    out = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        out.append(forms[kind].format(name) if kind else name)
    return ", ".join(out)


def seed_spec(table: str) -> str:
    """The typed columns of a seed table as words for ``shown``."""
    kinds = {"date": DAY, "timestamp_ntz": STAMP, "decimal": NUMBER}
    words = []
    for name, type_name in seed_columns(table):
        kind = kinds.get(type_name.split("(")[0])
        words.append(f"{name}:{kind}" if kind else name)
    return " ".join(words)


TABLES: dict[str, str] = {
    # Stand-ins for the seed tables -----------------------------------------
    "business_customer": """
        SELECT c_custkey::VARCHAR AS customer_id, c_name AS company_name,
          c_mktsegment AS legal_form, 'Street ' || c_nationkey AS street,
          lpad(c_nationkey::VARCHAR, 4, '0') AS postal_code,
          'NATION_' || c_nationkey AS city, 'C' || c_nationkey AS canton, 'CH' AS country,
          c_name AS contact_name, 'c' || c_custkey || '@example.com' AS contact_email,
          '+41 44 ' || lpad(c_custkey::VARCHAR, 7, '0') AS phone, c_acctbal > 0 AS is_active,
          DATE '2020-01-01' + c_nationkey AS created_at
        FROM customer""",
    "customer_contact": """
        SELECT s_suppkey::VARCHAR AS contact_id,
          (s_suppkey - s_suppkey % 2)::VARCHAR AS customer_id, s_name AS first_name,
          'L' || s_nationkey AS last_name,
          CASE WHEN s_nationkey < 10 THEN 'BUYER' ELSE 'OWNER' END AS role,
          's' || s_suppkey || '@example.com' AS email, '+41 31 ' || s_suppkey AS phone,
          s_acctbal > 1000 AS is_primary
        FROM supplier""",
    "vehicle": """
        SELECT c_custkey::VARCHAR AS vehicle_id, 'ZH ' || c_custkey AS plate_number,
          CASE c_mktsegment WHEN 'MACHINERY' THEN 'TRUCK' WHEN 'BUILDING' THEN 'VAN'
            WHEN 'AUTOMOBILE' THEN 'TRAILER' WHEN 'FURNITURE' THEN 'ELECTRIC_VAN'
            ELSE 'HYBRID' END AS vehicle_type,
          c_mktsegment AS make, 'M' || c_nationkey AS model,
          (2000 + c_nationkey)::INTEGER AS "year", (c_nationkey * 100)::INTEGER AS capacity_kg,
          c_acctbal AS capacity_m3,
          CASE c_mktsegment WHEN 'FURNITURE' THEN 'ELECTRIC' WHEN 'HOUSEHOLD' THEN 'HYBRID'
            ELSE 'DIESEL' END AS fuel_type,
          'NATION_' || c_nationkey AS home_base, c_acctbal > 0 AS is_active,
          DATE '2023-01-01' + c_nationkey AS last_service_date
        FROM customer""",
    "gps_position": """
        SELECT event_id::VARCHAR AS position_id, user_id::VARCHAR AS vehicle_id,
          ts AS recorded_at, value AS latitude,
          regexp_extract(props, '([0-9]+)', 1)::DOUBLE AS longitude, value AS speed_kmh,
          regexp_extract(props, '([0-9]+)', 1)::DOUBLE AS heading_degrees,
          event_type IN ('click', 'view') AS is_moving
        FROM events""",
    "warehouse": """
        SELECT s_suppkey::VARCHAR AS warehouse_id, s_name AS warehouse_name,
          'Street ' || s_nationkey AS street, lpad(s_nationkey::VARCHAR, 4, '0') AS postal_code,
          n_name AS city, r_name AS canton, s_acctbal AS latitude,
          s_nationkey::DOUBLE AS longitude, (s_nationkey * 100)::INTEGER AS capacity_pallets,
          s_acctbal > 0 AS is_active
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
          LEFT JOIN region ON r_regionkey = n_regionkey""",
    "warehouse_zone": """
        SELECT c_custkey::VARCHAR AS zone_id, c_nationkey::VARCHAR AS warehouse_id,
          c_name AS zone_name,
          CASE WHEN c_acctbal < 0 THEN 'RETURNS' WHEN c_mktsegment = 'MACHINERY' THEN 'HAZMAT'
            WHEN c_mktsegment = 'BUILDING' THEN 'STORAGE'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'LOADING'
            WHEN c_mktsegment = 'FURNITURE' THEN 'COLD' ELSE 'RECEIVING' END AS zone_type,
          (c_custkey % 100)::INTEGER AS capacity_pallets,
          c_acctbal > 5000 AS temperature_controlled
        FROM customer""",
    "order_header": """
        SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id,
          o_orderdate::DATE AS order_date,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'PENDING' WHEN '2-HIGH' THEN 'CONFIRMED'
            WHEN '3-MEDIUM' THEN 'SHIPPED' WHEN '4-NOT SPECIFIED' THEN 'DELIVERED'
            ELSE 'CANCELLED' END AS status,
          'Street ' || o_custkey AS delivery_street,
          lpad((o_custkey % 10000)::VARCHAR, 4, '0') AS delivery_postal_code,
          'N' || (o_custkey % 25) AS delivery_city,
          o_totalprice::DECIMAL(12,2) AS total_amount_chf, 'CHF' AS currency,
          CASE o_orderstatus WHEN 'F' THEN 'Basel' WHEN 'O' THEN 'Zürich' ELSE 'Bern' END
            AS warehouse_origin
        FROM orders""",
    "order_line_item": """
        SELECT l_orderkey || '-' || l_linenumber AS line_item_id,
          l_orderkey::VARCHAR AS order_id, l_partkey::VARCHAR AS product_id,
          l_quantity::DECIMAL(10,0) AS quantity,
          l_extendedprice::DECIMAL(10,2) AS unit_price_chf,
          l_extendedprice::DECIMAL(12,2) AS line_total_chf
        FROM lineitem""",
    "product": """
        SELECT p_partkey::VARCHAR AS product_id, p_name AS product_name, p_type AS category,
          p_brand AS hs_tariff_code, p_size::DECIMAL(10,2) AS weight_kg,
          p_retailprice::DECIMAL(10,2) AS unit_price_chf, 'CHF' AS currency,
          p_brand AS origin_country, p_size > 40 AS is_hazardous,
          p_size >= 25 AS requires_customs_declaration, DATE '2021-01-01' + p_size AS created_at
        FROM part""",
    "product_tariff": """
        SELECT p_partkey || '-' || n AS tariff_id,
          CASE WHEN p_type = 'STANDARD' THEN 'old-' ELSE '' END || p_partkey AS product_id,
          lpad(p_size::VARCHAR, 8, '0') AS hs_code, p_type || ' ' || p_brand AS description,
          (p_size % 9 + n)::DECIMAL(5,2) AS duty_rate_pct,
          CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 2.50 ELSE 7.70 END::DECIMAL(5,2)
            AS vat_rate_pct,
          (p_size % 3)::DECIMAL(5,2) AS preferential_rate_pct
        FROM part JOIN (VALUES (1), (2)) AS numbers(n)
          ON n = 1 OR p_type = 'PROMO'""",
    "shipment": """
        SELECT l_orderkey || '-' || l_returnflag AS shipment_id, l_orderkey::VARCHAR AS order_id,
          min(l_suppkey)::VARCHAR AS vehicle_id, 'W' || (min(l_suppkey) % 8) AS origin_warehouse,
          'N' || (max(l_partkey) % 25) AS destination_city,
          lpad((max(l_partkey) % 25)::VARCHAR, 4, '0') AS destination_postal_code,
          CASE WHEN bool_and(l_linestatus = 'F') THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS status,
          min(l_shipdate) AS created_at, min(l_shipdate) AS shipped_at,
          CASE WHEN bool_and(l_linestatus = 'F') THEN max(l_shipdate) END AS delivered_at,
          sum(l_quantity) AS weight_kg, max(l_quantity) AS volume_m3,
          max(l_tax) > 0.05::DOUBLE AS requires_customs,
          CASE WHEN max(l_tax) > 0.05::DOUBLE AND max(l_discount) > 0.05::DOUBLE
            THEN 'CD' || l_orderkey END AS customs_declaration_id
        FROM lineitem GROUP BY l_orderkey, l_returnflag""",
    "tracking_event": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
          l_orderkey || '-' || CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'open' END
            AS shipment_id,
          CASE l_linenumber WHEN 1 THEN 'CREATED' WHEN 2 THEN 'PICKED_UP' WHEN 3 THEN 'DEPARTED'
            WHEN 4 THEN 'ARRIVED' WHEN 5 THEN 'CUSTOMS_CHECK' WHEN 6 THEN 'OUT_FOR_DELIVERY'
            ELSE 'DELIVERED' END AS event_type,
          l_shipdate AS event_timestamp, 'S' || l_suppkey AS location_name,
          l_quantity AS latitude, l_extendedprice AS longitude, l_linestatus AS notes
        FROM lineitem""",
    "merchant_account": """
        SELECT c_custkey::VARCHAR AS merchant_id, c_name AS merchant_name,
          CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B2B'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'RETAIL'
            WHEN c_mktsegment = 'FURNITURE' THEN 'ECOMMERCE' ELSE 'MARKETPLACE' END
            AS business_type,
          'CHE-' || c_custkey AS registration_number,
          'CH93' || lpad(c_custkey::VARCHAR, 17, '0') AS bank_account_iban,
          'CHF' AS settlement_currency, c_nationkey::DECIMAL(4,2) AS fee_rate_pct,
          (c_custkey - c_custkey % 3)::VARCHAR AS customer_id, c_acctbal > 0 AS is_active,
          DATE '2022-01-01' + c_nationkey AS onboarded_at
        FROM customer""",
    "payout": """
        SELECT l_suppkey || '-' || m AS payout_id, l_suppkey::VARCHAR AS merchant_id,
          m AS period_start, last_day(m) AS period_end, gross AS gross_amount_chf,
          fee AS fee_amount_chf, gross - fee AS net_amount_chf,
          CASE WHEN month(m) <= 4 THEN 'PAID' WHEN month(m) <= 8 THEN 'APPROVED'
            ELSE 'CALCULATED' END AS status,
          CASE WHEN month(m) <= 4 THEN last_day(m) END AS paid_at
        FROM (SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS m,
                sum(l_extendedprice::DECIMAL(12,2)) AS gross, sum(l_quantity::DECIMAL(12,2)) AS fee
              FROM lineitem GROUP BY ALL)""",
    "payment": """
        SELECT o_orderkey || '-' || n AS payment_id,
          CASE WHEN n = 1 OR o_orderstatus <> 'P' THEN o_orderkey::VARCHAR END AS order_id,
          o_custkey::VARCHAR AS merchant_id, o_totalprice::DECIMAL(12,2) AS amount_chf,
          'CHF' AS currency,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'CREDIT_CARD' WHEN '2-HIGH' THEN 'DEBIT_CARD'
            WHEN '3-MEDIUM' THEN 'TWINT' WHEN '4-NOT SPECIFIED' THEN 'BANK_TRANSFER'
            ELSE 'CRYPTO' END AS payment_method,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'VISA' END AS card_brand,
          CASE o_orderstatus WHEN 'F' THEN 'CAPTURED' WHEN 'O' THEN 'AUTHORIZED'
            ELSE 'PENDING' END AS status,
          o_orderdate::DATE AS created_at,
          CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + n END AS processed_at,
          o_custkey % 4 = 0 AS is_international, o_totalprice > 400000 AS requires_aml_check
        FROM orders JOIN (VALUES (1), (2)) AS numbers(n)
          ON n = 1 OR o_orderpriority = '1-URGENT'""",
    "refund": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS refund_id,
          l_orderkey || CASE l_returnflag WHEN 'R' THEN '-1' WHEN 'A' THEN '-2' ELSE '-3' END
            AS payment_id,
          CASE l_linenumber WHEN 1 THEN 'CUSTOMER_REQUEST' WHEN 2 THEN 'DEFECTIVE_PRODUCT'
            WHEN 3 THEN 'WRONG_ITEM' WHEN 4 THEN 'DUPLICATE_CHARGE' ELSE 'FRAUD' END AS reason,
          l_extendedprice::DECIMAL(12,2) AS amount_chf,
          CASE WHEN l_linenumber = 1 THEN 'PENDING' WHEN l_linenumber IN (2, 5) THEN 'APPROVED'
            WHEN l_linenumber IN (3, 4) THEN 'PROCESSED' ELSE 'REJECTED' END AS status,
          l_shipdate::DATE AS created_at,
          CASE WHEN l_linenumber <> 1 THEN l_shipdate::DATE END AS processed_at
        FROM lineitem""",
    # Expected rows of the feeds --------------------------------------------
    "event_items": """
        SELECT *, regexp_extract(props, '([0-9]+)', 1)::INTEGER AS k
        FROM events WHERE event_type <> 'error'""",
    "flat_connections": """
        SELECT date_trunc('second', ts) AS departure, 'U' || user_id AS from_station,
          value AS from_latitude, k::DOUBLE AS from_longitude, 'T' || k AS to_station,
          '00d00:10:00' AS duration, 'IC' || (k % 7) AS product, 'OP' AS operator,
          event_type AS category, CASE WHEN event_type <> 'view' THEN k END AS delay_minutes,
          CASE WHEN event_type = 'click' THEN (k % 10)::VARCHAR END AS platform
        FROM event_items""",
    "flat_stationboard": """
        SELECT 'J' || event_id AS fahrt_bezeichner, 'U' || user_id AS station_name,
          'S' || (k % 9) AS line_text, event_type AS product, ts AS scheduled_departure,
          ts AS scheduled_arrival,
          CASE WHEN event_type <> 'view' THEN ts + to_seconds(k * 7) END AS forecast_departure,
          ts AS forecast_arrival, k > 50 AS has_departure_delay, k > 90 AS has_arrival_delay,
          k = 0 AS is_cancelled, 'OP' AS operator_name, ts::DATE::VARCHAR AS operating_day,
          'Stop ' || user_id AS official_name, lpad(user_id::VARCHAR, 7, '0') AS bpuic,
          event_type AS transport_type
        FROM event_items""",
    "flat_stations": """
        SELECT 'W' || user_id AS station_id, 'Station ' || user_id AS station_name,
          ts AS last_update, value AS longitude, k::DOUBLE AS latitude,
          CASE event_type WHEN 'view' THEN NULL WHEN 'signup' THEN 1 ELSE 2 END::INTEGER
            AS num_assets
        FROM event_items""",
    # Marts -----------------------------------------------------------------
    "customers": """
        SELECT bc.* EXCLUDE (contact_name, contact_email, phone),
          p.contact_id AS primary_contact_id, p.first_name AS primary_contact_first_name,
          p.last_name AS primary_contact_last_name, p.role AS primary_contact_role,
          p.email AS primary_contact_email, p.phone AS primary_contact_phone
        FROM business_customer bc LEFT JOIN customer_contact p
          ON p.customer_id = bc.customer_id AND p.is_primary""",
    "position_ranks": """
        SELECT *, count(*) OVER (PARTITION BY vehicle_id) AS total_positions,
          row_number() OVER (PARTITION BY vehicle_id
            ORDER BY recorded_at DESC NULLS FIRST, position_id DESC) AS place
        FROM gps_position""",
    "fleet": """
        SELECT v.*, r.recorded_at AS latest_recorded_at, r.latitude AS latest_latitude,
          r.longitude AS latest_longitude, r.speed_kmh AS latest_speed_kmh,
          r.heading_degrees AS latest_heading_degrees, r.is_moving AS latest_is_moving,
          r.total_positions
        FROM vehicle v LEFT JOIN position_ranks r ON r.vehicle_id = v.vehicle_id AND r.place = 1""",
    "zone_totals": """
        SELECT warehouse_id, count(*) AS total_zones,
          sum(capacity_pallets) AS total_zone_capacity_pallets,
          count(*) FILTER (temperature_controlled) AS temp_controlled_zones,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'STORAGE'), 0) AS storage_capacity_pallets,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'COLD'), 0) AS cold_capacity_pallets,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'HAZMAT'), 0) AS hazmat_capacity_pallets,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'RECEIVING'), 0) AS receiving_capacity_pallets,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'LOADING'), 0) AS loading_capacity_pallets,
          coalesce(sum(capacity_pallets) FILTER (zone_type = 'RETURNS'), 0) AS returns_capacity_pallets
        FROM warehouse_zone GROUP BY warehouse_id""",
    "warehouses": """
        SELECT w.* RENAME (capacity_pallets AS warehouse_capacity_pallets),
          z.* EXCLUDE (warehouse_id)
        FROM warehouse w LEFT JOIN zone_totals z ON z.warehouse_id = w.warehouse_id""",
    "order_totals": """
        SELECT h.* RENAME (total_amount_chf AS header_total_chf),
          count(i.order_id) AS line_item_count, coalesce(sum(i.quantity), 0) AS total_quantity,
          coalesce(sum(i.line_total_chf), 0) AS calculated_total_chf,
          count(DISTINCT i.product_id) AS distinct_product_count
        FROM order_header h LEFT JOIN order_line_item i ON i.order_id = h.order_id
        GROUP BY ALL""",
    "products": """
        SELECT p.* EXCLUDE (hs_tariff_code),
          t.* EXCLUDE (product_id) RENAME (description AS tariff_description),
          round(p.unit_price_chf * t.duty_rate_pct * 0.01, 2) AS duty_amount_chf,
          round(p.unit_price_chf * t.vat_rate_pct * 0.01, 2) AS vat_amount_chf,
          round(p.unit_price_chf * (100 + t.vat_rate_pct + t.duty_rate_pct) * 0.01, 2)
            AS total_landed_cost_chf
        FROM product p LEFT JOIN product_tariff t ON t.product_id = p.product_id""",
    "scan_ranks": """
        SELECT *, count(*) OVER (PARTITION BY shipment_id) AS total_events,
          row_number() OVER (PARTITION BY shipment_id
            ORDER BY event_timestamp DESC NULLS FIRST, event_id DESC, event_type DESC,
              latitude DESC, longitude DESC, notes DESC) AS place
        FROM tracking_event""",
    "shipments": """
        SELECT s.*, r.event_type AS latest_event_type, r.event_timestamp AS latest_event_timestamp,
          r.location_name AS latest_location, r.latitude AS latest_latitude,
          r.longitude AS latest_longitude, r.notes AS latest_notes, r.total_events
        FROM shipment s LEFT JOIN scan_ranks r ON r.shipment_id = s.shipment_id AND r.place = 1""",
    "merchants": """
        SELECT m.*, count(p.payout_id) AS payout_count,
          coalesce(sum(p.gross_amount_chf), 0) AS total_gross_amount_chf,
          coalesce(sum(p.fee_amount_chf), 0) AS total_fee_amount_chf,
          coalesce(sum(p.net_amount_chf), 0) AS total_net_amount_chf,
          coalesce(sum(p.net_amount_chf) FILTER (p.status = 'PAID'), 0) AS total_paid_amount_chf,
          min(p.period_start) AS first_payout_period, max(p.period_end) AS last_payout_period
        FROM merchant_account m LEFT JOIN payout p ON p.merchant_id = m.merchant_id GROUP BY ALL""",
    "transactions": """
        SELECT p.*, coalesce(r.n, 0) AS refund_count, coalesce(r.total, 0) AS total_refund_amount_chf,
          coalesce(r.processed, FALSE) AS has_processed_refund,
          p.amount_chf - coalesce(r.total, 0) AS net_amount_chf
        FROM payment p LEFT JOIN (
          SELECT payment_id, count(*) AS n, sum(amount_chf) AS total,
            bool_or(status = 'PROCESSED') AS processed
          FROM refund GROUP BY payment_id) r ON r.payment_id = p.payment_id""",
    "rail": """
        SELECT departure, from_station AS station_name, product AS line_text, category AS product,
          operator, from_latitude AS latitude, from_longitude AS longitude, delay_minutes,
          platform, 'transport_opendata' AS data_source FROM flat_connections
        UNION ALL BY NAME
        SELECT scheduled_departure AS departure, station_name, line_text, product,
          operator_name AS operator,
          if(has_departure_delay,
            coalesce(datediff('minute', scheduled_departure, forecast_departure), 0), 0)::INTEGER
            AS delay_minutes, 'sbb_stationboard' AS data_source FROM flat_stationboard""",
    "fulfillment": """
        SELECT order_id, o.customer_id, o.order_date, o.status AS order_status,
          o.header_total_chf AS order_total_chf, s.shipment_id, s.status AS shipment_status,
          s.vehicle_id, s.origin_warehouse, s.destination_city, s.shipped_at, s.delivered_at,
          datediff('day', s.shipped_at, s.delivered_at) AS delivery_days, t.payment_id,
          t.payment_method, t.status AS payment_status, t.amount_chf AS payment_amount_chf,
          t.net_amount_chf AS net_payment_chf
        FROM order_totals o LEFT JOIN shipments s USING (order_id)
          LEFT JOIN transactions t USING (order_id)""",
    "customer_360": """
        SELECT c.customer_id, c.company_name, c.legal_form, c.city, c.canton, c.is_active,
          c.created_at, c.primary_contact_email, coalesce(o.n, 0) AS total_orders,
          coalesce(o.total, 0) AS total_order_value_chf, o.first_order_date, o.last_order_date,
          m.merchant_id, m.merchant_name, m.business_type, m.merchant_id IS NOT NULL AS is_merchant
        FROM customers c LEFT JOIN merchants m USING (customer_id)
          LEFT JOIN (SELECT customer_id, count(*) AS n, sum(header_total_chf) AS total,
                       min(order_date) AS first_order_date, max(order_date) AS last_order_date
                     FROM order_totals GROUP BY customer_id) o USING (customer_id)""",
    "routes": """
        SELECT s.origin_warehouse, s.destination_city,
          count(DISTINCT s.shipment_id) AS total_shipments,
          count(DISTINCT order_id) AS total_orders, sum(o.header_total_chf) AS total_revenue_chf,
          sum(t.amount_chf) AS total_payments_chf, sum(t.total_refund_amount_chf) AS total_refunds_chf,
          sum(t.net_amount_chf) AS net_revenue_chf,
          avg(datediff('day', s.shipped_at, s.delivered_at)) AS avg_delivery_days,
          avg(o.header_total_chf) AS avg_order_value_chf
        FROM shipments s JOIN order_totals o USING (order_id) JOIN transactions t USING (order_id)
        GROUP BY ALL""",
    "report": """
        SELECT t.payment_id, order_id, o.customer_id, c.company_name, t.amount_chf,
          t.payment_method, t.status AS payment_status, t.is_international, t.requires_aml_check,
          s.shipment_id, s.requires_customs, s.customs_declaration_id, t.created_at, t.processed_at
        FROM transactions t JOIN order_totals o USING (order_id)
          LEFT JOIN shipments s USING (order_id)
          LEFT JOIN customers c ON c.customer_id = o.customer_id""",
}


def sql(query: str) -> str:
    """The query with the sub-queries it uses, directly or not, in front."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                need(TABLES[name])

    need(query)
    parts = [f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + query
