"""Table schemas, keys, accepted values, feeds.

Everything in this module is data that must agree with the source system for
results to be right. There is no logic here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: staging types of the 16 seed tables, columns in file order.
SEEDS: dict[str, str] = {
    "business_customer": """
        customer_id string, company_name string, legal_form string, street string,
        postal_code string, city string, canton string, country string,
        contact_name string, contact_email string, phone string,
        is_active boolean, created_at date""",
    "customer_contact": """
        contact_id string, customer_id string, first_name string, last_name string,
        role string, email string, phone string, is_primary boolean""",
    "vehicle": """
        vehicle_id string, plate_number string, vehicle_type string, make string,
        model string, year int, capacity_kg int, capacity_m3 double,
        fuel_type string, home_base string, is_active boolean, last_service_date date""",
    "gps_position": """
        position_id string, vehicle_id string, recorded_at timestamp_ntz,
        latitude double, longitude double, speed_kmh double,
        heading_degrees double, is_moving boolean""",
    "warehouse": """
        warehouse_id string, warehouse_name string, street string, postal_code string,
        city string, canton string, latitude double, longitude double,
        capacity_pallets int, is_active boolean""",
    "warehouse_zone": """
        zone_id string, warehouse_id string, zone_name string, zone_type string,
        capacity_pallets int, temperature_controlled boolean""",
    "order_header": """
        order_id string, customer_id string, order_date date, status string,
        delivery_street string, delivery_postal_code string, delivery_city string,
        total_amount_chf decimal(12,2), currency string, warehouse_origin string""",
    "order_line_item": """
        line_item_id string, order_id string, product_id string,
        quantity decimal(10,0), unit_price_chf decimal(10,2),
        line_total_chf decimal(12,2)""",
    "product": """
        product_id string, product_name string, category string,
        hs_tariff_code string, weight_kg decimal(10,2), unit_price_chf decimal(10,2),
        currency string, origin_country string, is_hazardous boolean,
        requires_customs_declaration boolean, created_at date""",
    "product_tariff": """
        tariff_id string, product_id string, hs_code string, description string,
        duty_rate_pct decimal(5,2), vat_rate_pct decimal(5,2),
        preferential_rate_pct decimal(5,2)""",
    "shipment": """
        shipment_id string, order_id string, vehicle_id string,
        origin_warehouse string, destination_city string,
        destination_postal_code string, status string, created_at timestamp_ntz,
        shipped_at timestamp_ntz, delivered_at timestamp_ntz, weight_kg double,
        volume_m3 double, requires_customs boolean, customs_declaration_id string""",
    "tracking_event": """
        event_id string, shipment_id string, event_type string,
        event_timestamp timestamp_ntz, location_name string, latitude double,
        longitude double, notes string""",
    "merchant_account": """
        merchant_id string, merchant_name string, business_type string,
        registration_number string, bank_account_iban string,
        settlement_currency string, fee_rate_pct decimal(4,2), customer_id string,
        is_active boolean, onboarded_at date""",
    "payout": """
        payout_id string, merchant_id string, period_start date, period_end date,
        gross_amount_chf decimal(12,2), fee_amount_chf decimal(12,2),
        net_amount_chf decimal(12,2), status string, paid_at date""",
    "payment": """
        payment_id string, order_id string, merchant_id string,
        amount_chf decimal(12,2), currency string, payment_method string,
        card_brand string, status string, created_at date, processed_at date,
        is_international boolean, requires_aml_check boolean""",
    "refund": """
        refund_id string, payment_id string, reason string,
        amount_chf decimal(12,2), status string, created_at date, processed_at date""",
}

# --- Fixed values: the data product each seed table belongs to.
SEED_PRODUCT: dict[str, str] = {
    "business_customer": "customers",
    "customer_contact": "customers",
    "vehicle": "fleet",
    "gps_position": "fleet",
    "warehouse": "locations",
    "warehouse_zone": "locations",
    "order_header": "orders",
    "order_line_item": "orders",
    "product": "products",
    "product_tariff": "products",
    "shipment": "shipments",
    "tracking_event": "shipments",
    "merchant_account": "merchants",
    "payout": "merchants",
    "payment": "transactions",
    "refund": "transactions",
}

# --- Fixed values: zone types that get a capacity column of their own.
ZONE_TYPES = ("STORAGE", "COLD", "HAZMAT", "RECEIVING", "LOADING", "RETURNS")


@dataclass(frozen=True)
class TableChecks:
    """Declared column checks of one table.

    ``key`` columns are unique and not null, ``required`` columns are not null,
    ``accepted`` maps a column to its allowed values and ``refs`` maps a column
    to the (table, column) it must exist in.
    """

    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    refs: dict[str, tuple[str, str]] = field(default_factory=dict)


# --- Fixed values: declared checks per table.
CHECKS: dict[str, TableChecks] = {
    # staging, customers
    "stg_business_customer": TableChecks(key=("customer_id",)),
    "stg_customer_contact": TableChecks(
        key=("contact_id",),
        required=("customer_id",),
        refs={"customer_id": ("stg_business_customer", "customer_id")},
    ),
    # staging, fleet
    "stg_vehicle": TableChecks(
        key=("vehicle_id",),
        accepted={
            "vehicle_type": ("TRUCK", "VAN", "TRAILER", "ELECTRIC_VAN", "HYBRID"),
            "fuel_type": ("DIESEL", "ELECTRIC", "HYBRID"),
        },
    ),
    "stg_gps_position": TableChecks(
        key=("position_id",),
        required=("vehicle_id",),
        refs={"vehicle_id": ("stg_vehicle", "vehicle_id")},
    ),
    # staging, locations
    "stg_warehouse": TableChecks(key=("warehouse_id",)),
    "stg_warehouse_zone": TableChecks(
        key=("zone_id",),
        required=("warehouse_id",),
        accepted={
            "zone_type": ("RECEIVING", "STORAGE", "COLD", "HAZMAT", "LOADING", "RETURNS")
        },
        refs={"warehouse_id": ("stg_warehouse", "warehouse_id")},
    ),
    # staging, orders
    "stg_order_header": TableChecks(
        key=("order_id",),
        required=("customer_id",),
        accepted={
            "status": ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"),
            "warehouse_origin": ("Basel", "Zürich", "Bern"),
        },
    ),
    "stg_order_line_item": TableChecks(
        key=("line_item_id",),
        required=("order_id", "product_id"),
        refs={"order_id": ("stg_order_header", "order_id")},
    ),
    # staging, products
    "stg_product": TableChecks(key=("product_id",)),
    "stg_product_tariff": TableChecks(
        key=("tariff_id",),
        required=("product_id",),
        refs={"product_id": ("stg_product", "product_id")},
    ),
    # staging, shipments
    "stg_shipment": TableChecks(
        key=("shipment_id",),
        required=("order_id", "vehicle_id"),
        accepted={
            "status": (
                "CREATED",
                "PICKED_UP",
                "IN_TRANSIT",
                "CUSTOMS_HOLD",
                "DELIVERED",
                "RETURNED",
            )
        },
    ),
    "stg_tracking_event": TableChecks(
        key=("event_id",),
        required=("shipment_id",),
        accepted={
            "event_type": (
                "CREATED",
                "PICKED_UP",
                "DEPARTED",
                "ARRIVED",
                "CUSTOMS_CHECK",
                "OUT_FOR_DELIVERY",
                "DELIVERED",
            )
        },
        refs={"shipment_id": ("stg_shipment", "shipment_id")},
    ),
    # staging, merchants
    "stg_merchant_account": TableChecks(
        key=("merchant_id",),
        required=("customer_id",),
        accepted={"business_type": ("RETAIL", "ECOMMERCE", "B2B", "MARKETPLACE")},
    ),
    "stg_payout": TableChecks(
        key=("payout_id",),
        required=("merchant_id",),
        accepted={"status": ("CALCULATED", "APPROVED", "PAID")},
        refs={"merchant_id": ("stg_merchant_account", "merchant_id")},
    ),
    # staging, transactions
    "stg_payment": TableChecks(
        key=("payment_id",),
        required=("order_id", "merchant_id"),
        accepted={
            "payment_method": (
                "CREDIT_CARD",
                "DEBIT_CARD",
                "TWINT",
                "BANK_TRANSFER",
                "CRYPTO",
            ),
            "status": (
                "PENDING",
                "AUTHORIZED",
                "CAPTURED",
                "REFUNDED",
                "CHARGEBACK",
                "FAILED",
            ),
        },
    ),
    "stg_refund": TableChecks(
        key=("refund_id",),
        required=("payment_id",),
        accepted={
            "reason": (
                "CUSTOMER_REQUEST",
                "DEFECTIVE_PRODUCT",
                "WRONG_ITEM",
                "DUPLICATE_CHARGE",
                "FRAUD",
            ),
            "status": ("PENDING", "APPROVED", "PROCESSED", "REJECTED"),
        },
        refs={"payment_id": ("stg_payment", "payment_id")},
    ),
    # staging, feeds
    "stg_transport_connections": TableChecks(required=("departure",)),
    "stg_sbb_stationboard": TableChecks(required=("fahrt_bezeichner", "station_name")),
    "stg_meteoswiss_stations": TableChecks(
        required=("station_id", "station_name", "longitude", "latitude")
    ),
    # domain marts
    "mart_customer_overview": TableChecks(key=("customer_id",)),
    "mart_fleet_status": TableChecks(key=("vehicle_id",)),
    "mart_warehouse_capacity": TableChecks(key=("warehouse_id",)),
    "mart_swiss_rail_overview": TableChecks(
        required=("departure", "station_name"),
        accepted={"data_source": ("transport_opendata", "sbb_stationboard")},
    ),
    "mart_order_summary": TableChecks(key=("order_id",), required=("customer_id",)),
    "mart_product_catalog": TableChecks(key=("product_id",)),
    "mart_shipment_tracking": TableChecks(key=("shipment_id",)),
    "mart_merchant_overview": TableChecks(key=("merchant_id",)),
    "mart_transaction_summary": TableChecks(key=("payment_id",)),
    # enterprise marts
    "fulfillment_lifecycle": TableChecks(required=("order_id", "customer_id")),
    "customer_overview": TableChecks(key=("customer_id",), required=("company_name",)),
    "revenue_by_route": TableChecks(required=("origin_warehouse", "destination_city")),
    "transaction_report": TableChecks(required=("payment_id", "order_id")),
    "mart_weather_station_catalog": TableChecks(
        key=("station_id",), required=("station_name", "latitude", "longitude")
    ),
}


@dataclass(frozen=True)
class Feed:
    """One landed feed: how it is wrapped, how often it runs, where its key is."""

    table: str
    product: str
    wrap: str  # json | body | text | lines
    period: str
    key_path: str | None


# --- Fixed values: the polled feeds. A key path leads from the payload to the offset of its
# first element; text and line payloads have none.
FEEDS: dict[str, Feed] = {
    "transport_connections": Feed(
        "transport_connections", "locations", "body", "5 minutes", "$.connections[0].from.departure"
    ),
    "sbb_stationboard": Feed("sbb_stationboard", "shipments", "body", "1 minute", "$.results[0].bpuic"),
    "sbb_ist_daten": Feed("sbb_ist_daten", "shipments", "lines", "1 day", None),
    "ecb_exchange_rates": Feed(
        "ecb_exchange_rates", "transactions", "text", "1 day", None
    ),
    "meteoswiss_measurements": Feed(
        "meteoswiss_measurements", "weather", "body", "10 minutes", "$.features[0].id"
    ),
    "astra_traffic_counts": Feed("astra_traffic_counts", "fleet", "body", "1 day", "$.id"),
    "swiss_plz_directory": Feed("swiss_plz_directory", "locations", "body", "1 day", "$.id"),
    "bazg_foreign_trade": Feed("bazg_foreign_trade", "shipments", "text", "1 day", None),
}

# --- Fixed values: JSON paths and types of the flattened feeds.
CONNECTION_FIELDS: dict[str, tuple[str, str]] = {
    "departure": ("$.from.departure", "string"),
    "from_station": ("$.from.station.name", "string"),
    "from_latitude": ("$.from.station.coordinate.x", "double"),
    "from_longitude": ("$.from.station.coordinate.y", "double"),
    "to_station": ("$.to.station.name", "string"),
    "duration": ("$.duration", "string"),
    "product": ("$.products[0]", "string"),
    "operator": ("$.sections[0].journey.operator", "string"),
    "category": ("$.sections[0].journey.category", "string"),
    "delay_minutes": ("$.from.delay", "int"),
    "platform": ("$.from.platform", "string"),
}

STATIONBOARD_FIELDS: dict[str, tuple[str, str]] = {
    "fahrt_bezeichner": ("$.fahrt_bezeichner", "string"),
    "station_name": ("$.haltestellen_name", "string"),
    "line_text": ("$.linien_text", "string"),
    "product": ("$.produkt_id", "string"),
    "scheduled_departure": ("$.abfahrtszeit", "timestamp_ntz"),
    "scheduled_arrival": ("$.ankunftszeit", "timestamp_ntz"),
    "forecast_departure": ("$.ab_prognose", "timestamp_ntz"),
    "forecast_arrival": ("$.an_prognose", "timestamp_ntz"),
    "has_departure_delay": ("$.abfahrtsverspatung", "boolean"),
    "has_arrival_delay": ("$.ankunftsverspatung", "boolean"),
    "is_cancelled": ("$.faellt_aus_tf", "boolean"),
    "operator_name": ("$.betreiber_name", "string"),
    "operating_day": ("$.betriebstag", "string"),
    "official_name": ("$.bezeichnung_offiziell", "string"),
    "bpuic": ("$.bpuic", "string"),
    "transport_type": ("$.verkehrsmittel_text", "string"),
}

STATION_FIELDS: dict[str, tuple[str, str]] = {
    "station_id": ("$.id", "string"),
    "station_name": ("$.properties.title", "string"),
    "last_update": ("$.properties.datetime", "timestamp_ntz"),
    "longitude": ("$.geometry.coordinates[0]", "double"),
    "latitude": ("$.geometry.coordinates[1]", "double"),
}

# --- Fixed values: time format of connection departures, and the catalogue link.
DEPARTURE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
DEPARTURE_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{4}$"
CATALOGUE_LINK = (
    r'href="(https://data[.]opentransportdata[.]swiss/dataset/'
    r'[^"]+/download/[^"]+_istdaten[.]csv)"'
)
