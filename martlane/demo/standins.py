"""The driver's tables in the shape of the seed tables and feeds.

Each stand-in keeps every row of the table it is made from. Ids and categories
are mapped from columns of that table, so keys repeat, miss and fan out the
way the marts have to cope with.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.operators.heavy import heavy_keys, summarize
from martlane.operators.joins import HOT_ROWS
from martlane.plans import enterprise, feeds, logistics, payments, staging
from martlane.plans.build import build_all
from martlane.session import stored, tune, work_folder
from martlane.sources.schemas import SEEDS
from martlane.sources.seeds import seed_columns
from martlane.sources.tables import Catalog


def _case(column: str, mapping: dict[str, str], other: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE '{other}' END"


ORDER_STATUS = _case(
    "o_orderpriority",
    {
        "1-URGENT": "PENDING",
        "2-HIGH": "CONFIRMED",
        "3-MEDIUM": "SHIPPED",
        "4-NOT SPECIFIED": "DELIVERED",
    },
    "CANCELLED",
)
ORDER_ORIGIN = _case("o_orderstatus", {"F": "Basel", "O": "Zürich"}, "Bern")
PAYMENT_METHOD = _case(
    "o_orderpriority",
    {
        "1-URGENT": "CREDIT_CARD",
        "2-HIGH": "DEBIT_CARD",
        "3-MEDIUM": "TWINT",
        "4-NOT SPECIFIED": "BANK_TRANSFER",
    },
    "CRYPTO",
)
PAYMENT_STATUS = _case("o_orderstatus", {"F": "CAPTURED", "O": "AUTHORIZED"}, "PENDING")
VEHICLE_TYPE = _case(
    "c_mktsegment",
    {
        "MACHINERY": "TRUCK",
        "BUILDING": "VAN",
        "AUTOMOBILE": "TRAILER",
        "FURNITURE": "ELECTRIC_VAN",
    },
    "HYBRID",
)
FUEL_TYPE = _case("c_mktsegment", {"FURNITURE": "ELECTRIC", "HOUSEHOLD": "HYBRID"}, "DIESEL")
ZONE_TYPE = (
    "CASE WHEN c_acctbal < 0 THEN 'RETURNS' ELSE "
    + _case(
        "c_mktsegment",
        {
            "MACHINERY": "HAZMAT",
            "BUILDING": "STORAGE",
            "AUTOMOBILE": "LOADING",
            "FURNITURE": "COLD",
        },
        "RECEIVING",
    )
    + " END"
)
BUSINESS_TYPE = _case(
    "c_mktsegment",
    {"MACHINERY": "B2B", "BUILDING": "B2B", "HOUSEHOLD": "RETAIL", "FURNITURE": "ECOMMERCE"},
    "MARKETPLACE",
)
EVENT_TYPE = _case(
    "CAST(l_linenumber AS STRING)",
    {
        "1": "CREATED",
        "2": "PICKED_UP",
        "3": "DEPARTED",
        "4": "ARRIVED",
        "5": "CUSTOMS_CHECK",
        "6": "OUT_FOR_DELIVERY",
    },
    "DELIVERED",
)
REFUND_REASON = _case(
    "CAST(l_linenumber AS STRING)",
    {"1": "CUSTOMER_REQUEST", "2": "DEFECTIVE_PRODUCT", "3": "WRONG_ITEM", "4": "DUPLICATE_CHARGE"},
    "FRAUD",
)
REFUND_STATUS = _case(
    "CAST(l_linenumber AS STRING)",
    {"1": "PENDING", "2": "APPROVED", "3": "PROCESSED", "4": "PROCESSED", "5": "APPROVED"},
    "REJECTED",
)


# Lists of heavy keys by session, folder, table and key.
_HEAVY: dict[tuple[str, ...], DataFrame] = {}


# Rows of a seed file at most.
SEED_ROWS = 1_000_000

# Tables built from CSV seeds, by session and folder.
_BUILT: dict[tuple[str, ...], tuple[Catalog, dict[str, DataFrame]]] = {}


class Standins:
    """Raw stand-ins, staging and marts over one data folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}
        self._stages: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """A driver table; its footer is read once for the schema."""
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    # Raw stand-ins --------------------------------------------------------

    def raw_business_customer(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "c_custkey AS customer_id",
            "c_name AS company_name",
            "c_mktsegment AS legal_form",
            "concat('Street ', c_nationkey) AS street",
            "lpad(c_nationkey, 4, '0') AS postal_code",
            "concat('NATION_', c_nationkey) AS city",
            "concat('C', c_nationkey) AS canton",
            "'CH' AS country",
            "c_name AS contact_name",
            "concat('c', c_custkey, '@example.com') AS contact_email",
            "concat('+41 44 ', lpad(c_custkey, 7, '0')) AS phone",
            "c_acctbal > 0 AS is_active",
            "date_add(DATE'2020-01-01', c_nationkey) AS created_at",
        )

    def raw_customer_contact(self) -> DataFrame:
        return self.source("supplier").selectExpr(
            "s_suppkey AS contact_id",
            "s_suppkey - s_suppkey % 2 AS customer_id",
            "s_name AS first_name",
            "concat('L', s_nationkey) AS last_name",
            "IF(s_nationkey < 10, 'BUYER', 'OWNER') AS role",
            "concat('s', s_suppkey, '@example.com') AS email",
            "concat('+41 31 ', s_suppkey) AS phone",
            "s_acctbal > 1000 AS is_primary",
        )

    def raw_vehicle(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "c_custkey AS vehicle_id",
            "concat('ZH ', c_custkey) AS plate_number",
            f"{VEHICLE_TYPE} AS vehicle_type",
            "c_mktsegment AS make",
            "concat('M', c_nationkey) AS model",
            "2000 + c_nationkey AS year",
            "c_nationkey * 100 AS capacity_kg",
            "c_acctbal AS capacity_m3",
            f"{FUEL_TYPE} AS fuel_type",
            "concat('NATION_', c_nationkey) AS home_base",
            "c_acctbal > 0 AS is_active",
            "date_add(DATE'2023-01-01', c_nationkey) AS last_service_date",
        )

    def raw_gps_position(self) -> DataFrame:
        return self.source("events").selectExpr(
            "event_id AS position_id",
            "user_id AS vehicle_id",
            "ts AS recorded_at",
            "value AS latitude",
            "get_json_object(props, '$.k') AS longitude",
            "value AS speed_kmh",
            "get_json_object(props, '$.k') AS heading_degrees",
            "event_type IN ('click', 'view') AS is_moving",
        )

    def raw_warehouse(self) -> DataFrame:
        nations, regions = self.source("nation"), self.source("region")
        placed = self.source("supplier").join(nations, F.expr("s_nationkey = n_nationkey"), "left")
        placed = placed.join(regions, F.expr("n_regionkey = r_regionkey"), "left")
        return placed.selectExpr(
            "s_suppkey AS warehouse_id",
            "s_name AS warehouse_name",
            "concat('Street ', s_nationkey) AS street",
            "lpad(s_nationkey, 4, '0') AS postal_code",
            "n_name AS city",
            "r_name AS canton",
            "s_acctbal AS latitude",
            "s_nationkey AS longitude",
            "s_nationkey * 100 AS capacity_pallets",
            "s_acctbal > 0 AS is_active",
        )

    def raw_warehouse_zone(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "c_custkey AS zone_id",
            "c_nationkey AS warehouse_id",
            "c_name AS zone_name",
            f"{ZONE_TYPE} AS zone_type",
            "c_custkey % 100 AS capacity_pallets",
            "c_acctbal > 5000 AS temperature_controlled",
        )

    def raw_order_header(self) -> DataFrame:
        return self.source("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderdate AS order_date",
            f"{ORDER_STATUS} AS status",
            "concat('Street ', o_custkey) AS delivery_street",
            "lpad(o_custkey % 10000, 4, '0') AS delivery_postal_code",
            "concat('N', o_custkey % 25) AS delivery_city",
            "o_totalprice AS total_amount_chf",
            "'CHF' AS currency",
            f"{ORDER_ORIGIN} AS warehouse_origin",
        )

    def raw_order_line_item(self) -> DataFrame:
        return self.source("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS line_item_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_quantity AS quantity",
            "l_extendedprice AS unit_price_chf",
            "l_extendedprice AS line_total_chf",
        )

    def raw_product(self) -> DataFrame:
        return self.source("part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "p_brand AS hs_tariff_code",
            "p_size AS weight_kg",
            "p_retailprice AS unit_price_chf",
            "'CHF' AS currency",
            "p_brand AS origin_country",
            "p_size > 40 AS is_hazardous",
            "p_size >= 25 AS requires_customs_declaration",
            "date_add(DATE'2021-01-01', p_size) AS created_at",
        )

    def raw_product_tariff(self) -> DataFrame:
        """Two tariffs for PROMO goods, one of an unknown product for STANDARD goods, else one."""
        numbers = F.expr("IF(p_type = 'PROMO', array(1, 2), array(1))")
        return (
            self.source("part")
            .withColumn("n", F.explode(numbers))
            .selectExpr(
                "concat(p_partkey, '-', n) AS tariff_id",
                "IF(p_type = 'STANDARD', concat('old-', p_partkey), CAST(p_partkey AS STRING)) AS product_id",
                "lpad(p_size, 8, '0') AS hs_code",
                "concat(p_type, ' ', p_brand) AS description",
                "p_size % 9 + n AS duty_rate_pct",
                "IF(p_type IN ('ECONOMY', 'SMALL'), 2.50, 7.70) AS vat_rate_pct",
                "p_size % 3 AS preferential_rate_pct",
            )
        )

    def raw_shipment(self) -> DataFrame:
        """One shipment per order and return flag."""
        return (
            self.source("lineitem")
            .groupBy("l_orderkey", "l_returnflag")
            .agg(
                F.min("l_suppkey").alias("supp"),
                F.max("l_partkey").alias("part"),
                F.min("l_shipdate").alias("first"),
                F.max("l_shipdate").alias("last"),
                F.max(F.expr("CAST(l_linestatus <> 'F' AS INT)")).alias("open_lines"),
                F.sum("l_quantity").alias("weight"),
                F.max("l_quantity").alias("volume"),
                F.max("l_tax").alias("tax"),
                F.max("l_discount").alias("discount"),
            )
            .selectExpr(
                "concat(l_orderkey, '-', l_returnflag) AS shipment_id",
                "l_orderkey AS order_id",
                "supp AS vehicle_id",
                "concat('W', supp % 8) AS origin_warehouse",
                "concat('N', part % 25) AS destination_city",
                "lpad(part % 25, 4, '0') AS destination_postal_code",
                "IF(open_lines = 0, 'DELIVERED', 'IN_TRANSIT') AS status",
                "first AS created_at",
                "first AS shipped_at",
                "IF(open_lines = 0, last, NULL) AS delivered_at",
                "weight AS weight_kg",
                "volume AS volume_m3",
                "tax > 0.05D AS requires_customs",
                "IF(tax > 0.05D AND discount > 0.05D, concat('CD', l_orderkey), NULL)"
                " AS customs_declaration_id",
            )
        )

    def raw_tracking_event(self) -> DataFrame:
        """Every line is a scan; lines still open belong to no shipment."""
        return self.source("lineitem").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id",
            "concat(l_orderkey, '-', IF(l_linestatus = 'F', l_returnflag, 'open')) AS shipment_id",
            f"{EVENT_TYPE} AS event_type",
            "l_shipdate AS event_timestamp",
            "concat('S', l_suppkey) AS location_name",
            "l_quantity AS latitude",
            "l_extendedprice AS longitude",
            "l_linestatus AS notes",
        )

    def raw_merchant_account(self) -> DataFrame:
        return self.source("customer").selectExpr(
            "c_custkey AS merchant_id",
            "c_name AS merchant_name",
            f"{BUSINESS_TYPE} AS business_type",
            "concat('CHE-', c_custkey) AS registration_number",
            "concat('CH93', lpad(c_custkey, 17, '0')) AS bank_account_iban",
            "'CHF' AS settlement_currency",
            "c_nationkey AS fee_rate_pct",
            "c_custkey - c_custkey % 3 AS customer_id",
            "c_acctbal > 0 AS is_active",
            "date_add(DATE'2022-01-01', c_nationkey) AS onboarded_at",
        )

    def raw_payout(self) -> DataFrame:
        """One payout per supplier and month of shipping."""
        month = F.trunc(F.to_date("l_shipdate"), "month")
        return (
            self.source("lineitem")
            .groupBy("l_suppkey", month.alias("month"))
            .agg(
                F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("gross"),
                F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("fee"),
            )
            .selectExpr(
                "concat(l_suppkey, '-', month) AS payout_id",
                "l_suppkey AS merchant_id",
                "month AS period_start",
                "last_day(month) AS period_end",
                "gross AS gross_amount_chf",
                "fee AS fee_amount_chf",
                "gross - fee AS net_amount_chf",
                "CASE WHEN month(month) <= 4 THEN 'PAID' WHEN month(month) <= 8 THEN 'APPROVED'"
                " ELSE 'CALCULATED' END AS status",
                "IF(month(month) <= 4, last_day(month), NULL) AS paid_at",
            )
        )

    def raw_payment(self) -> DataFrame:
        """Urgent orders are paid twice; the second payment of an open one has no order."""
        numbers = F.expr("IF(o_orderpriority = '1-URGENT', array(1, 2), array(1))")
        return (
            self.source("orders")
            .withColumn("n", F.explode(numbers))
            .selectExpr(
                "concat(o_orderkey, '-', n) AS payment_id",
                "IF(n = 2 AND o_orderstatus = 'P', NULL, o_orderkey) AS order_id",
                "o_custkey AS merchant_id",
                "o_totalprice AS amount_chf",
                "'CHF' AS currency",
                f"{PAYMENT_METHOD} AS payment_method",
                "IF(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'VISA', NULL) AS card_brand",
                f"{PAYMENT_STATUS} AS status",
                "o_orderdate AS created_at",
                "IF(o_orderstatus = 'F', date_add(to_date(o_orderdate), n), NULL) AS processed_at",
                "o_custkey % 4 = 0 AS is_international",
                "o_totalprice > 400000 AS requires_aml_check",
            )
        )

    def raw_refund(self) -> DataFrame:
        """A refund per line: returned ones on the order's first payment, accepted ones on its
        second, which few orders have, and open ones on a payment that no order has."""
        return (
            self.source("lineitem")
            .selectExpr(
                "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS refund_id",
                "concat(l_orderkey, CASE l_returnflag WHEN 'R' THEN '-1' WHEN 'A' THEN '-2' ELSE '-3' END)"
                " AS payment_id",
                f"{REFUND_REASON} AS reason",
                "l_extendedprice AS amount_chf",
                f"{REFUND_STATUS} AS status",
                "l_shipdate AS created_at",
                "IF(l_linenumber = 1, NULL, l_shipdate) AS processed_at",
            )
        )

    # Feed payloads -----------------------------------------------------------

    def payloads(self, array: str, item: str) -> DataFrame:
        """JSON text of up to four events each. Error events give payloads with no, an empty or a
        scalar array."""
        odd = [f'{{"{array}":[]}}', '{"other":1}', f'{{"{array}":5}}']
        events = self.source("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        good = (
            events.filter("event_type <> 'error'")
            .groupBy(F.expr("event_id div 4"))
            .agg(F.expr(f"collect_list({item})").alias("items"))
            .selectExpr(f"to_json(named_struct('{array}', items)) AS value")
        )
        bad = events.filter("event_type = 'error'").selectExpr(
            f"CASE user_id % 3 WHEN 0 THEN '{odd[0]}' WHEN 1 THEN '{odd[1]}' ELSE '{odd[2]}' END AS value"
        )
        return good.unionByName(bad)

    def connection_payloads(self) -> DataFrame:
        return self.payloads(
            "connections",
            """named_struct(
                'from', named_struct(
                    'departure', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+0100'),
                    'station', named_struct(
                        'name', concat('U', user_id),
                        'coordinate', named_struct('x', value, 'y', CAST(k AS DOUBLE))),
                    'delay', IF(event_type = 'view', NULL, k),
                    'platform', IF(event_type = 'click', CAST(k % 10 AS STRING), NULL)),
                'to', named_struct('station', named_struct('name', concat('T', k))),
                'duration', '00d00:10:00',
                'products', array(concat('IC', k % 7)),
                'sections', array(named_struct('journey', named_struct(
                    'operator', 'OP', 'category', event_type))))""",
        )

    def stationboard_payloads(self) -> DataFrame:
        return self.payloads(
            "results",
            """named_struct(
                'fahrt_bezeichner', concat('J', event_id),
                'haltestellen_name', concat('U', user_id),
                'linien_text', concat('S', k % 9),
                'produkt_id', event_type,
                'abfahrtszeit', CAST(ts AS STRING),
                'ankunftszeit', CAST(ts AS STRING),
                'ab_prognose', IF(event_type = 'view', NULL,
                    CAST(ts + make_dt_interval(0, 0, 0, k * 7) AS STRING)),
                'an_prognose', CAST(ts AS STRING),
                'abfahrtsverspatung', k > 50,
                'ankunftsverspatung', k > 90,
                'faellt_aus_tf', k = 0,
                'betreiber_name', 'OP',
                'betriebstag', CAST(to_date(ts) AS STRING),
                'bezeichnung_offiziell', concat('Stop ', user_id),
                'bpuic', lpad(user_id, 7, '0'),
                'verkehrsmittel_text', event_type)""",
        )

    def station_payloads(self) -> DataFrame:
        return self.payloads(
            "features",
            """named_struct(
                'id', concat('W', user_id),
                'properties', named_struct(
                    'title', concat('Station ', user_id), 'datetime', CAST(ts AS STRING)),
                'geometry', named_struct('coordinates', array(value, CAST(k AS DOUBLE))),
                'assets', CASE event_type WHEN 'view' THEN NULL
                    WHEN 'signup' THEN map_from_arrays(array('x'), array('u'))
                    ELSE map_from_arrays(array('x', concat('y', k)), array('u', 'v')) END)""",
        )

    @staticmethod
    def as_raw(payload_rows: DataFrame) -> DataFrame:
        return payload_rows.select(F.parse_json("value").alias("RAW"))

    # Staging and marts ----------------------------------------------------

    def stg(self, table: str) -> DataFrame:
        if table not in self._stages:
            maker: Callable[[], DataFrame] = getattr(self, f"raw_{table}")
            self._stages[table] = staging.stage(maker(), table)
        return self._stages[table]

    def built(self) -> tuple[Catalog, dict[str, DataFrame]]:
        """The stand-ins as CSV seed files, and all tables built from these; once for a session."""
        name = (self.spark.sparkContext.applicationId, self.folder)
        if name not in _BUILT:
            folder = work_folder(self.spark, "tables")
            for table in SEEDS:
                maker: Callable[[], DataFrame] = getattr(self, f"raw_{table}")
                texts = maker().selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c, _ in seed_columns(table)])
                # Like ids in a row make smaller files; nothing relies on the order.
                texts = texts.sortWithinPartitions(texts.columns[0])
                csv = texts.write.option("header", True).option("escape", '"').option("compression", "gzip")
                # A compressed file is read by one task.
                csv.option("maxRecordsPerFile", SEED_ROWS).csv(f"{folder}/seeds/{table}.csv")
            catalog = Catalog(self.spark, f"_{folder[-12:]}", folder)
            _BUILT[name] = catalog, build_all(catalog, f"{folder}/seeds")
        return _BUILT[name]

    @cached_property
    def connections(self) -> DataFrame:
        return staging.stg_transport_connections(self.as_raw(self.connection_payloads()))

    @cached_property
    def stationboard(self) -> DataFrame:
        return staging.stg_sbb_stationboard(self.as_raw(self.stationboard_payloads()))

    @cached_property
    def stations(self) -> DataFrame:
        return staging.stg_meteoswiss_stations(self.as_raw(self.station_payloads()))

    @cached_property
    def customers(self) -> DataFrame:
        return logistics.mart_customer_overview(
            self.stg("business_customer"),
            self.stg("customer_contact"),
            self.heavy("customer_contact", "customer_id"),
        )

    @cached_property
    def fleet(self) -> DataFrame:
        return logistics.mart_fleet_status(self.stg("vehicle"), self.stg("gps_position"))

    @cached_property
    def warehouses(self) -> DataFrame:
        return logistics.mart_warehouse_capacity(self.stg("warehouse"), self.stg("warehouse_zone"))

    @cached_property
    def orders(self) -> DataFrame:
        return logistics.mart_order_summary(self.stg("order_header"), self.stg("order_line_item"))

    @cached_property
    def products(self) -> DataFrame:
        return logistics.mart_product_catalog(
            self.stg("product"),
            self.stg("product_tariff"),
            self.heavy("product_tariff", "product_id"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        return logistics.mart_shipment_tracking(self.stg("shipment"), self.stg("tracking_event"))

    @cached_property
    def merchants(self) -> DataFrame:
        return payments.mart_merchant_overview(self.stg("merchant_account"), self.stg("payout"))

    @cached_property
    def transactions(self) -> DataFrame:
        return payments.mart_transaction_summary(self.stg("payment"), self.stg("refund"))

    def heavy(self, table: str, key: str) -> DataFrame:
        """The stored list of a staging table's heavy keys, written once for a table and session."""
        name = (self.spark.sparkContext.applicationId, self.folder, table, key)
        if name not in _HEAVY:
            staged = self.stg(table)
            summary = stored(summarize(staged, key), "summary")
            _HEAVY[name] = stored(heavy_keys(staged, key, summary), "heavy")
        return _HEAVY[name]

    def fulfillment_with(self, hot_rows: int) -> DataFrame:
        return enterprise.fulfillment_lifecycle(
            self.orders,
            self.shipments,
            self.transactions,
            hot_rows=hot_rows,
            heavy={
                "shipments": self.heavy("shipment", "order_id"),
                "transactions": self.heavy("payment", "order_id"),
            },
        )

    def customer_360_with(self, hot_rows: int) -> DataFrame:
        return enterprise.customer_overview(
            self.customers,
            self.orders,
            self.merchants,
            hot_rows=hot_rows,
            heavy={"merchants": self.heavy("merchant_account", "customer_id")},
        )

    @cached_property
    def fulfillment(self) -> DataFrame:
        return self.fulfillment_with(HOT_ROWS)

    @cached_property
    def customer_360(self) -> DataFrame:
        return self.customer_360_with(HOT_ROWS)

    @cached_property
    def routes(self) -> DataFrame:
        return enterprise.revenue_by_route(self.orders, self.shipments, self.transactions)

    @cached_property
    def report(self) -> DataFrame:
        return self.report_with(HOT_ROWS)

    def report_with(self, hot_rows: int) -> DataFrame:
        return enterprise.transaction_report(
            self.transactions,
            self.orders,
            self.shipments,
            self.customers,
            hot_rows=hot_rows,
            heavy={
                "shipments": self.heavy("shipment", "order_id"),
                "transactions": self.heavy("payment", "order_id"),
                # The mart has a row per primary contact of a customer.
                "customers": self.heavy("customer_contact", "customer_id"),
            },
        )

    @cached_property
    def rail(self) -> DataFrame:
        return feeds.mart_swiss_rail_overview(self.connections, self.stationboard)

    @cached_property
    def weather(self) -> DataFrame:
        return feeds.mart_weather_station_catalog(self.stations)
