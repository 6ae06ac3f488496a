"""Enterprise marts over the domain marts.

``heavy`` arguments are the stored lists of a mart's heavy keys, by mart; with them no
mart is counted, and where no key is hot the joins are plain ones. Otherwise ``counted``
arguments name cheaper frames with the same key values as a mart (the staging table it has
one row per row of). Both only help to find hot keys. ``hot_rows`` is how many rows a key
needs to be cut into pieces at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.dates import days_between
from martlane.functions.money import zero_if_null
from martlane.operators.joins import HOT_ROWS, Side, gathered, star_join


def fulfillment_lifecycle(
    orders: DataFrame,
    shipments: DataFrame,
    transactions: DataFrame,
    counted: dict[str, DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    heavy: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Orders with shipments and payments; every combination is a row."""
    counted, heavy = counted or {}, heavy or {}
    order_part = orders.select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("status").alias("order_status"),
        F.col("header_total_chf").alias("order_total_chf"),
    )
    shipment_part = shipments.select(
        "order_id",
        "shipment_id",
        F.col("status").alias("shipment_status"),
        "vehicle_id",
        "origin_warehouse",
        "destination_city",
        "shipped_at",
        "delivered_at",
        days_between("shipped_at", "delivered_at").alias("delivery_days"),
    )
    payment_part = transactions.select(
        "order_id",
        "payment_id",
        "payment_method",
        F.col("status").alias("payment_status"),
        F.col("amount_chf").alias("payment_amount_chf"),
        F.col("net_amount_chf").alias("net_payment_chf"),
    )
    parts = (order_part, shipment_part, payment_part)
    joined = star_join(
        order_part,
        "order_id",
        [
            Side(
                shipment_part,
                ["shipment_id"],
                counted=counted.get("shipments"),
                heavy=heavy.get("shipments"),
            ),
            Side(
                payment_part,
                ["payment_id"],
                counted=counted.get("transactions"),
                heavy=heavy.get("transactions"),
            ),
        ],
        spread=["order_id"],
        hot_rows=hot_rows,
    )
    names = [c for part in parts for c in part.columns if c != "order_id"]
    return joined.select("order_id", *names)


def customer_overview(
    customers: DataFrame,
    orders: DataFrame,
    merchants: DataFrame,
    counted: dict[str, DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    heavy: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Customers with order totals and the merchants they own, one row per merchant."""
    counted, heavy = counted or {}, heavy or {}
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("header_total_chf").alias("total_order_value_chf"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    owned = merchants.select("customer_id", "merchant_id", "merchant_name", "business_type")
    own = [
        "customer_id",
        "company_name",
        "legal_form",
        "city",
        "canton",
        "is_active",
        "created_at",
        "primary_contact_email",
    ]
    joined = star_join(
        customers.select(*own, "primary_contact_id"),
        "customer_id",
        [
            Side(per_customer, unique=True),
            Side(
                owned,
                ["merchant_id"],
                counted=counted.get("merchants"),
                heavy=heavy.get("merchants"),
            ),
        ],
        spread=["customer_id", "primary_contact_id"],
        counted=None if "merchants" in heavy else counted.get("customers", customers),
        hot_rows=hot_rows,
    )
    return joined.select(
        *own,
        zero_if_null("total_orders").alias("total_orders"),
        zero_if_null("total_order_value_chf").alias("total_order_value_chf"),
        "first_order_date",
        "last_order_date",
        "merchant_id",
        "merchant_name",
        "business_type",
        F.col("merchant_id").isNotNull().alias("is_merchant"),
    )


def revenue_by_route(
    orders: DataFrame,
    shipments: DataFrame,
    transactions: DataFrame,
    hot_rows: int = HOT_ROWS,
    heavy: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Totals per route over all shipment, order and payment combinations.

    The combinations are never built. Each table is first summed up per order
    (shipments per order and route), which uses partial sums before the
    shuffle and leaves one row per order, so an order with very many payments
    or shipments costs no more than any other. A sum over the combinations is
    then the table's own sum times the row counts of the other two. A shipment
    belongs to one order, so its distinct count adds up over orders. Where no order
    is hot by the shipments' list, they are shuffled once, by order.
    """
    order_totals = orders.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("header_total_chf").alias("order_value"),
        F.count("header_total_chf").alias("n_values"),
    )
    payment_totals = transactions.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum("amount_chf").alias("paid"),
        F.sum("total_refund_amount_chf").alias("refunded"),
        F.sum("net_amount_chf").alias("net"),
    )
    days = days_between("shipped_at", "delivered_at")
    route = ["origin_warehouse", "destination_city"]
    shipped = shipments.select("order_id", *route, "shipment_id", days.alias("days"))
    per_order_and_route = (
        gathered(
            shipped.filter(F.col("order_id").isNotNull()),
            "order_id",
            (heavy or {}).get("shipments"),
            hot_rows,
        )
        .groupBy("order_id", *route)
        .agg(
            F.count(F.lit(1)).alias("n_shipments"),
            F.count_distinct("shipment_id").alias("distinct_shipments"),
            F.sum("days").alias("days"),
            F.count("days").alias("n_delivered"),
        )
    )
    joined = per_order_and_route.join(order_totals, "order_id").join(payment_totals, "order_id")

    ships, orders_, pays = F.col("n_shipments"), F.col("n_orders"), F.col("n_payments")
    value_sum = F.sum(F.col("order_value") * (ships * pays))
    value_rows = F.sum(F.col("n_values") * ships * pays)
    day_sum = F.sum(F.col("days") * orders_ * pays)
    day_rows = F.sum(F.col("n_delivered") * orders_ * pays)
    money = "decimal(38,2)"
    return joined.groupBy(*route).agg(
        F.sum("distinct_shipments").alias("total_shipments"),
        F.count(F.lit(1)).alias("total_orders"),
        value_sum.cast(money).alias("total_revenue_chf"),
        F.sum(F.col("paid") * (ships * orders_)).cast(money).alias("total_payments_chf"),
        F.sum(F.col("refunded") * (ships * orders_)).cast(money).alias("total_refunds_chf"),
        F.sum(F.col("net") * (ships * orders_)).cast(money).alias("net_revenue_chf"),
        F.try_divide(day_sum, day_rows).alias("avg_delivery_days"),
        F.try_divide(value_sum, value_rows).cast("decimal(18,6)").alias("avg_order_value_chf"),
    )


def transaction_report(
    transactions: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    customers: DataFrame,
    counted: dict[str, DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    heavy: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Payments of known orders with shipment and customer facts."""
    counted, heavy = counted or {}, heavy or {}
    payment_part = transactions.select(
        "order_id",
        "payment_id",
        "amount_chf",
        "payment_method",
        F.col("status").alias("payment_status"),
        "is_international",
        "requires_aml_check",
        "created_at",
        "processed_at",
    )
    shipment_part = shipments.select(
        "order_id", "shipment_id", "requires_customs", "customs_declaration_id"
    )
    # Customers meet the orders before these fan out: one customer may own a third of all rows.
    of_customer = star_join(
        orders.select("order_id", "customer_id"),
        "customer_id",
        [
            Side(
                customers.select("customer_id", "company_name", "primary_contact_id"),
                ["primary_contact_id"],
                counted=counted.get("customers"),
                heavy=heavy.get("customers"),
            )
        ],
        spread=["order_id"],
        counted=None if "customers" in heavy else counted.get("orders", orders),
        hot_rows=hot_rows,
    )
    report = star_join(
        of_customer.drop("primary_contact_id"),
        "order_id",
        [
            Side(
                payment_part,
                ["payment_id"],
                keep_base=False,
                counted=counted.get("transactions"),
                heavy=heavy.get("transactions"),
            ),
            Side(
                shipment_part,
                ["shipment_id"],
                counted=counted.get("shipments"),
                heavy=heavy.get("shipments"),
            ),
        ],
        spread=["order_id"],
        hot_rows=hot_rows,
    )
    return report.select(
        "payment_id",
        "order_id",
        "customer_id",
        "company_name",
        "amount_chf",
        "payment_method",
        "payment_status",
        "is_international",
        "requires_aml_check",
        "shipment_id",
        "requires_customs",
        "customs_declaration_id",
        "created_at",
        "processed_at",
    )
