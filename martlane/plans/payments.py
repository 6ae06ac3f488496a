"""Domain marts: merchants and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.money import zero_if_null
from martlane.operators.aggregates import any_match


def mart_merchant_overview(merchant_account: DataFrame, payout: DataFrame) -> DataFrame:
    """Merchants with payout totals; without payouts sums are 0 and periods NULL."""
    paid = F.when(F.col("status") == "PAID", F.col("net_amount_chf")).otherwise(F.lit(0))
    totals = {
        "payout_count": F.count(F.lit(1)),
        "total_gross_amount_chf": F.sum("gross_amount_chf"),
        "total_fee_amount_chf": F.sum("fee_amount_chf"),
        "total_net_amount_chf": F.sum("net_amount_chf"),
        "total_paid_amount_chf": F.sum(paid),
    }
    periods = {
        "first_payout_period": F.min("period_start"),
        "last_payout_period": F.max("period_end"),
    }
    per_merchant = payout.groupBy("merchant_id").agg(
        *[agg.alias(name) for name, agg in {**totals, **periods}.items()]
    )
    return merchant_account.join(per_merchant, "merchant_id", "left").select(
        *merchant_account.columns,
        *[zero_if_null(name).alias(name) for name in totals],
        *periods,
    )


def mart_transaction_summary(payment: DataFrame, refund: DataFrame) -> DataFrame:
    """Payments with their refunds. Every refund counts, whatever its status."""
    refunds = refund.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("refund_count"),
        F.sum("amount_chf").alias("total_refund_amount_chf"),
        any_match(F.col("status") == "PROCESSED").alias("processed"),
    )
    refunded = zero_if_null("total_refund_amount_chf")
    return payment.join(refunds, "payment_id", "left").select(
        *payment.columns,
        zero_if_null("refund_count").alias("refund_count"),
        refunded.alias("total_refund_amount_chf"),
        (zero_if_null("processed") == 1).alias("has_processed_refund"),
        (F.col("amount_chf") - refunded).alias("net_amount_chf"),
    )
