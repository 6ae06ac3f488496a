"""Row filters by role, and applying masks and filters to a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.functions.masks import PRIVILEGED_ROLES, Mask

# --- Fixed values: roles with access beyond the privileged ones, and the
# class of rows hidden from everybody else.
FINANCIAL_ROLES = (
    "DP_TRANSACTIONS_OWNER",
    "DP_TRANSACTIONS_READER",
    "DP_REVENUE_ANALYTICS_OWNER",
    "DP_REVENUE_ANALYTICS_READER",
)
CUSTOMS_ROLES = ("DP_SHIPMENTS_OWNER", "DP_COMPLIANCE_OWNER", "DP_COMPLIANCE_READER")
MERCHANT_ROLES = ("DP_MERCHANTS_OWNER",)
RESTRICTED_CLASS = "FINMA_RESTRICTED"

# --- Fixed values: governance tags and their allowed values (None: free text).
TAGS: dict[str, tuple[str, ...] | None] = {
    "DATA_QUALITY": ("BRONZE", "SILVER", "GOLD"),
    "PII_LEVEL": ("NONE", "LOW", "MEDIUM", "HIGH"),
    "DATA_DOMAIN": ("LOGISTICS", "PAYMENTS", "COMMERCE", "COMPLIANCE", "ANALYTICS"),
    "DATA_OWNER": None,
    "RETENTION_DAYS": None,
    "REGULATION": ("BAZG", "FINMA", "DSG", "PCI_DSS", "GWG", "NONE"),
    "COST_CENTER": None,
    "ENVIRONMENT": ("DEV", "TEST", "PROD"),
    "CLASSIFICATION": ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"),
}


def _visible(column: str, role: str, roles: Sequence[str], open_row: Column) -> Column:
    """TRUE for listed roles; others see rows whose condition is TRUE, not NULL."""
    if role in roles:
        return F.lit(True)
    return F.coalesce(open_row, F.lit(False))


def rows_pii(column: str, role: str, privileged=PRIVILEGED_ROLES) -> Column:
    """Rows flagged as personal data are for privileged roles."""
    return _visible(column, role, tuple(privileged), ~F.col(column))


def rows_financial(column: str, role: str, privileged=PRIVILEGED_ROLES) -> Column:
    """Rows of the restricted class are for privileged and financial roles."""
    return _visible(
        column,
        role,
        (*privileged, *FINANCIAL_ROLES),
        F.col(column) != RESTRICTED_CLASS,
    )


def rows_customs(column: str, role: str, privileged=PRIVILEGED_ROLES) -> Column:
    """Rows flagged for customs are for privileged and customs roles."""
    return _visible(column, role, (*privileged, *CUSTOMS_ROLES), ~F.col(column))


def rows_merchant(column: str, role: str, privileged=PRIVILEGED_ROLES) -> Column:
    """Rows are for privileged and merchant roles and for the role they name."""
    return _visible(column, role, (*privileged, *MERCHANT_ROLES), F.col(column) == role)


def apply_policies(
    df: DataFrame,
    role: str,
    masks: Mapping[str, Mask] | None = None,
    filters: Mapping[str, Mask] | None = None,
    privileged=PRIVILEGED_ROLES,
) -> DataFrame:
    """The frame as ``role`` may see it: rows filtered first, then columns masked.

    Filters read the true values, and being plain predicates they reach the scan.
    """
    for column, rule in (filters or {}).items():
        df = df.filter(rule(column, role, privileged))
    masks = masks or {}
    return df.select(
        *[
            masks[c](F.col(c), role, privileged).alias(c) if c in masks else F.col(c)
            for c in df.columns
        ]
    )


def check_tags(tags: Mapping[str, str]) -> dict[str, str]:
    for name, value in tags.items():
        if name not in TAGS:
            raise ValueError(f"unknown tag {name}")
        allowed = TAGS[name]
        if allowed is not None and value not in allowed:
            raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value}")
    return dict(tags)


def tag_column(df: DataFrame, column: str, **tags: str) -> DataFrame:
    """Attach tags to a column; they stay with it as metadata."""
    known = dict(df.schema[column].metadata or {})
    known["tags"] = {**known.get("tags", {}), **check_tags(tags)}
    return df.withMetadata(column, known)


def column_tags(df: DataFrame, column: str) -> dict[str, str]:
    return dict((df.schema[column].metadata or {}).get("tags", {}))


def within_retention(df: DataFrame, date_column: str, today: date) -> DataFrame:
    """Rows no older than the column's RETENTION_DAYS tag; all rows if untagged."""
    days = column_tags(df, date_column).get("RETENTION_DAYS")
    if days is None:
        return df
    return df.filter(F.col(date_column) >= F.lit(today - timedelta(days=int(days))))
