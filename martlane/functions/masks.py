"""Column masks: ``mask(column, role)`` returns the value that role may see.

A mask is an ordinary column expression. The role is known when the query is
built, so a privileged role costs nothing: the column comes back untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roles that see everything; callers may pass a list of their own.
PRIVILEGED_ROLES = ("ACCOUNTADMIN", "PLATFORM_ADMIN", "COMPLIANCE_OFFICER")

# --- Fixed values: what replaces hidden text.
EMAIL_FILLER = "***@"
PHONE_PREFIX = "***-"
CARD_PREFIX = "****-****-****-"
NAME_FILLER = "***"
ADDRESS_FILLER = "*** REDACTED ***"
AMOUNT_TYPE = "decimal(38,2)"

Mask = Callable[..., Column]


def _unless_privileged(hide: Callable[[Column], Column]) -> Mask:
    def mask(column: Column | str, role: str, privileged=PRIVILEGED_ROLES) -> Column:
        value = F.col(column) if isinstance(column, str) else column
        return value if role in privileged else hide(value)

    mask.__doc__ = hide.__doc__
    return mask


def _tail(value: Column, n: int) -> Column:
    return F.right(value, F.lit(n))


def _hide_email(value: Column) -> Column:
    """First character and domain stay."""
    domain = F.split_part(value, F.lit("@"), F.lit(2))
    return F.concat(F.left(value, F.lit(1)), F.lit(EMAIL_FILLER), domain)


def _hide_phone(value: Column) -> Column:
    """Last four digits stay."""
    return F.concat(F.lit(PHONE_PREFIX), _tail(value, 4))


def _hide_iban(value: Column) -> Column:
    """First and last four characters stay; short values repeat characters."""
    stars = F.repeat(F.lit("*"), F.length(value) - 8)
    return F.concat(F.left(value, F.lit(4)), stars, _tail(value, 4))


def _hide_card(value: Column) -> Column:
    """Last four digits stay."""
    return F.concat(F.lit(CARD_PREFIX), _tail(value, 4))


def _hide_name(value: Column) -> Column:
    """Nothing stays, not even whether there was a value."""
    return F.lit(NAME_FILLER)


def _hide_address(value: Column) -> Column:
    """Nothing stays, not even whether there was a value."""
    return F.lit(ADDRESS_FILLER)


def _hide_amount(value: Column) -> Column:
    """Always NULL."""
    return F.lit(None).cast(AMOUNT_TYPE)


mask_email = _unless_privileged(_hide_email)
mask_phone = _unless_privileged(_hide_phone)
mask_iban = _unless_privileged(_hide_iban)
mask_credit_card = _unless_privileged(_hide_card)
mask_name = _unless_privileged(_hide_name)
mask_address = _unless_privileged(_hide_address)
mask_amount = _unless_privileged(_hide_amount)
