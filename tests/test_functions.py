from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlane.functions import masks
from martlane.functions.dates import days_between, minutes_between, since_days
from martlane.functions.money import landed_cost, percent_of, percent_share
from martlane.functions.text import first_match, last_path_segment, trimmed_line

TIMES = [
    # start, end, minutes, days
    ("2026-01-05 10:00:59", "2026-01-05 10:01:00", 1, 0),
    ("2026-01-05 10:00:00", "2026-01-05 10:00:59", 0, 0),
    ("2026-01-05 10:01:00.5", "2026-01-05 10:00:59", -1, 0),
    ("2026-01-05 23:59:00", "2026-01-06 00:01:00", 2, 1),
    ("2026-01-05 00:00:00", "2026-01-06 23:59:59.999999", 2879, 1),
    ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1, 1),
    ("2026-03-29 01:30:00", "2026-03-29 03:30:00", 120, 0),
    (None, "2026-01-06 00:01:00", None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Zurich"])
def test_boundary_differences_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(TIMES, "a string, b string, m int, d int")
        a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
        got = df.select("m", minutes_between(a, b), "d", days_between(a, b)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for m, minutes, d, days in got:
        assert (minutes, days) == (m, d)


def test_since_days_includes_the_limit(spark):
    df = spark.createDataFrame(
        [("2026-01-01 00:00:00",), ("2025-12-31 23:59:59",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    now = F.lit(datetime(2026, 1, 8)).cast("timestamp_ntz")
    assert df.filter(since_days(F.col("t"), now, 7)).count() == 1


def test_money_rounds_half_away_from_zero_once(spark):
    df = spark.createDataFrame(
        [(Decimal("0.10"), Decimal("5.00"), Decimal("2.50")), (Decimal("9.99"), None, Decimal("7.70"))],
        "p decimal(10,2), duty decimal(5,2), vat decimal(5,2)",
    )
    p, duty, vat = F.col("p"), F.col("duty"), F.col("vat")
    got = df.select(percent_of(p, duty), percent_of(p, vat), landed_cost(p, vat, duty)).collect()
    assert tuple(got[0]) == (Decimal("0.01"), Decimal("0.00"), Decimal("0.11"))
    assert tuple(got[1]) == (None, Decimal("0.77"), None)
    share = df.select(percent_share(F.lit(1), F.lit(4)), percent_share(F.lit(0), F.lit(0))).first()
    assert tuple(share) == (25.0, 0.0)


MASKED = [
    (masks.mask_email, "anna@example.com", "a***@example.com"),
    (masks.mask_email, "xyz", "x***@"),
    (masks.mask_email, None, None),
    (masks.mask_phone, "+41 44 123 45 67", "***-5 67"),
    (masks.mask_iban, "CH9300762011623852957", "CH93*************2957"),
    (masks.mask_iban, "CH93007", "CH933007"),
    (masks.mask_iban, None, None),
    (masks.mask_credit_card, "4111111111111234", "****-****-****-1234"),
    (masks.mask_name, "Anna", "***"),
    (masks.mask_name, None, "***"),
    (masks.mask_address, "Street 1", "*** REDACTED ***"),
    (masks.mask_address, None, "*** REDACTED ***"),
]


@pytest.mark.parametrize("mask,value,hidden", MASKED)
def test_masks(spark, mask, value, hidden):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(mask("v", "VISITOR")).first()[0] == hidden
    assert df.select(mask("v", "ACCOUNTADMIN")).first()[0] == value
    assert df.select(mask("v", "BOSS", privileged=["BOSS"])).first()[0] == value


def test_mask_amount_keeps_its_type(spark):
    df = spark.createDataFrame([(Decimal("1.50"),)], "v decimal(38,2)")
    out = df.select(masks.mask_amount("v", "VISITOR").alias("v"))
    assert out.first()[0] is None and out.schema["v"].dataType.simpleString() == "decimal(38,2)"


def test_text_helpers(spark):
    df = spark.createDataFrame([('<a href="x/1.csv"><a href="x/2.csv">',), ("none",)], "h string")
    url = first_match("h", r'href="([^"]+)"')
    assert [tuple(r) for r in df.select(url, last_path_segment(url)).collect()] == [
        ("x/1.csv", "1.csv"),
        (None, None),
    ]
    line = spark.createDataFrame([("\t a b \r",)], "v string").select(trimmed_line("v")).first()[0]
    assert line == "a b"
