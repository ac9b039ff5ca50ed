import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions import dates, numeric, quality, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("given, expected", [
    ("2025-03-15", dt.date(2025, 3, 15)), ("03/15/2025", dt.date(2025, 3, 15)), ("15-Mar-2025", dt.date(2025, 3, 15)),
    ("2025-02-30", None), ("bad", None), ("2025-03", None), (None, None),
])
def test_try_date(spark, given, expected):
    assert value(spark, dates.try_date(F.lit(given).cast("string"))) == expected


def test_wall_clock_ignores_zone(spark):
    assert value(spark, dates.try_wall_clock(F.lit("2025-03-15T10:30:00Z"))) == dt.datetime(2025, 3, 15, 10, 30)
    assert value(spark, dates.try_wall_clock(F.lit("noon"))) is None


def test_day_of_week_counts_from_sunday(spark):
    assert value(spark, dates.day_of_week(F.lit(dt.date(2025, 3, 16)))) == 0
    assert value(spark, dates.day_of_week(F.lit(dt.date(2025, 3, 15)))) == 6


def test_second_boundaries(spark):
    a = F.lit("2025-01-01 00:00:00.9").cast("timestamp_ntz")
    b = F.lit("2025-01-01 00:00:01.1").cast("timestamp_ntz")
    assert value(spark, dates.second_boundaries(a, b)) == 1


@pytest.mark.parametrize("above, below, digits, expected", [
    ("201", "200", 2, "1.01"), ("-201", "200", 2, "-1.01"), ("201", "-200", 2, "-1.01"), ("1.005", "1", 2, "1.01"),
    ("1", "3", 4, "0.3333"), ("2", "3", 4, "0.6667"), ("0", "7", 2, "0.00"), ("1", "0", 2, None)])
def test_quotient_rounds_half_away_exactly(spark, above, below, digits, expected):
    got = value(spark, numeric.quotient(F.lit(Decimal(above)), F.lit(Decimal(below)), digits))
    assert got == (None if expected is None else Decimal(expected))


def test_percent_of_a_tie(spark):
    assert value(spark, numeric.percent_of(F.lit(Decimal("201")), F.lit(Decimal("20000")))) == Decimal("1.01")


def test_ratio_and_growth(spark):
    one, zero = F.lit(Decimal("1.00")), F.lit(Decimal("0.00"))
    assert value(spark, numeric.ratio(one, zero)) is None
    assert value(spark, numeric.growth_percent(F.lit(Decimal("3.00")), F.lit(Decimal("2.00")))) == 50.0
    assert value(spark, numeric.growth_percent(one, zero)) == 0.0
    assert value(spark, numeric.growth_percent(one, F.lit(None).cast("decimal(18,4)"))) == 0.0


def test_try_decimal(spark):
    assert value(spark, numeric.try_decimal(F.lit("12.34567"))) == Decimal("12.3457")
    assert value(spark, numeric.try_decimal(F.lit("abc"))) is None


@pytest.mark.parametrize("state, expected", [
    ("CA", "West"), ("TX", "South"), ("NY", "Northeast"), ("FL", "Midwest"), (None, "Midwest")])
def test_region(spark, state, expected):
    assert value(spark, text.region(F.lit(state).cast("string"))) == expected


@pytest.mark.parametrize("days, expected", [
    (0, "New (0-30 days)"), (30, "New (0-30 days)"), (31, "Recent (31-90 days)"), (365, "Established (91-365 days)"),
    (366, "Loyal (365+ days)"), (None, "Loyal (365+ days)")])
def test_tenure_band(spark, days, expected):
    assert value(spark, text.tenure_band(F.lit(days).cast("int"))) == expected


@pytest.mark.parametrize("price, expected", [
    (24.99, "Budget"), (25, "Mid-Range"), (100, "Premium"), (500, "Luxury"), (None, "Luxury")])
def test_price_band(spark, price, expected):
    assert value(spark, text.price_band(F.lit(price).cast("double"))) == expected


def test_country_code(spark):
    assert value(spark, text.country_code(F.lit("USA"))) == "US"
    assert value(spark, text.country_code(F.lit("GERMANY"))) == "GE"
    assert value(spark, text.country_code(F.lit(None).cast("string"))) is None


def test_email_flag_tests_raw_text(spark):
    assert value(spark, text.looks_like_email(F.lit(" a@b.c "))) is True
    assert value(spark, text.looks_like_email(F.lit("ab.c"))) is False
    assert value(spark, text.looks_like_email(F.lit(None).cast("string"))) is False


def test_dq_score_ignores_unknown(spark):
    rules = [(F.lit(True), "0.20"), (F.lit(None).cast("boolean"), "0.50"), (F.lit(True), "0.15")]
    assert value(spark, quality.dq_score(rules)) == Decimal("0.35")
