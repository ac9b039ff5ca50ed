"""Text cleansing and the fixed banding rules for customers and products."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Country names that have their own code; any other country uses its first two letters.
COUNTRY_CODES = {
    "UNITED STATES": "US",
    "USA": "US",
    "CANADA": "CA",
    "UNITED KINGDOM": "UK",
    "AUSTRALIA": "AU",
}

# Sales regions by state; every other state, and NULL, is Midwest.
REGION_STATES = {
    "West": ("CA", "OR", "WA", "NV", "AZ"),
    "South": ("TX", "OK", "NM", "AR", "LA"),
    "Northeast": ("NY", "NJ", "PA", "MA", "CT"),
}
DEFAULT_REGION = "Midwest"

# Customer tiers by segment; everything else, and NULL, is TIER_3.
TIER_SEGMENTS = {"TIER_1": ("PREMIUM", "VIP"), "TIER_2": ("REGULAR",)}
DEFAULT_TIER = "TIER_3"

# Upper bounds (inclusive) of the tenure bands in days, and the band beyond them.
TENURE_BANDS = ((30, "New (0-30 days)"), (90, "Recent (31-90 days)"), (365, "Established (91-365 days)"))
LAST_TENURE_BAND = "Loyal (365+ days)"

# Upper bounds (exclusive) of the price bands, and the band beyond them.
PRICE_BANDS = ((25, "Budget"), (100, "Mid-Range"), (500, "Premium"))
LAST_PRICE_BAND = "Luxury"

# Texts that mean an active product.
TRUE_WORDS = ("TRUE", "YES", "1", "Y")

EMAIL_LIKE = "%@%.%"


def trim_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def looks_like_email(raw: Column) -> Column:
    """TRUE or FALSE, FALSE for NULL; tests the text as it came, untrimmed."""
    return F.coalesce(raw.like(EMAIL_LIKE), F.lit(False))


def by_membership(c: Column, groups: dict[str, tuple[str, ...]], default: str) -> Column:
    """Label of the first group holding the value; NULL and unlisted values get the default."""
    label = F
    for name, members in groups.items():
        label = label.when(c.isin(*members), name)
    return label.otherwise(default)


def by_bound(c: Column, bands, last: str, inclusive: bool) -> Column:
    """Label of the first band whose upper bound holds the value; NULL falls through to the last."""
    label = F
    for bound, name in bands:
        label = label.when(c <= bound if inclusive else c < bound, name)
    return label.otherwise(last)


def country_code(country: Column) -> Column:
    code = F
    for name, short in COUNTRY_CODES.items():
        code = code.when(country == name, short)
    return code.otherwise(F.left(country, F.lit(2)))


def region(state: Column) -> Column:
    return by_membership(state, REGION_STATES, DEFAULT_REGION)


def customer_tier(segment: Column) -> Column:
    return by_membership(segment, TIER_SEGMENTS, DEFAULT_TIER)


def tenure_band(days: Column) -> Column:
    return by_bound(days, TENURE_BANDS, LAST_TENURE_BAND, inclusive=True)


def price_band(price: Column) -> Column:
    return by_bound(price, PRICE_BANDS, LAST_PRICE_BAND, inclusive=False)
