"""Numbers and money.

Money is a double rounded to cents, as in the raw data. Sums over it add whole
cents as 64-bit integers: the result is exact, does not depend on the order in
which partitions arrive, and the aggregate stays on codegen's primitive path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(c: Column, digits: int = 2) -> Column:
    """Sum of values that have at most ``digits`` decimals."""
    unit = 10**digits
    return F.sum(F.rint(c * unit).cast("long")) / unit


def exact_avg(c: Column, digits: int = 2) -> Column:
    return exact_sum(c, digits) / F.count(c)


def money_sum(c: Column) -> Column:
    return exact_sum(c, 2)


def product_sum(c: Column, digits: int = 6) -> Column:
    """Sum of products of numbers and prices, exact to ``digits`` decimals; not rounded to cents before."""
    return F.sum(c.cast(f"decimal(28,{digits})")).cast("double")


def nearest_cent(c: Column) -> Column:
    """Cents of a computed price, halves upwards; plain arithmetic, for values >= 0."""
    return F.floor(c * 100 + 0.5) / 100


def fix_discount_pct(c: Column) -> Column:
    """Discounts above 1 were typed as whole percentages."""
    return F.when(c > 1, c / 100).otherwise(c)


def net_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Line total after discount; a missing quantity counts as 0."""
    return F.round(F.coalesce(quantity, F.lit(0)) * unit_price * (1 - discount_pct), 2)


def gross_amount(quantity: Column, unit_price: Column) -> Column:
    """Line total before discount; a missing quantity stays missing."""
    return F.round(quantity * unit_price, 2)


# Discount tiers.
HIGH_DISCOUNT_FROM = 0.20
TIER_HIGH, TIER_STANDARD, TIER_FULL = "High Discount (20%+)", "Standard Discount", "Full Price"


def discount_tier(c: Column) -> Column:
    return (
        F.when(c >= HIGH_DISCOUNT_FROM, TIER_HIGH).when(c > 0, TIER_STANDARD).otherwise(TIER_FULL)
    )


def safe_ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """Division that yields ``default`` (NULL if none) when the divisor is 0 or NULL."""
    ratio = F.try_divide(num, den)
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), digits)


def parse_weight(c: Column) -> Column:
    """``"1.2 kg"`` or ``"1.2"`` to 1.2."""
    return lenient_double(F.regexp_replace(c, "(?i) kg$", ""))


def lenient_double(c: Column) -> Column:
    """Leading number of a text, 0.0 when there is none; never fails."""
    lead = F.regexp_extract(c, r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)", 1)
    return F.when(c.isNotNull(), F.coalesce(lead.try_cast("double"), F.lit(0.0)))


def abs_diff(a: Column, b: Column) -> Column:
    return F.abs(a - b)
