"""Text cleaning. All expressions stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# US state names and the dotted short forms people type, to codes.
STATE_CODES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR",
    "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID",
    "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS",
    "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK",
    "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT",
    "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY",
}
DOTTED_STATES = {"calif.": "CA", "fla.": "FL", "mass.": "MA", "penn.": "PA", "wash.": "WA"}

# Canonical names and the spellings that lead to them.
CATEGORIES = {
    "footwear": "Footwear",
    "foot wear": "Footwear",
    "apparel": "Apparel",
    "camping & hiking": "Camping & Hiking",
    "camping and hiking": "Camping & Hiking",
    "climbing": "Climbing",
    "water sports": "Water Sports",
    "winter sports": "Winter Sports",
    "accessories": "Accessories",
    "nutrition & hydration": "Nutrition & Hydration",
    "nutrition and hydration": "Nutrition & Hydration",
}
SEGMENTS = {"retail": "Retail", "wholesale": "Wholesale", "vip": "VIP"}
DEPARTMENTS = {
    "sales": "Sales", "support": "Support", "warehouse": "Warehouse", "management": "Management",
}
REGIONS = {
    "west": "West", "east": "East", "central": "Central", "south": "South",
    "northeast": "Northeast",
}
PAYMENT_METHODS = {
    "credit card": "Credit Card", "cc": "Credit Card", "cash": "Cash",
    "debit card": "Debit Card", "paypal": "PayPal", "gift card": "Gift Card",
}
ORDER_STATUSES = {"completed": "Completed", "cancelled": "Cancelled", "returned": "Returned"}
CHANNELS = {"online": "Online", "in store": "In-Store"}

# Texts that stand for true and false.
TRUE_TEXTS = ("y", "yes", "true", "1")
FALSE_TEXTS = ("n", "no", "false", "0")


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value for ``key`` in a literal table, NULL when it is not listed.

    The table is a literal map, which the optimizer folds to a constant.
    """
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, key)


def normalized_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def sentence_case(c: Column) -> Column:
    """First letter upper, the rest lower; inner capitals are not restored."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def clean_name(c: Column, collapse: bool = True) -> Column:
    """Trim, squeeze doubled spaces (two passes) and apply ``sentence_case``."""
    tidy = F.trim(c)
    if collapse:
        for _ in range(2):
            tidy = F.replace(tidy, F.lit("  "), F.lit(" "))
        tidy = F.trim(tidy)
    return sentence_case(tidy)


def clean_email(c: Column) -> Column:
    return blank_to_null(F.lower(c))


# Phone shapes as (LIKE mask, 1-based start of area, prefix, line).
PHONE_SHAPES = (
    ("(___) ___-____", (2, 7, 11)),
    ("___-___-____", (1, 5, 9)),
    ("___.___.____", (1, 5, 9)),
    ("+1 ___ ___ ____", (4, 8, 12)),
)


def normalize_phone(c: Column) -> Column:
    """Known shapes to ``(AAA) PPP-LLLL``; blank to NULL; anything else as it is."""

    def render(starts: Sequence[int]) -> Column:
        area, prefix, line = starts
        return F.format_string(
            "(%s) %s-%s", F.substring(c, area, 3), F.substring(c, prefix, 3), F.substring(c, line, 4)
        )

    out = F.when(blank_to_null(c).isNull(), F.lit(None).cast("string"))
    for mask, starts in PHONE_SHAPES:
        out = out.when(c.like(mask), render(starts))
    return out.when(c.rlike(r"^[0-9]{10}$"), render((1, 4, 7))).otherwise(c)


def normalize_state(c: Column) -> Column:
    """Full name, dotted short form or code in any case to the two-letter code."""
    tidy = blank_to_null(c)
    codes = {code: code for code in STATE_CODES.values()}
    return F.coalesce(
        lookup(F.lower(tidy), {**STATE_CODES, **DOTTED_STATES}), lookup(F.upper(tidy), codes)
    )


def standardize_boolean(c: Column) -> Column:
    key = normalized_key(c)
    return F.when(key.isin(*TRUE_TEXTS), 1).when(key.isin(*FALSE_TEXTS), 0)


def standardize_category(c: Column) -> Column:
    return lookup(normalized_key(F.replace(c, F.lit("  "), F.lit(" "))), CATEGORIES)


def standardize_segment(c: Column) -> Column:
    return lookup(normalized_key(c), SEGMENTS)


def standardize_department(c: Column) -> Column:
    return lookup(normalized_key(c), DEPARTMENTS)


def standardize_region(c: Column) -> Column:
    return lookup(normalized_key(c), REGIONS)


def standardize_payment_method(c: Column) -> Column:
    return lookup(normalized_key(c), PAYMENT_METHODS)


def standardize_order_status(c: Column) -> Column:
    return lookup(normalized_key(c), ORDER_STATUSES)


def standardize_channel(c: Column) -> Column:
    return lookup(F.replace(normalized_key(c), F.lit("-"), F.lit(" ")), CHANNELS)


def coalesce_default(c: Column, default: str, *others: Column) -> Column:
    """First value that is neither NULL nor blank, else ``default``."""
    return F.coalesce(*[blank_to_null(x) for x in (c, *others)], F.lit(default))


def text_kind(c: Column) -> Column:
    """What a raw text column holds: ``null``, ``number`` or ``text``."""
    number = F.trim(c).try_cast("double")
    return F.when(c.isNull(), "null").when(number.isNotNull(), "number").otherwise("text")
