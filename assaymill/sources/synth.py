"""Noise for clean data: the same value in many spellings, chosen by key arithmetic.

Nothing is random, so a lost executor's partition comes back identical and the
same rule can be stated in any SQL dialect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.text import lookup

# Texts that stand for true and false, and the dotted state names.
TRUE_TEXTS = ["Y", "y", "true", "1", "yes"]
FALSE_TEXTS = ["N", "n", "false", "0", "no"]
DOTTED_STATES = {
    "California": "Calif.", "Florida": "Fla.", "Massachusetts": "Mass.",
    "Pennsylvania": "Penn.", "Washington": "Wash.",
}
CATEGORY_VARIANTS = {
    "Footwear": "Foot Wear",
    "Camping & Hiking": "Camping and Hiking",
    "Nutrition & Hydration": "Nutrition and Hydration",
}

# Ids of injected rows start here, far above any real id.
DUPLICATE_ID_OFFSET = 10**12
ORPHAN_ID_OFFSET = 2 * 10**12


def pick(options: Sequence[str], key: Column) -> Column:
    """Option number ``key`` modulo the number of options."""
    values = F.array(*[F.lit(x) for x in options])
    return F.element_at(values, (key % len(options)).cast("int") + 1)


def null_when(c: Column, condition: Column) -> Column:
    return F.when(~condition, c)


def blank_when(c: Column, condition: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(c)


def mixed_case(c: Column, key: Column) -> Column:
    """Upper, lower, padded with spaces, or untouched."""
    turn = key % 4
    return (
        F.when(turn == 0, F.upper(c))
        .when(turn == 1, F.lower(c))
        .when(turn == 2, F.concat(F.lit(" "), F.replace(c, F.lit(" "), F.lit("  ")), F.lit(" ")))
        .otherwise(c)
    )


def mixed_case_plain(c: Column, key: Column) -> Column:
    """As ``mixed_case``, but padding does not double the inner spaces."""
    turn = key % 4
    return (
        F.when(turn == 0, F.upper(c))
        .when(turn == 1, F.lower(c))
        .when(turn == 2, F.concat(c, F.lit(" ")))
        .otherwise(c)
    )


def mixed_date(d: Column, key: Column) -> Column:
    """ISO, month first with slashes, or ISO with a time of day."""
    turn = key % 3
    clock = F.concat(F.lit(" "), F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":05:09"))
    return (
        F.when(turn == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(turn == 1, F.date_format(d, "MM/dd/yyyy"))
        .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), clock))
    )


def mixed_boolean(flag: Column, key: Column) -> Column:
    """One of the texts for the flag; NULL stays NULL."""
    return F.when(flag == 1, pick(TRUE_TEXTS, key)).when(flag == 0, pick(FALSE_TEXTS, key))


def mixed_phone(area: Column, prefix: Column, line: Column, key: Column) -> Column:
    turn = key % 5
    return (
        F.when(turn == 0, F.concat(F.lit("("), area, F.lit(") "), prefix, F.lit("-"), line))
        .when(turn == 1, F.concat_ws("-", area, prefix, line))
        .when(turn == 2, F.concat(area, prefix, line))
        .when(turn == 3, F.concat_ws(".", area, prefix, line))
        .otherwise(F.concat_ws(" ", F.lit("+1"), area, prefix, line))
    )


def mixed_category(c: Column, key: Column) -> Column:
    spelled = F.when(key % 5 == 0, F.coalesce(lookup(c, CATEGORY_VARIANTS), c)).otherwise(c)
    return mixed_case(spelled, key)


def mixed_total(correct: Column, before_discount: Column, key: Column) -> Column:
    """A stored line total nobody should trust."""
    turn = key % 10
    right, stale = (x.cast("decimal(18,2)").cast("string") for x in (correct, before_discount))
    return (
        F.when(turn < 4, right)
        .when(turn == 4, F.concat(F.lit(" $"), right))
        .when(turn == 5, stale)
        .when(turn == 6, F.concat(F.lit("$"), stale, F.lit(" ")))
        .when(turn == 7, F.lit("TBD"))
        .when(turn == 8, F.lit("N/A"))
    )


def inject_orphans(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Point the foreign key at an id that exists nowhere."""
    return df.withColumn(
        column, F.when(condition, F.col(column) + ORPHAN_ID_OFFSET).otherwise(F.col(column))
    )


def inject_duplicates(df: DataFrame, key: str, condition: Column, copy: str = "is_copy") -> DataFrame:
    """Repeat the chosen rows under a new id, in the same pass over the data.

    ``copy`` is 1 on the repeated rows so the caller can disturb them.
    """
    doubled = df.withColumn(
        copy, F.explode(F.sequence(F.lit(0), F.coalesce(condition, F.lit(False)).cast("int")))
    )
    return doubled.withColumn(key, F.col(key) + F.col(copy).cast("long") * DUPLICATE_ID_OFFSET)
