"""Surrogate keys that stay: a kept table of natural keys and the numbers they were given.

``row_number`` keys move when a row is added. Here a natural key keeps the number it
has; new ones continue after the largest. A versioned dimension uses (key, valid_from) as its natural
key, so every version has a number of its own and a fact finds it by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.operators.intervals import point_in_time_join
from assaymill.operators.ordered import row_numbers


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[f"_k_{c}"])
    return same


def _renamed(kept: DataFrame, columns: Sequence[str]) -> DataFrame:
    return kept.withColumnsRenamed({c: f"_k_{c}" for c in columns})


def extend_keys(rows: DataFrame, columns: Sequence[str], name: str, kept: DataFrame | None = None) -> DataFrame:
    """The key map ``(columns, name)`` with every natural key of ``rows``.

    Without ``kept`` the numbers run 1..N in the order of the columns. Pass ``kept`` as it was
    read back from where the last load wrote it.
    """
    natural = rows.select(*columns).distinct()
    if kept is None:
        return row_numbers(natural, [], columns, name)
    known = _renamed(kept.select(*columns), columns)
    fresh = natural.join(known, _same(natural, known, columns), "left_anti")
    top = kept.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).scalar()
    added = row_numbers(fresh, [], columns, "_n").select(*columns, (top + F.col("_n")).alias(name))
    return kept.select(*columns, F.col(name).cast("bigint").alias(name)).unionByName(added)


def with_key(rows: DataFrame, keymap: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their number; null where the map does not have the natural key."""
    known = _renamed(keymap.select(*columns, name), columns)
    return rows.join(known, _same(rows, known, columns), "left").select(*rows.columns, name)


def version_of(
    facts: DataFrame, history: DataFrame, keymap: DataFrame, key: str, at: str, name: str,
    valid_from: str = "valid_from", valid_to: str = "valid_to",
) -> DataFrame:
    """``facts`` with the number of the version of ``key`` that was valid on their date; facts without one are left out."""
    versions = with_key(history.select(key, valid_from, valid_to), keymap, [key, valid_from], name)
    return point_in_time_join(facts, versions, key, at, valid_from, valid_to).select(*facts.columns, name)
