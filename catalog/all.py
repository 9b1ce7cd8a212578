"""Importing this module registers every query."""

from catalog import (  # noqa: F401
    aggregates, analyses, bimeasures, calendars, cleaning, datasets, joining, reports, rows, sets,
    sources, tablechanges, windows,
)
