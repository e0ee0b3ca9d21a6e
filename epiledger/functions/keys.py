"""Predicates and columns read off the hierarchical location key.

A country key has two characters (``US``); deeper levels append parts with
``_`` (``US_CA``).  Two-character keys also bound every per-country result: a
few thousand rows at most, however large the facts are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_country(key: str = "location_key") -> Column:
    return F.length(F.col(key)) == 2


def is_regional(key: str = "location_key") -> Column:
    return F.length(F.col(key)) > 2


def at_level(level: str, key: str = "location_key") -> Column:
    """Predicate for ``country``, ``regional`` or ``all`` (either of the two)."""
    if level == "country":
        return is_country(key)
    if level == "regional":
        return is_regional(key)
    if level == "all":
        return F.length(F.col(key)) >= 2
    raise ValueError(f"unknown level {level!r}")


def country_code(key: str = "location_key") -> Column:
    return F.split(F.col(key), "_").getItem(0)


def has_case_data() -> Column:
    return F.col("new_confirmed").isNotNull() | F.col("cumulative_confirmed").isNotNull()
