"""Fact frames: case rows joined with vaccinations, admissions and names.

Every side is reduced to one row per (date, location) before it is joined, so
joins are one-to-one and a hot date or location never multiplies.  Dedupe and
joins share the partitioning on (date, location_key): one shuffle per input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.functions.keys import at_level, has_case_data, is_country
from epiledger.functions.metrics import number
from epiledger.operators.cleaning import (
    cast_metrics,
    clip_metrics,
    dedupe,
    drop_missing_keys,
    fill_metrics,
    parse_date,
)
from epiledger.operators.lookups import with_country_name, with_parent_country
from epiledger.schema import (
    CASE_METRICS,
    HOSPITAL_METRICS,
    KEY_COLUMNS,
    VACCINE_METRICS,
)


def _case_rows(
    cases: DataFrame, level: str, order_by: Sequence[str] | None, drop_bad_dates: bool
) -> DataFrame:
    metrics = [c for c in CASE_METRICS if c in cases.columns]
    rows = drop_missing_keys(cases.filter(at_level(level)))
    rows = parse_date(
        rows.select(
            *KEY_COLUMNS,
            *[number(c).alias(c) for c in metrics],
            *[c for c in order_by or [] if c not in metrics + KEY_COLUMNS],
        )
    ).filter(has_case_data())
    if drop_bad_dates:
        rows = rows.dropna(subset=["date"])
    return dedupe(rows, KEY_COLUMNS, order_by).select(*KEY_COLUMNS, *metrics)


def _daily_side(facts: DataFrame | None, level: str, metrics: list[str]) -> DataFrame | None:
    if facts is None:
        return None
    present = [c for c in metrics if c in facts.columns]
    if not present:
        return None
    rows = parse_date(facts.filter(at_level(level)).select(*KEY_COLUMNS, *present))
    rows = rows.filter(F.col("date").isNotNull())
    return dedupe(cast_metrics(rows, present), KEY_COLUMNS)


def _joined(cases: DataFrame, *sides: DataFrame | None) -> DataFrame:
    for side in sides:
        if side is not None:
            cases = cases.join(side, on=KEY_COLUMNS, how="left")
    return cases


def _named(df: DataFrame, index: DataFrame) -> DataFrame:
    """Names go on last: the dimension meets clean rows, not raw ones."""
    frame = with_country_name(fill_metrics(clip_metrics(df)), index)
    rest = [c for c in frame.columns if c not in ("country_name", *KEY_COLUMNS)]
    return frame.select(*KEY_COLUMNS, "country_name", *rest)


def country_frame(
    cases: DataFrame,
    index: DataFrame,
    vaccinations: DataFrame | None = None,
    hospitalizations: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
    drop_bad_dates: bool = False,
) -> DataFrame:
    """Clean country rows with vaccinations, admissions and country names.

    ``order_by`` decides which of several reports for one date and location is
    kept; by default a hash of its metrics does.
    """
    return _named(
        _joined(
            _case_rows(cases, "country", order_by, drop_bad_dates),
            _daily_side(vaccinations, "country", VACCINE_METRICS),
            _daily_side(hospitalizations, "country", HOSPITAL_METRICS),
        ),
        index,
    )


def regional_frame(
    cases: DataFrame,
    index: DataFrame,
    vaccinations: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
    drop_bad_dates: bool = False,
) -> DataFrame:
    """Clean sub-national rows with vaccinations, names and the parent country."""
    frame = _named(
        _joined(
            _case_rows(cases, "regional", order_by, drop_bad_dates),
            _daily_side(vaccinations, "regional", VACCINE_METRICS),
        ),
        index,
    )
    return with_parent_country(frame, index)


def facts_frame(
    cases: DataFrame,
    index: DataFrame,
    vaccinations: DataFrame | None = None,
    hospitalizations: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
    drop_bad_dates: bool = False,
) -> DataFrame:
    """Both levels from one pass over the inputs, told apart by ``level``.

    ``level = 'country'`` rows equal ``country_frame``; ``'regional'`` rows equal
    ``regional_frame`` apart from the admission columns, which only countries use.
    """
    if hospitalizations is not None:
        hospitalizations = hospitalizations.filter(is_country())
    frame = _named(
        _joined(
            _case_rows(cases, "all", order_by, drop_bad_dates),
            _daily_side(vaccinations, "all", VACCINE_METRICS),
            _daily_side(hospitalizations, "all", HOSPITAL_METRICS),
        ),
        index,
    )
    return with_parent_country(frame, index).withColumn(
        "level", F.when(is_country(), "country").otherwise("regional")
    )
