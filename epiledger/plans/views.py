"""Filtered views over stored results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from epiledger.operators.explore import at_least, only, search_anywhere, sort_rows
from epiledger.operators.series import (
    Day,
    between_dates,
    period_summary,
    resample,
    running_totals,
    selected_daily,
)
from epiledger.sources.sinks import write_csv


@dataclass(frozen=True)
class View:
    """What a reader chose to look at."""

    start: Day | None = None
    end: Day | None = None
    countries: Sequence[str] = ()
    minimums: Mapping[str, float] | None = None
    frequency: str = "daily"
    cumulative: bool = False


def country_view(
    country_daily: DataFrame, view: View, population: DataFrame | None = None
) -> DataFrame:
    """Per-country figures of the chosen dates, minimums and countries."""
    period = period_summary(country_daily, view.start, view.end, population)
    return only(at_least(period, view.minimums or {}), "country_name", view.countries)


def series_view(daily: DataFrame, country_daily: DataFrame, view: View) -> DataFrame:
    """The world's series, or that of the chosen countries, in the chosen buckets."""
    series = selected_daily(country_daily, view.countries) if view.countries else daily
    buckets = resample(between_dates(series, view.start, view.end), view.frequency)
    return running_totals(buckets) if view.cumulative else buckets


def explore(
    df: DataFrame,
    text: str = "",
    sort_by: str | None = None,
    descending: bool = True,
    export_to: str | None = None,
) -> DataFrame:
    """Search, sort and optionally export one result."""
    found = search_anywhere(df, text)
    if sort_by:
        found = sort_rows(found, sort_by, descending)
    if export_to:
        write_csv(found, export_to)
    return found
