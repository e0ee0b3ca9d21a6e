"""Time series: date ranges, resampling, running totals, months, peaks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.functions.metrics import open_cases, zero
from epiledger.operators.lookups import keep_members, lookup, period_rates
from epiledger.schema import DAILY_RUNNING_TOTALS, GLOBAL_SERIES, PERIOD_TOTALS
from epiledger.sources.shared import as_table

Day = str | dt.date


def between_dates(
    df: DataFrame, start: Day | None, end: Day | None, whole_last_day: bool = True
) -> DataFrame:
    """Rows from ``start`` to ``end``; the last day counts in full unless told otherwise."""
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        last = F.lit(end).cast("date")
        upto = F.col("date") < F.date_add(last, 1) if whole_last_day else F.col("date") <= last
        df = df.filter(upto)
    return df


def period_summary(
    country_daily: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """Per country over a date range: summed increments, last running totals, rates.

    Sum and last value come from one aggregation; ``max_by`` on doubles stays a
    hash aggregate.
    """
    sums = [c for c in PERIOD_TOTALS if c in country_daily.columns]
    lasts = [c for c in DAILY_RUNNING_TOTALS if c in country_daily.columns]
    when = F.coalesce("date", F.lit("9999-12-31").cast("date"))
    period = (
        between_dates(country_daily, start, end)
        .groupBy("location_key", "country_name")
        .agg(
            *[zero(F.sum(c)).alias(PERIOD_TOTALS[c]) for c in sums],
            *[F.max_by(c, when).alias(c) for c in lasts],
        )
    )
    if {"cumulative_confirmed", "cumulative_deceased"} <= set(lasts):
        period = period.withColumn("active_cases", open_cases(period))
    if population is not None:
        period = lookup(period, population.select("location_key", "population"), "location_key")
    return period_rates(period)


def selected_daily(country_daily: DataFrame, countries: Sequence[str]) -> DataFrame:
    """World-style series of the chosen countries; a day without values stays null."""
    rows = country_daily
    if countries:
        rows = rows.filter(F.col("country_name").isin(list(countries)))
    present = {c: s for c, s in GLOBAL_SERIES.items() if c in rows.columns}
    return (
        rows.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(*[F.sum(c).alias(s) for c, s in present.items()])
        .orderBy("date")
    )


_FREQUENCIES = ("daily", "weekly", "monthly")


def _label(frequency: str) -> Column:
    """The day, the Sunday ending the week, or the start of the month."""
    if frequency == "daily":
        return F.col("date")
    if frequency == "weekly":
        return F.next_day(F.date_sub("date", 1), "SUN")
    return F.trunc("date", "MM")


def _labels_until(following: Column, frequency: str) -> Column:
    """This label and the unused ones before the following."""
    last, step = {
        "daily": (F.date_sub(following, 1), "interval 1 day"),
        "weekly": (F.date_sub(following, 7), "interval 7 days"),
        "monthly": (F.add_months(following, -1), "interval 1 month"),
    }[frequency]
    return F.sequence(F.col("date"), F.coalesce(last, F.col("date")), F.expr(step))


def series_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("global_new_")]


def resample(
    series: DataFrame, frequency: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Sum a daily series into buckets and emit the empty ones as null.

    Each bucket also lays out the empty ones up to the next, so the series is read
    once and joined with nothing.  The frame runs over one row per bucket.
    """
    if frequency not in _FREQUENCIES:
        raise ValueError(f"unknown frequency {frequency!r}")
    metrics = list(columns or series_columns(series))
    buckets = (
        series.filter(F.col("date").isNotNull())
        .groupBy(_label(frequency).alias("date"))
        .agg(*[F.sum(c).alias(c) for c in metrics])
    )
    following = F.lead("date").over(Window.orderBy("date"))
    filled = buckets.withColumn("_following", following).select(
        F.explode(_labels_until(F.col("_following"), frequency)).alias("_label"),
        "date",
        *metrics,
    )
    return filled.select(
        F.col("_label").alias("date"),
        *[F.when(F.col("_label") == F.col("date"), F.col(c)).alias(c) for c in metrics],
    ).orderBy("date")


def running_totals(series: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Running totals with nulls as 0, over one row per bucket of the calendar."""
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    metrics = list(columns or series_columns(series))
    return series.withColumns(
        {
            c.replace("global_new_", "cumulative_"): F.sum(zero(F.col(c))).over(so_far)
            for c in metrics
        }
    )


def calendar_means(
    df: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str],
    days: int = 7,
    absent_as_zero: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Trailing means over calendar days within each group, as ``{metric}_mean_{days}d``.

    The frame is a range of days, not of rows, so a gap in the reports shortens it: the mean is
    over the days reported in it, or with ``absent_as_zero`` over all its days.  A group has at most a row
    a day if the frame is summed by group and day, which bounds its window.  Rows without a date
    see only each other.
    """
    span = Window.partitionBy(*by).orderBy(F.unix_date("date")).rangeBetween(1 - days, 0)

    def mean(c: str) -> Column:
        value = zero(F.sum(c).over(span)) / days if absent_as_zero else F.avg(c).over(span)
        return F.round(value, digits) if digits is not None else value

    return df.withColumns({f"{c}_mean_{days}d": mean(c) for c in metrics})


def completeness(
    df: DataFrame, metrics: Sequence[str] = (), key: str = "location_key", date: str = "date"
) -> DataFrame:
    """Per location and month: days expected, days reported and the percentage; days with each metric.

    Expected are all days from a location's first report to its last.  They are not laid out: the days
    missing after a report are a gap up to the next one (``lead``), split over the months it spans, so
    the work grows with the reports and not with the calendar.  Months inside a gap are there
    with 0 days.  Repeated reports of a day count once.  Rows without location or date are left out.
    """
    daily = (
        df.where(F.col(key).isNotNull() & F.col(date).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(date).alias("_day"))
        .agg(*[F.max(F.col(c).isNotNull().cast("long")).alias(c) for c in metrics], F.lit(1).alias("_one"))
        .withColumn("_next", F.lead("_day").over(Window.partitionBy("_key").orderBy("_day")))
    )
    first, last = F.date_add("_day", 1), F.date_sub("_next", 1)
    gap = F.transform(
        F.expr("sequence(trunc(date_add(_day, 1), 'MM'), trunc(date_sub(_next, 1), 'MM'), interval 1 month)"),
        lambda month: _month_part(
            month, F.lit(0), F.datediff(F.least(last, F.last_day(month)), F.greatest(first, month)) + 1, metrics, False
        ),
    )
    own = F.array(_month_part(F.trunc("_day", "MM"), F.lit(1), F.lit(0), metrics, True))
    parts = daily.select(
        "_key",
        F.explode(F.when(F.datediff("_next", "_day") > 1, F.concat(own, gap)).otherwise(own)).alias("_p"),
    )
    days = F.sum("_p.reported") + F.sum("_p.missing")
    return parts.groupBy(F.col("_key").alias(key), F.col("_p.month").alias("month")).agg(
        days.alias("days_expected"),
        F.sum("_p.reported").alias("days_reported"),
        F.round(F.lit(100.0) * F.sum("_p.reported") / days, 2).alias("completeness_pct"),
        *[F.sum(f"_p.{c}").alias(f"days_with_{c}") for c in metrics],
    )


def _month_part(month: Column, reported: Column, missing: Column, metrics: Sequence[str], own: bool) -> Column:
    return F.struct(
        month.alias("month"),
        reported.cast("long").alias("reported"),
        missing.cast("long").alias("missing"),
        *[(F.col(c) if own else F.lit(0).cast("long")).alias(c) for c in metrics],
    )


def monthly_totals(
    country_daily: DataFrame, metric: str, group: str = "country_name"
) -> DataFrame:
    return (
        country_daily.filter(F.col(group).isNotNull() & F.col("date").isNotNull())
        .groupBy(group, F.trunc("date", "MM").alias("month"))
        .agg(F.sum(metric).alias(metric))
    )


def top_groups(df: DataFrame, metric: str, n: int, group: str = "country_name") -> DataFrame:
    """The ``n`` groups with the largest total, ties by name."""
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(zero(F.sum(metric)).alias("_total"))
        .orderBy(F.desc("_total"), group)
        .limit(n)
        .select(group)
    )


def monthly_top(
    country_daily: DataFrame, metric: str, n: int = 12, group: str = "country_name"
) -> DataFrame:
    """Monthly totals of the top ``n`` groups, both off the same monthly aggregation."""
    monthly = monthly_totals(country_daily, metric, group)
    return keep_members(monthly, top_groups(monthly, metric, n, group), group)


def month_pivot(
    country_daily: DataFrame, metric: str, n: int = 20, group: str = "country_name"
) -> DataFrame:
    """Top ``n`` groups by month, one column per month that occurs, gaps as 0.

    The monthly totals, a few rows a group, are stored: naming the columns reads them,
    not the facts.
    """
    monthly = as_table(
        monthly_top(country_daily, metric, n, group).withColumn(
            "month", F.date_format("month", "yyyy-MM-dd")
        ),
        "monthly-totals",
    )
    months = [r.month for r in monthly.select("month").distinct().orderBy("month").collect()]
    return monthly.groupBy(group).pivot("month", months).agg(F.sum(metric)).fillna(0.0)


def peak_period(series: DataFrame, metric: str = "global_new_confirmed") -> DataFrame:
    """Largest value, the first date it occurred, and the number of periods."""
    dated = F.struct(F.col(metric), F.datediff(F.lit("9999-12-31").cast("date"), "date"))
    return series.agg(
        F.max(metric).alias("peak_value"),
        F.max_by("date", F.when(F.col(metric).isNotNull(), dated)).alias("peak_date"),
        F.count(F.lit(1)).alias("periods"),
    )


def date_bounds(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))
