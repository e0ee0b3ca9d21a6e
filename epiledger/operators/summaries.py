"""The seven results computed from a clean frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.functions.keys import country_code, is_regional
from epiledger.functions.metrics import fatality_rate, latest, open_cases
from epiledger.operators.lookups import capita_rates, with_continent, with_demographics
from epiledger.schema import (
    DAILY_INCREMENTS,
    DAILY_RUNNING_TOTALS,
    GLOBAL_SERIES,
    RESULT_DDL,
)

LOCATION = ["country_name", "location_key"]


def _or_null(df: DataFrame, column: str) -> Column:
    """The column, or a typed null where the source lacks the metric."""
    return F.col(column) if column in df.columns else F.lit(None).cast("double")


def _total(df: DataFrame, column: str, alias: str) -> Column:
    return F.sum(_or_null(df, column)).alias(alias)


def _peak(df: DataFrame, column: str, alias: str) -> Column:
    return F.max(_or_null(df, column)).alias(alias)


def _named_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("country_name").isNotNull())


def empty_result(df: DataFrame, name: str) -> DataFrame:
    """No rows, full schema: what a result is when its metric was never reported."""
    return df.sparkSession.createDataFrame([], RESULT_DDL[name])


def location_totals(df: DataFrame, *more: Column) -> DataFrame:
    """One row per location: totals, the latest date and the open cases of that date's report."""
    return df.groupBy("location_key").agg(
        _total(df, "new_confirmed", "confirmed"),
        _total(df, "new_deceased", "deceased"),
        _total(df, "new_recovered", "recovered"),
        _total(df, "new_persons_vaccinated", "people"),
        _total(df, "new_vaccine_doses_administered", "doses"),
        F.max("date").alias("latest_date"),
        latest(open_cases(df)).alias("open"),
        *more,
    )


def global_metrics(df: DataFrame) -> DataFrame:
    """One row of world totals.

    Rows collapse to one per location first, with the open cases of its latest
    report, and those to one row: no second pass and no join.
    """
    return location_totals(df).agg(
        F.sum("confirmed").alias("total_cases"),
        F.sum("deceased").alias("total_deaths"),
        F.sum("recovered").alias("total_recoveries"),
        F.count("location_key").alias("countries_reporting"),
        F.sum("people").alias("total_people_vaccinated"),
        F.sum("doses").alias("total_vaccine_doses_administered"),
        F.max("latest_date").alias("latest_data_date"),
        F.sum("open").alias("active_cases_worldwide"),
    )


def _country_totals(df: DataFrame, *more: Column) -> DataFrame:
    return (
        _named_rows(df)
        .groupBy(*LOCATION)
        .agg(
            _total(df, "new_confirmed", "total_confirmed"),
            _total(df, "new_deceased", "total_deceased"),
            _total(df, "new_recovered", "total_recovered"),
            _total(df, "new_persons_vaccinated", "total_people_vaccinated"),
            _total(
                df, "new_vaccine_doses_administered", "total_vaccine_doses_administered"
            ),
            _peak(
                df,
                "cumulative_vaccine_doses_administered",
                "cumulative_vaccine_doses_administered",
            ),
            _peak(df, "cumulative_confirmed", "peak_cumulative_confirmed"),
            _peak(df, "cumulative_deceased", "peak_cumulative_deceased"),
            _peak(df, "new_confirmed", "peak_daily_confirmed"),
            F.count("date").alias("days_reported"),
            latest(open_cases(df)).alias("active_cases"),
            *more,
        )
        .withColumn("case_fatality_rate", fatality_rate("total_deceased", "total_confirmed"))
    )


def country_summary(df: DataFrame, demographics: DataFrame | None = None) -> DataFrame:
    """Totals, peaks, open cases and rates per country, largest first."""
    return (
        with_demographics(_country_totals(df), demographics)
        .withColumn("total_vaccinated", F.col("total_people_vaccinated"))
        .select(*LOCATION, *[c for c in _columns("country_summary") if c not in LOCATION])
        .orderBy(F.desc("total_confirmed"), "location_key")
    )


def enriched_country_summary(
    df: DataFrame,
    demographics: DataFrame | None = None,
    continents: DataFrame | None = None,
) -> DataFrame:
    """What ``enriched_country_metrics`` makes of a frame's country and vaccination results.

    Both results group the same rows by the same key, so one aggregation gives the columns of
    both: the frame is read once and nothing is merged.
    """
    peak = "peak_daily_vaccine_doses_administered"
    totals = _country_totals(df, _peak(df, "new_vaccine_doses_administered", peak))
    both = (
        with_demographics(totals, demographics)
        .withColumn("total_vaccinated", F.col("total_people_vaccinated"))
        .select(*_columns("country_summary"), peak)
    )
    return with_continent(capita_rates(both), continents)


def _columns(name: str) -> list[str]:
    return [part.split()[0] for part in RESULT_DDL[name].split(", ")]


def daily_summary(df: DataFrame, calendar: bool = False) -> DataFrame:
    """World series per date with running totals and trailing means.

    The means cover seven rows, or with ``calendar`` the rows of seven days, which are fewer
    where days are missing; a row without a date is then alone.  The frames are
    unpartitioned, over one row per calendar day: the facts are summed by date first, so the
    single window task sees thousands of rows.
    """
    daily = df.groupBy("date").agg(
        *[_total(df, source, series) for source, series in GLOBAL_SERIES.items()]
    )
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    week = Window.orderBy("date").rowsBetween(-6, 0)
    if calendar:
        week = Window.orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    running = {
        series.replace("global_new_", "cumulative_global_"): F.sum(series).over(so_far)
        for series in GLOBAL_SERIES.values()
    }
    means = {
        "rolling_avg_confirmed_7d": F.round(F.avg("global_new_confirmed").over(week), 0),
        "rolling_avg_deceased_7d": F.round(F.avg("global_new_deceased").over(week), 0),
    }
    return (
        daily.withColumns({**running, **means})
        .withColumns(
            {
                "rolling_avg_7d": F.col("rolling_avg_confirmed_7d"),
                "rolling_avg_deaths_7d": F.col("rolling_avg_deceased_7d"),
            }
        )
        .orderBy("date")
    )


def country_daily_summary(df: DataFrame) -> DataFrame:
    """Country by date: summed increments and highest running totals, where present."""
    sums = [c for c in DAILY_INCREMENTS if c in df.columns]
    peaks = [c for c in DAILY_RUNNING_TOTALS if c in df.columns]
    return (
        _named_rows(df)
        .groupBy(*LOCATION, "date")
        .agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in peaks])
        .orderBy("date", "country_name")
    )


def vaccination_summary(df: DataFrame) -> DataFrame:
    people, doses = "new_persons_vaccinated", "new_vaccine_doses_administered"
    if people not in df.columns and doses not in df.columns:
        return empty_result(df, "vaccination_summary")
    return (
        _named_rows(df)
        .groupBy(*LOCATION)
        .agg(
            _total(df, people, "total_people_vaccinated"),
            _peak(df, "cumulative_persons_vaccinated", "cumulative_people_vaccinated"),
            _peak(df, people, "peak_daily_people_vaccinated"),
            F.count_if(_or_null(df, people) > 0).alias("vaccination_days"),
            _total(df, doses, "total_vaccine_doses_administered"),
            _peak(
                df,
                "cumulative_vaccine_doses_administered",
                "cumulative_vaccine_doses_administered",
            ),
            _peak(df, doses, "peak_daily_vaccine_doses_administered"),
        )
        .withColumn("total_vaccinated", F.col("total_people_vaccinated"))
        .orderBy(F.desc("total_vaccine_doses_administered"), "location_key")
    )


def hospitalization_summary(df: DataFrame) -> DataFrame:
    """Admissions per country over the days that report any."""
    metric = "new_hospitalized_patients"
    if metric not in df.columns:
        return empty_result(df, "hospitalization_summary")
    return (
        _named_rows(df)
        .filter(F.col(metric) > 0)
        .groupBy(*LOCATION)
        .agg(
            F.sum(metric).alias("total_hospitalized"),
            F.max(metric).alias("peak_hospitalized"),
            F.round(F.avg(metric), 2).alias("avg_daily_hospitalized"),
        )
        .orderBy(F.desc("total_hospitalized"), "location_key")
    )


def regional_summary(df: DataFrame) -> DataFrame:
    """Totals per sub-national location; the name falls back to the key."""
    regional = df.filter(is_regional())
    name = F.col("location_key")
    if "country_name" in df.columns:
        name = F.coalesce("country_name", "location_key")
    parent = F.lit(None).cast("string")
    if "parent_country" in df.columns:
        parent = F.col("parent_country")
    totals = [
        _total(df, "new_confirmed", "total_confirmed"),
        _total(df, "new_deceased", "total_deceased"),
        _total(df, "new_recovered", "total_recovered"),
        F.count("date").alias("days_reported"),
    ]
    if "new_persons_vaccinated" in df.columns:
        totals.append(_total(df, "new_persons_vaccinated", "total_people_vaccinated"))
    if "new_vaccine_doses_administered" in df.columns:
        totals.append(
            _total(df, "new_vaccine_doses_administered", "total_vaccine_doses_administered")
        )
    return (
        regional.withColumns(
            {"region_name": name, "country_code": country_code(), "parent_country": parent}
        )
        .groupBy("location_key", "region_name", "country_code", "parent_country")
        .agg(*totals)
        .orderBy(F.desc("total_confirmed"), "location_key")
    )


def run_all(
    country: DataFrame,
    demographics: DataFrame | None = None,
    regional: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every result as a lazy frame; the regional one only when its frame is given."""
    results = {
        "global_metrics": global_metrics(country),
        "country_summary": country_summary(country, demographics),
        "daily_summary": daily_summary(country),
        "country_daily_summary": country_daily_summary(country),
        "vaccination_summary": vaccination_summary(country),
        "hospitalization_summary": hospitalization_summary(country),
    }
    if regional is not None:
        results["regional_summary"] = regional_summary(regional)
    return results
