"""Country results over raw rows: nothing clipped, deduplicated or zero-filled.

Repeated reports for one date and location pair up across the three inputs: two
case rows and two vaccination rows count as four.  Here each input is summed per
(date, location) first and the row counts of the other inputs restore the
multiplicity, so the totals are those of the paired rows but no pair is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.functions.keys import has_case_data, is_country
from epiledger.functions.metrics import fatality_rate, number, positive
from epiledger.operators.cleaning import parse_date
from epiledger.operators.lookups import with_country_name
from epiledger.schema import KEY_COLUMNS

LOCATION = ["country_name", "location_key"]


def _country_rows(df: DataFrame, metrics: list[str]) -> DataFrame:
    present = [c for c in metrics if c in df.columns]
    rows = df.filter(is_country())
    return parse_date(rows.select(*KEY_COLUMNS, *[number(c).alias(c) for c in present]))


def raw_days(
    cases: DataFrame,
    index: DataFrame,
    vaccinations: DataFrame | None = None,
    hospitalizations: DataFrame | None = None,
) -> DataFrame:
    """One row per (date, country): totals, peaks and pair counts of the raw rows."""
    days = (
        _country_rows(
            cases, ["new_confirmed", "new_deceased", "cumulative_confirmed"]
        )
        .filter(has_case_data())
        .groupBy(*KEY_COLUMNS)
        .agg(
            F.sum("new_confirmed").alias("confirmed"),
            F.sum("new_deceased").alias("deceased"),
            F.max("cumulative_confirmed").alias("peak_cumulative"),
            F.count(F.lit(1)).alias("case_rows"),
            F.count("date").alias("dated_rows"),
        )
    )
    people, so_far = "new_persons_vaccinated", "cumulative_persons_vaccinated"
    vaccine_rows, hospital_rows = F.lit(1), F.lit(1)
    if vaccinations is not None and people in vaccinations.columns:
        vaccine_rows = F.coalesce("vaccine_rows", F.lit(1))
        rows = _country_rows(vaccinations, [people, so_far])
        if so_far not in rows.columns:
            rows = rows.withColumn(so_far, F.lit(None).cast("double"))
        days = days.join(
            rows.groupBy(*KEY_COLUMNS).agg(
                F.sum(people).alias("people"),
                F.max(people).alias("peak_people"),
                F.max(so_far).alias("cumulative_people"),
                F.count(F.lit(1)).alias("vaccine_rows"),
            ),
            on=KEY_COLUMNS,
            how="left",
        )
    admitted = "new_hospitalized_patients"
    if hospitalizations is not None and admitted in hospitalizations.columns:
        hospital_rows = F.coalesce("hospital_rows", F.lit(1))
        days = days.join(
            _country_rows(hospitalizations, [admitted])
            .groupBy(*KEY_COLUMNS)
            .agg(
                F.sum(positive(admitted)).alias("admitted"),
                F.max(positive(admitted)).alias("peak_admitted"),
                F.count(positive(admitted)).alias("admission_rows"),
                F.count(F.lit(1)).alias("hospital_rows"),
            ),
            on=KEY_COLUMNS,
            how="left",
        )
    pairs = {
        "confirmed": F.col("confirmed") * vaccine_rows * hospital_rows,
        "deceased": F.col("deceased") * vaccine_rows * hospital_rows,
        "dated_rows": F.col("dated_rows") * vaccine_rows * hospital_rows,
    }
    if "people" in days.columns:
        pairs["people"] = F.col("people") * F.col("case_rows") * hospital_rows
    if "admitted" in days.columns:
        pairs["admitted"] = F.col("admitted") * F.col("case_rows") * vaccine_rows
        pairs["admission_rows"] = F.col("admission_rows") * F.col("case_rows") * vaccine_rows
    return with_country_name(days.withColumns(pairs), index)


def _by_country(days: DataFrame):
    return days.filter(F.col("country_name").isNotNull()).groupBy(*LOCATION)


def raw_country_summary(days: DataFrame) -> DataFrame:
    totals = [
        F.sum("confirmed").alias("total_confirmed"),
        F.sum("deceased").alias("total_deceased"),
    ]
    if "people" in days.columns:
        totals.append(F.sum("people").alias("total_vaccinated"))
    return (
        _by_country(days)
        .agg(
            *totals,
            F.max("peak_cumulative").alias("peak_cumulative"),
            F.sum("dated_rows").alias("days_reported"),
        )
        .withColumn("case_fatality_rate", fatality_rate("total_deceased", "total_confirmed"))
        .orderBy(F.desc("total_confirmed"), "location_key")
    )


def raw_daily_summary(days: DataFrame) -> DataFrame:
    """World series; the frame below runs over one row per calendar day."""
    totals = [
        F.sum("confirmed").alias("global_new_confirmed"),
        F.sum("deceased").alias("global_new_deceased"),
    ]
    if "people" in days.columns:
        totals.append(F.sum("people").alias("global_new_vaccinated"))
    week = Window.orderBy("date").rowsBetween(-6, 0)
    return (
        days.groupBy("date")
        .agg(*totals)
        .withColumn(
            "rolling_avg_7d", F.round(F.avg("global_new_confirmed").over(week), 0)
        )
        .orderBy("date")
    )


def raw_vaccination_summary(days: DataFrame) -> DataFrame:
    return (
        _by_country(days)
        .agg(
            F.sum("people").alias("total_vaccinated"),
            F.max("cumulative_people").alias("cumulative_vaccinated"),
            F.max("peak_people").alias("peak_daily_vaccinated"),
        )
        .orderBy(F.desc("total_vaccinated"), "location_key")
    )


def raw_hospitalization_summary(days: DataFrame) -> DataFrame:
    """Only countries with a positive admission; the mean is over such rows."""
    return (
        _by_country(days.filter(F.col("admission_rows") > 0))
        .agg(
            F.sum("admitted").alias("total_hospitalized"),
            F.max("peak_admitted").alias("peak_hospitalized"),
            F.round(F.sum("admitted") / F.sum("admission_rows"), 2).alias(
                "avg_daily_hospitalized"
            ),
        )
        .orderBy(F.desc("total_hospitalized"), "location_key")
    )


def raw_results(days: DataFrame) -> dict[str, DataFrame]:
    """The four raw results; a metric's result only when its column was reported."""
    results = {
        "country_summary": raw_country_summary(days),
        "daily_summary": raw_daily_summary(days),
    }
    if "people" in days.columns:
        results["vaccination_summary"] = raw_vaccination_summary(days)
    if "admitted" in days.columns:
        results["hospitalization_summary"] = raw_hospitalization_summary(days)
    return results
