"""Column groups and result contracts."""

from __future__ import annotations

KEY_COLUMNS = ["date", "location_key"]

# Column names of the inputs.  These the cleaner casts, clips and fills.
CLEANED_METRICS = [
    "new_confirmed",
    "new_deceased",
    "new_recovered",
    "cumulative_confirmed",
    "cumulative_deceased",
    "new_persons_vaccinated",
    "cumulative_persons_vaccinated",
    "new_vaccine_doses_administered",
    "cumulative_vaccine_doses_administered",
    "new_hospitalized_patients",
    "cumulative_hospitalized_patients",
]

# Column names of the inputs and results, from here on.
CASE_METRICS = [
    "new_confirmed",
    "new_deceased",
    "new_recovered",
    "cumulative_confirmed",
    "cumulative_deceased",
    "cumulative_recovered",
]

VACCINE_METRICS = [
    "new_persons_vaccinated",
    "cumulative_persons_vaccinated",
    "new_vaccine_doses_administered",
    "cumulative_vaccine_doses_administered",
]

HOSPITAL_METRICS = ["new_hospitalized_patients", "current_hospitalized_patients"]

# Daily increments and running totals of a country-by-day table.
DAILY_INCREMENTS = [
    "new_confirmed",
    "new_deceased",
    "new_recovered",
    "new_persons_vaccinated",
    "new_vaccine_doses_administered",
]

DAILY_RUNNING_TOTALS = [
    "cumulative_confirmed",
    "cumulative_deceased",
    "cumulative_recovered",
    "cumulative_persons_vaccinated",
    "cumulative_vaccine_doses_administered",
]

# Increment -> total over a period, and increment -> series name of the world.
PERIOD_TOTALS = {
    "new_confirmed": "total_confirmed",
    "new_deceased": "total_deceased",
    "new_recovered": "total_recovered",
    "new_persons_vaccinated": "total_people_vaccinated",
    "new_vaccine_doses_administered": "total_vaccine_doses_administered",
}

GLOBAL_SERIES = {
    "new_confirmed": "global_new_confirmed",
    "new_deceased": "global_new_deceased",
    "new_recovered": "global_new_recovered",
    "new_persons_vaccinated": "global_new_vaccinated",
    "new_vaccine_doses_administered": "global_new_vaccine_doses_administered",
}

RESULT_DDL = {
    "global_metrics": (
        "total_cases double, total_deaths double, total_recoveries double, "
        "countries_reporting long, total_people_vaccinated double, "
        "total_vaccine_doses_administered double, latest_data_date date, "
        "active_cases_worldwide double"
    ),
    "country_summary": (
        "country_name string, location_key string, total_confirmed double, "
        "total_deceased double, total_recovered double, total_people_vaccinated double, "
        "total_vaccine_doses_administered double, "
        "cumulative_vaccine_doses_administered double, peak_cumulative_confirmed double, "
        "peak_cumulative_deceased double, peak_daily_confirmed double, days_reported long, "
        "active_cases double, case_fatality_rate double, population long, "
        "cases_per_million double, deaths_per_million double, total_vaccinated double"
    ),
    "daily_summary": (
        "date date, global_new_confirmed double, global_new_deceased double, "
        "global_new_recovered double, global_new_vaccinated double, "
        "global_new_vaccine_doses_administered double, cumulative_global_confirmed double, "
        "cumulative_global_deceased double, cumulative_global_recovered double, "
        "cumulative_global_vaccinated double, "
        "cumulative_global_vaccine_doses_administered double, "
        "rolling_avg_confirmed_7d double, rolling_avg_deceased_7d double, "
        "rolling_avg_7d double, rolling_avg_deaths_7d double"
    ),
    "country_daily_summary": (
        "country_name string, location_key string, date date, new_confirmed double, "
        "new_deceased double, new_recovered double, new_persons_vaccinated double, "
        "new_vaccine_doses_administered double, cumulative_confirmed double, "
        "cumulative_deceased double, cumulative_recovered double, "
        "cumulative_persons_vaccinated double, cumulative_vaccine_doses_administered double"
    ),
    "vaccination_summary": (
        "country_name string, location_key string, total_people_vaccinated double, "
        "cumulative_people_vaccinated double, peak_daily_people_vaccinated double, "
        "vaccination_days long, total_vaccine_doses_administered double, "
        "cumulative_vaccine_doses_administered double, "
        "peak_daily_vaccine_doses_administered double, total_vaccinated double"
    ),
    "hospitalization_summary": (
        "country_name string, location_key string, total_hospitalized double, "
        "peak_hospitalized double, avg_daily_hospitalized double"
    ),
    "regional_summary": (
        "location_key string, region_name string, country_code string, "
        "parent_country string, total_confirmed double, total_deceased double, "
        "total_recovered double, days_reported long, total_people_vaccinated double, "
        "total_vaccine_doses_administered double"
    ),
}

# The columns a reader of these results relies on.
REQUIRED_COLUMNS = {
    "country_summary": [
        "location_key", "country_name", "total_confirmed", "total_deceased",
        "total_recovered", "total_vaccinated", "peak_daily_confirmed",
        "days_reported", "case_fatality_rate",
    ],
    "daily_summary": [
        "date", "global_new_confirmed", "global_new_deceased", "global_new_recovered",
    ],
    "vaccination_summary": [
        "location_key", "country_name", "total_vaccinated",
        "cumulative_vaccinated", "peak_daily_vaccinated", "vaccination_days",
    ],
    "hospitalization_summary": [
        "location_key", "country_name", "total_hospitalized",
        "peak_hospitalized", "avg_daily_hospitalized", "hospitalization_days",
    ],
}
