"""Every operator as a query over the driver's tables, read as daily reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.functions.expressions import with_metric
from epiledger.functions.keys import has_case_data, is_country, is_regional
from epiledger.operators import cleaning, contracts, estimates, explore, lookups, pages, partials
from epiledger.operators import quality, scores, series, summaries, unclean
from epiledger.operators.frames import country_frame, facts_frame, regional_frame
from epiledger.plans import reports, views
from epiledger.sources import readers, sinks, testbed
from epiledger.sources.shared import as_table, shared_folder
from epiledger.streaming.key_counts import add_counts, count_keys

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = ["src_id"]
COUNTRIES = ["NATION_1", "NATION_2", "NATION_3", "NATION_8"]
METRICS = [
    "total_confirmed", "total_deceased", "total_recovered", "days_reported", "population",
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -----------------------------------------------------------


def _country(spark, d):
    return country_frame(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        testbed.hospitalizations(spark, d),
        order_by=ORDER,
    )


def _country_cases(spark, d):
    """Country rows for results that read no vaccination or admission column."""
    return country_frame(testbed.cases(spark, d), testbed.index(spark, d), order_by=ORDER)


def _country_vaccinated(spark, d):
    return country_frame(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        order_by=ORDER,
    )


def _regional(spark, d):
    return regional_frame(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        order_by=ORDER,
    )


def _country_summary(spark, d):
    return summaries.country_summary(
        _country_vaccinated(spark, d), testbed.demographics(spark, d)
    )


def _country_daily(spark, d):
    return summaries.country_daily_summary(_country_vaccinated(spark, d))


def _daily(spark, d):
    return summaries.daily_summary(_country_vaccinated(spark, d))


def _vaccination(spark, d):
    return summaries.vaccination_summary(_country_vaccinated(spark, d))


def _raw_days(spark, d):
    return unclean.raw_days(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        testbed.hospitalizations(spark, d),
    )


def _scratch(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- cleaning ----------------------------------------------------------------


@query
def clean_records(spark, d):
    return cleaning.clean(testbed.cases(spark, d), order_by=ORDER)


@query
def clean_negatives_only(spark, d):
    return cleaning.clip_metrics(cleaning.cast_metrics(testbed.cases(spark, d)))


@query
def clean_increments(spark, d):
    return estimates.increments(testbed.cases(spark, d))


@query
def unparseable_dates(spark, d):
    """Dates as text, some of no day: such reports stay, one a location, as the key check runs first."""
    text = F.when(F.col("src_id") % 13 == 5, F.lit("31/31/2021")).otherwise(F.col("date").cast("string"))
    return cleaning.clean(testbed.cases(spark, d).withColumn("date", text), order_by=ORDER)


@query
def drop_missing_keys(spark, d):
    return cleaning.drop_missing_keys(testbed.cases(spark, d))


@query
def fill_all_numeric(spark, d):
    return cleaning.fill_all_numeric(testbed.cases(spark, d))


@query
def dedupe_first(spark, d):
    return cleaning.dedupe(testbed.cases(spark, d), ["date", "location_key"], ORDER)


@query
def latest_rows(spark, d):
    return cleaning.latest_rows(
        testbed.cases(spark, d).filter(F.col("location_key").isNotNull()), ["location_key"]
    )


# --- levels and frames -------------------------------------------------------


@query
def country_level_rows(spark, d):
    return testbed.cases(spark, d).filter(is_country() & has_case_data())


@query
def regional_level_rows(spark, d):
    return testbed.cases(spark, d).filter(is_regional() & has_case_data())


@query
def index_level_rows(spark, d):
    return estimates.index_level(testbed.index(spark, d), 1)


@query
def level_one_members(spark, d):
    keys = estimates.index_level(testbed.index(spark, d), 1).select("location_key")
    return lookups.keep_members(testbed.cases(spark, d), keys, "location_key")


@query
def named_cases(spark, d):
    return lookups.with_country_name(testbed.cases(spark, d), testbed.index(spark, d))


@query
def parent_countries(spark, d):
    cases = testbed.cases(spark, d).filter(is_regional())
    return lookups.with_parent_country(cases, testbed.index(spark, d))


@query
def continents_of_cases(spark, d):
    return lookups.with_continent(testbed.cases(spark, d), testbed.continents(spark, d))


@query
def country_frame_rows(spark, d):
    return _country(spark, d)


@query
def regional_frame_rows(spark, d):
    return _regional(spark, d)


@query
def facts_frame_rows(spark, d):
    return facts_frame(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        testbed.hospitalizations(spark, d),
        order_by=ORDER,
    )


# --- results -----------------------------------------------------------------


@query
def global_metrics(spark, d):
    return summaries.global_metrics(_country_vaccinated(spark, d))


@query
def country_summary(spark, d):
    return _country_summary(spark, d)


@query
def country_summary_no_population(spark, d):
    return summaries.country_summary(_country_cases(spark, d), None)


@query
def daily_summary(spark, d):
    return _daily(spark, d)


@query
def daily_summary_calendar(spark, d):
    return summaries.daily_summary(_country_vaccinated(spark, d), calendar=True)


@query
def country_calendar_means(spark, d):
    """Trailing means of seven days per country, whose reports have gaps."""
    metrics = ["new_confirmed", "new_deceased"]
    rows = _country_daily(spark, d).select("location_key", "date", *metrics)
    return series.calendar_means(rows, metrics, ["location_key"], digits=6)


@query
def country_calendar_sums(spark, d):
    """The same over fourteen days, days without a report counting as zero."""
    rows = _country_daily(spark, d).select("location_key", "date", "new_confirmed")
    return series.calendar_means(rows, ["new_confirmed"], ["location_key"], 14, absent_as_zero=True, digits=6)


@query
def monthly_completeness(spark, d):
    return series.completeness(testbed.cases(spark, d), ["new_confirmed", "cumulative_confirmed"])


@query
def country_zscores(spark, d):
    """Scores of each report within its country; locations without a name are a group."""
    rows = _country(spark, d).select("country_name", "location_key", "date", "new_confirmed", "new_hospitalized_patients")
    return scores.zscores(rows, ["new_confirmed", "new_hospitalized_patients"], ["country_name"], digits=6)


@query
def country_zscores_merged(spark, d):
    """The same off moments kept per year and merged."""
    metrics = ["new_confirmed", "new_hospitalized_patients"]
    rows = _country(spark, d).select("country_name", "location_key", "date", *metrics)
    parts = scores.moments(rows.withColumn("year", F.year("date")), metrics, ["country_name", "year"])
    known = scores.merge_moments(as_table(parts, "moments"), metrics, ["country_name"])
    return scores.zscores(rows, metrics, ["country_name"], digits=6, known=known)


@query
def country_daily_summary(spark, d):
    return _country_daily(spark, d)


@query
def vaccination_summary(spark, d):
    return _vaccination(spark, d)


@query
def hospitalization_summary(spark, d):
    frame = country_frame(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        hospitalizations=testbed.hospitalizations(spark, d),
        order_by=ORDER,
    )
    return summaries.hospitalization_summary(frame)


@query
def regional_summary(spark, d):
    return summaries.regional_summary(_regional(spark, d))


@query
def run_all_counts(spark, d):
    s = testbed.load(spark, d)
    inputs = reports.Inputs(
        s.cases, s.index, s.vaccinations, s.hospitalizations, s.demographics
    )
    return quality.row_counts(reports.results_of(inputs, "clean", ORDER))


_TEXTS = [
    "location_key", "country_name", "region_name", "country_code", "parent_country", "continent", "date",
    "latest_data_date",
]


def _stored_run(spark, d, variant):
    """Every value of every result of a run, as read back from where the run stored it."""
    s, base = testbed.load(spark, d), _scratch(spark, f"run-{variant}")
    inputs = reports.Inputs(
        s.cases, s.index, s.vaccinations, s.hospitalizations, s.demographics,
        continents=s.continents, overrides=_overrides(spark, d),
    )
    results = reports.results_of(inputs, variant, ORDER)
    sinks.write_results(results, base)
    parts = []
    for name in results:
        df = readers.read_parquet(spark, base, name)
        texts = [c for c in _TEXTS if c in df.columns]
        metrics = [c for c in df.columns if c not in texts]
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts])
        values = F.array(
            *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics]
        )
        rows = df.select(F.lit(name).alias("result"), key.alias("key"), F.explode(values).alias("v"))
        parts.append(rows.select("result", "key", "v.*").where("value IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


@query
def stored_run_clean(spark, d):
    return _stored_run(spark, d, "clean")


@query
def stored_run_raw(spark, d):
    return _stored_run(spark, d, "raw")


@query
def stored_run_estimated(spark, d):
    return _stored_run(spark, d, "estimated")


# --- raw and estimating variants ---------------------------------------------


@query
def country_summary_raw(spark, d):
    return unclean.raw_country_summary(_raw_days(spark, d))


@query
def daily_summary_raw(spark, d):
    return unclean.raw_daily_summary(_raw_days(spark, d))


@query
def vaccination_summary_raw(spark, d):
    return unclean.raw_vaccination_summary(_raw_days(spark, d))


@query
def hospitalization_summary_raw(spark, d):
    return unclean.raw_hospitalization_summary(_raw_days(spark, d))


def _overrides(spark, d):
    """Supplied totals for the nations of region 1; recoveries known only for some."""
    key = F.expr(testbed.place_key("n_nationkey"))
    number = F.col("n_nationkey")
    return (
        testbed.table(spark, d, "nation")
        .filter(F.col("n_regionkey") == 1)
        .select(
            key.alias("location_key"),
            F.concat(F.lit("Republic "), "n_name").alias("country_name"),
            (number * 1000.0 + 5).cast("double").alias("total_confirmed"),
            (number * 10.0).cast("double").alias("total_deceased"),
            F.when(number % 2 == 0, (number * 500.0).cast("double")).alias("total_recovered"),
            (number * 1_000_000.0).cast("double").alias("population"),
        )
    )


@query
def country_summary_estimated(spark, d):
    return estimates.country_estimates(
        testbed.cases(spark, d),
        testbed.index(spark, d),
        testbed.vaccinations(spark, d),
        testbed.demographics(spark, d),
        testbed.continents(spark, d),
        _overrides(spark, d),
    )


@query
def daily_summary_vaccinated(spark, d):
    return estimates.daily_estimates(testbed.cases(spark, d), testbed.vaccinations(spark, d))


@query
def vaccination_summary_all_days(spark, d):
    return estimates.vaccination_totals(testbed.vaccinations(spark, d), testbed.index(spark, d))


@query
def hospitalization_all_rows(spark, d):
    return estimates.hospitalization_totals(
        testbed.hospitalizations(spark, d), testbed.index(spark, d)
    )


@query
def regional_summary_level1(spark, d):
    return estimates.regional_estimates(testbed.cases(spark, d), testbed.index(spark, d))


@query
def chunked_daily_totals(spark, d):
    """Case reports that arrive as two pieces, summed as one."""
    cases = testbed.cases(spark, d)
    cut = F.lit("1998-01-01").cast("date")
    pieces = [cases.filter(F.col("date") < cut), cases.filter(F.col("date") >= cut)]
    return estimates.daily_estimates(
        estimates.add_chunks(pieces), testbed.vaccinations(spark, d)
    )


@query
def chunk_totals_merged(spark, d):
    """The same off sums kept per chunk: three chunks, one of them delivered twice."""
    cases, folder = testbed.cases(spark, d), _scratch(spark, "chunks")
    year = F.coalesce(F.year("date"), F.lit(0))
    chunks = {"old": year < 1994, "middle": year.between(1994, 1997), "new": year > 1997}
    for name, rows in [*chunks.items(), ("middle", chunks["middle"])]:
        partials.store_chunk(cases.filter(rows), folder, name)
    return partials.merged_daily(spark, folder, testbed.vaccinations(spark, d))


@query
def override_merge(spark, d):
    return lookups.override_merge(
        _country_summary(spark, d), _overrides(spark, d), "location_key"
    )


@query
def country_row_counts(spark, d):
    return count_keys(testbed.cases(spark, d))


@query
def added_counts(spark, d):
    counts = count_keys(testbed.cases(spark, d))
    lines = counts.select(F.concat_ws("\t", "location_key", "rows").alias("value"))
    broken = counts.select(F.concat_ws("\t", "location_key", F.lit("n/a")).alias("value"))
    return add_counts(lines.union(broken).union(lines))


# --- series ------------------------------------------------------------------


@query
def period_summary(spark, d):
    return series.period_summary(
        _country_daily(spark, d), "1996-03-01", "1999-10-31", testbed.demographics(spark, d)
    )


@query
def period_summary_all(spark, d):
    return series.period_summary(
        _country_daily(spark, d), population=testbed.demographics(spark, d)
    )


@query
def date_range(spark, d):
    return series.between_dates(_daily(spark, d), "1996-03-01", "1999-10-31")


@query
def selected_countries_daily(spark, d):
    return series.selected_daily(_country_daily(spark, d), COUNTRIES)


@query
def resample_daily(spark, d):
    return series.resample(_daily(spark, d), "daily")


@query
def resample_weekly(spark, d):
    return series.resample(_daily(spark, d), "weekly")


@query
def resample_monthly(spark, d):
    return series.resample(_daily(spark, d), "monthly")


@query
def resample_weekly_cumulative(spark, d):
    return series.running_totals(series.resample(_daily(spark, d), "weekly"))


@query
def monthly_top_countries(spark, d):
    return series.monthly_top(_country_daily(spark, d), "new_confirmed", 12)


@query
def country_month_pivot(spark, d):
    return series.month_pivot(_country_daily(spark, d), "new_confirmed", 20)


@query
def peak_day(spark, d):
    return series.peak_period(_daily(spark, d))


@query
def date_bounds(spark, d):
    return series.date_bounds(testbed.cases(spark, d))


# --- tables and filters ------------------------------------------------------


@query
def enriched_country_metrics(spark, d):
    return summaries.enriched_country_summary(
        _country_vaccinated(spark, d), testbed.demographics(spark, d), testbed.continents(spark, d)
    )


@query
def merged_country_metrics(spark, d):
    """The same off stored country and vaccination results, merged."""
    frame = as_table(_country_vaccinated(spark, d), "facts")
    country = summaries.country_summary(frame, testbed.demographics(spark, d))
    vaccination = summaries.vaccination_summary(frame)
    return lookups.enriched_country_metrics(country, vaccination, testbed.continents(spark, d))


@query
def coalescing_merge(spark, d):
    """Totals missing on the left for odd days come from the right."""
    left = _country_summary(spark, d).withColumn(
        "total_people_vaccinated",
        F.when(F.col("days_reported") % 2 == 0, F.col("total_people_vaccinated")),
    )
    return lookups.coalescing_merge(
        left.select("location_key", "total_people_vaccinated"),
        _vaccination(spark, d),
        "location_key",
        ["total_people_vaccinated", "peak_daily_vaccine_doses_administered"],
    )


@query
def late_population(spark, d):
    country = summaries.country_summary(_country_cases(spark, d))
    country = country.drop("population", "cases_per_million", "deaths_per_million")
    return lookups.period_rates(
        lookups.with_population(country, testbed.demographics(spark, d))
    )


@query
def renamed_doses(spark, d):
    older = _vaccination(spark, d).withColumnRenamed(
        "total_vaccine_doses_administered", "total_vaccine_doses"
    )
    return lookups.normalize_vaccination_columns(older)


@query
def map_names(spark, d):
    names = {"NATION_1": "First Nation", "NATION_2": "Second Nation"}
    rows = _country_summary(spark, d).select("location_key", "country_name")
    return lookups.with_map_names(rows, names)


@query
def kpis(spark, d):
    return explore.key_figures(_country_vaccinated(spark, d))


@query
def kpis_from_countries(spark, d):
    return explore.key_figures(_country_vaccinated(spark, d), False, {"active_cases": 22.0})


@query
def kpis_from_stored_results(spark, d):
    """Key figures off results already stored, as a reader of a finished run has them."""
    frame = as_table(_country_vaccinated(spark, d), "facts")
    results = {
        "world": summaries.global_metrics(frame),
        "country": summaries.country_summary(frame, testbed.demographics(spark, d)),
        "daily": summaries.daily_summary(frame),
    }
    return explore.kpis(**{name: as_table(df, name) for name, df in results.items()})


@query
def custom_metrics(spark, d):
    """Metrics as users write them, over the country result."""
    rows = _country_summary(spark, d).select("location_key", *METRICS)
    rows = with_metric(rows, "deaths_per_case", "total_deceased / total_confirmed * 100")
    rows = with_metric(rows, "open_share", "(total_confirmed - total_recovered - total_deceased) / population")
    rows = with_metric(rows, "balance", "greatest(-total_recovered, abs(total_deceased - 3.5)) + coalesce(population, 1e3)")
    return with_metric(rows, "per_quiet_day", "total_confirmed / (days_reported - 100)")


def _report_pages(spark, d):
    rows = _country_daily(spark, d).select("location_key", "date", F.expr("nullif(new_confirmed, 0)").alias("new_confirmed"))
    return pages.paged(rows, "new_confirmed", ["location_key", "date"])


@query
def paged_reports(spark, d):
    """All pages of 50 reports from the largest down, as a reader turns them."""
    return _report_pages(spark, d).withColumn("page", F.floor(F.col("row") / 50))


@query
def page_after_key(spark, d):
    """The page of 50 that follows row 149, by seeking past its value and keys."""
    table = _report_pages(spark, d)
    last = tuple(table.where("row = 149").select("new_confirmed", "location_key", "date", "row").first())
    return pages.page_after(table, "new_confirmed", ["location_key", "date"], 50, last)


@query
def continent_totals(spark, d):
    return explore.continent_totals(_country_summary(spark, d), testbed.continents(spark, d))


def _world(spark, d):
    return _country_summary(spark, d).agg(
        F.sum("total_confirmed").alias("total_confirmed"),
        F.sum("total_deceased").alias("total_deceased"),
        F.sum("total_recovered").alias("total_recovered"),
    )


@query
def ranked_breakdown(spark, d):
    return explore.ranked_breakdown(
        _country_summary(spark, d),
        continents=testbed.continents(spark, d),
        world=_world(spark, d),
    )


@query
def ranked_breakdown_continent(spark, d):
    return explore.ranked_breakdown(
        _country_summary(spark, d), "ASIA", continents=testbed.continents(spark, d)
    )


@query
def ranked_breakdown_search(spark, d):
    return explore.ranked_breakdown(
        _country_summary(spark, d), pattern="_1[0-9]$|^04", continents=testbed.continents(spark, d)
    )


@query
def vaccination_kpis(spark, d):
    return explore.vaccination_kpis(_vaccination(spark, d))


@query
def regional_kpis(spark, d):
    return explore.regional_kpis(summaries.regional_summary(_regional(spark, d)))


def _by_continent(spark, d):
    return lookups.with_continent(_country_summary(spark, d), testbed.continents(spark, d))


@query
def adhoc_sum(spark, d):
    return explore.adhoc(_by_continent(spark, d), "continent", "total_confirmed", "sum")


@query
def adhoc_mean(spark, d):
    return explore.adhoc(_by_continent(spark, d), "continent", "days_reported", "mean")


@query
def adhoc_median(spark, d):
    return explore.adhoc(_by_continent(spark, d), "continent", "total_confirmed", "median")


@query
def adhoc_median_cases(spark, d):
    return explore.adhoc(
        testbed.cases(spark, d), "location_key", "new_confirmed", "median"
    )


@query
def adhoc_max(spark, d):
    return explore.adhoc(_by_continent(spark, d), "continent", "total_confirmed", "max")


@query
def hierarchy_rollup(spark, d):
    return explore.hierarchy(
        summaries.regional_summary(_regional(spark, d)),
        "parent_country",
        "location_key",
        "total_confirmed",
    )


@query
def normalized_comparison(spark, d):
    return explore.compare(
        _country_summary(spark, d),
        COUNTRIES,
        ["total_confirmed", "total_deceased", "case_fatality_rate", "days_reported"],
    )


@query
def metric_correlations(spark, d):
    return explore.correlations(_country_summary(spark, d), METRICS).select(
        "metric_a", "metric_b", F.round("correlation", 6).alias("correlation")
    )


@query
def case_correlations(spark, d):
    """Over every case report; deceased and recovered are constant together."""
    return explore.correlations(
        testbed.cases(spark, d), ["new_confirmed", "new_deceased", "new_recovered"]
    ).select("metric_a", "metric_b", F.round("correlation", 6).alias("correlation"))


@query
def metric_histogram(spark, d):
    return explore.histogram(testbed.cases(spark, d), "new_confirmed", 20)


@query
def metric_quartiles(spark, d):
    return explore.quartiles(testbed.cases(spark, d), "new_confirmed")


@query
def metric_quartiles_by_country(spark, d):
    return explore.quartiles(
        testbed.cases(spark, d).filter(is_country()), "new_recovered", "location_key"
    )


@query
def metric_outliers(spark, d):
    return explore.outliers(
        testbed.vaccinations(spark, d), "new_vaccine_doses_administered", "location_key"
    )


@query
def metric_whiskers(spark, d):
    return explore.whiskers(
        testbed.vaccinations(spark, d), "new_vaccine_doses_administered", "location_key"
    )


@query
def top_countries_cases(spark, d):
    return explore.top(_country_summary(spark, d), "total_confirmed", 10)


@query
def top_countries_deaths(spark, d):
    return explore.top(_country_summary(spark, d), "total_deceased", 10)


@query
def top_cfr(spark, d):
    return explore.top(_country_summary(spark, d), "case_fatality_rate", 15)


@query
def top_cfr_min_volume(spark, d):
    busy = explore.above(_country_summary(spark, d), "total_confirmed", 10_000)
    return explore.top(busy, "case_fatality_rate", 20)


@query
def top_vaccination(spark, d):
    return explore.top(_vaccination(spark, d), "total_vaccine_doses_administered", 15)


@query
def top_peak_vaccination(spark, d):
    return explore.top(_vaccination(spark, d), "peak_daily_vaccine_doses_administered", 15)


@query
def top_regions(spark, d):
    return explore.top(summaries.regional_summary(_regional(spark, d)), "total_confirmed", 30)


@query
def regions_of_countries(spark, d):
    regions = summaries.regional_summary(_regional(spark, d))
    return explore.only(regions, "parent_country", COUNTRIES)


@query
def regions_by_name(spark, d):
    regions = summaries.regional_summary(_regional(spark, d))
    return explore.only(regions, "region_name", ["NATION_4", "NATION_9"])


@query
def point_lookup(spark, d):
    return explore.point(_country_summary(spark, d), "07")


@query
def continent_filter(spark, d):
    return explore.of_continent(_by_continent(spark, d), "EUROPE")


@query
def threshold_filter(spark, d):
    return explore.at_least(
        _country_summary(spark, d),
        {"total_confirmed": 100_000, "population": 5_000_000, "total_people_vaccinated": 10},
    )


@query
def search_any_column(spark, d):
    return explore.search_anywhere(summaries.regional_summary(_regional(spark, d)), "_high_f")


@query
def search_regex(spark, d):
    return explore.search_places(_country_summary(spark, d), "^nation_2|^1[0-3]$")


@query
def sort_nulls_last(spark, d):
    """Positions of the sorted rows, since a bag of rows has no order."""
    rows = _country_summary(spark, d).select("location_key", "cases_per_million")
    return explore.numbered(
        explore.sort_rows(rows, "cases_per_million"), "cases_per_million"
    )


@query
def sort_ascending(spark, d):
    """The place of each value as the sort delivers it, nulls last."""
    rows = _country_summary(spark, d).select("cases_per_million")
    placed = explore.sort_rows(rows, "cases_per_million", descending=False).withColumn(
        "place", F.monotonically_increasing_id()
    )
    position = F.row_number().over(Window.orderBy("place"))
    return placed.select("cases_per_million", position.alias("position"))


@query
def filter_bounds(spark, d):
    return explore.filter_bounds(_country_summary(spark, d))


@query
def distinct_keys(spark, d):
    return explore.distinct_keys(testbed.cases(spark, d))


@query
def distinct_countries(spark, d):
    return explore.distinct_sorted(_country_summary(spark, d), "country_name")


@query
def source_preview_columns(spark, d):
    """Column-subset scan of a fact table."""
    return testbed.cases(spark, d).select("location_key", "new_confirmed")


# --- quality, sources, sinks, views ------------------------------------------


@query
def data_quality(spark, d):
    country = as_table(_country_summary(spark, d), "country-summary")
    return quality.quality_reports(
        {
            "cases": testbed.cases(spark, d).drop("src_id"),
            "country_summary": country,
            "empty": country.filter("total_confirmed < 0"),
        }
    )


@query
def value_contracts(spark, d):
    """Types, ranges and keys of the raw reports, all in one aggregation."""
    rules = [
        contracts.required("location_key"),
        contracts.required("new_confirmed"),
        contracts.castable("location_key", "int"),
        contracts.between("new_confirmed", 0, 900),
        contracts.one_of("new_deceased", [float(k) for k in range(15)]),
        contracts.shaped("location_key", "^[0-9]{2}(_[A-Z]+)?$"),
        contracts.at_most("new_recovered", "cumulative_recovered"),
    ]
    return contracts.check_values(testbed.cases(spark, d), rules, ["location_key", "date"])


@query
def parquet_roundtrip(spark, d):
    base = _scratch(spark, "results")
    sinks.write_results({"regional_summary": summaries.regional_summary(_regional(spark, d))}, base)
    return readers.read_parquet(spark, base, "regional_summary")


@query
def compact_parquet(spark, d):
    path = _scratch(spark, "compact")
    sinks.write_compact(_country_summary(spark, d), path)
    return spark.read.parquet(path)


@query
def documents_roundtrip(spark, d):
    base = _scratch(spark, "documents")
    sinks.write_documents(_country_summary(spark, d), base, "country_summary")
    return readers.read_documents(spark, base, "country_summary")


@query
def documents_roundtrip_raw(spark, d):
    base = _scratch(spark, "documents")
    raw = unclean.raw_country_summary(_raw_days(spark, d))
    sinks.write_documents(raw, base, "country_summary")
    return readers.read_documents(spark, base, "country_summary")


@query
def documents_roundtrip_estimated(spark, d):
    """The estimated country summary off a stored collection, every column."""
    base = _scratch(spark, "documents")
    sinks.write_documents(country_summary_estimated(spark, d), base, "country_summary")
    return readers.read_documents(spark, base, "country_summary")


@query
def all_documents_counts(spark, d):
    """Collections of several results written together, counted as they are read back."""
    base = _scratch(spark, "documents")
    results = {
        "country_summary": _country_summary(spark, d),
        "vaccination_summary": _vaccination(spark, d),
    }
    sinks.write_all_documents(results, base)
    return quality.row_counts(
        {name: readers.read_documents(spark, base, name) for name in results}
    )


@query
def dedupe_default_order(spark, d):
    """One report per place and day without a given order: the least by its columns."""
    cases = testbed.cases(spark, d).select("date", "location_key", "new_confirmed", "src_id")
    return cleaning.dedupe(cleaning.drop_missing_keys(cases), ["date", "location_key"])


@query
def repeated_dimension_keys(spark, d):
    """A dimension with several rows a key: facts are not multiplied."""
    customers = testbed.table(spark, d, "customer").selectExpr(
        f"{testbed.place_key('c_nationkey')} AS location_key", "c_mktsegment", "c_custkey"
    )
    cases = testbed.cases(spark, d).select("src_id", "location_key")
    return lookups.lookup(cases, customers, "location_key")


@query
def built_in_continents(spark, d):
    """The built-in continent table over country codes dealt to the nations."""
    codes = F.array(*[F.lit(c) for c in ["US", "BR", "FR", "IN", "ZA", "AU", "MO", "QQ"]])
    nations = testbed.table(spark, d, "nation").select(
        "n_name", F.get(codes, F.col("n_nationkey") % 8).alias("location_key")
    )
    return lookups.with_continent(nations, lookups.continent_table(spark))


@query
def documents_json(spark, d):
    """Documents as text, null fields left out."""
    rows = _country_summary(spark, d).select(
        "location_key", "country_name", "days_reported", "population"
    )
    return sinks.as_json(sinks.as_documents(rows, "2024-01-01T00:00:00Z"))


@query
def load_with_fallback(spark, d):
    """No documents were written, so the Parquet copy answers."""
    base = _scratch(spark, "fallback")
    sinks.write_results({"vaccination_summary": _vaccination(spark, d)}, base)
    df, label = readers.read_result(
        spark, "vaccination_summary", documents=f"{base}/documents", parquet=base
    )
    return df.withColumn("source", F.lit(label))


@query
def csv_roundtrip(spark, d):
    base = _scratch(spark, "csv")
    sinks.write_csv(testbed.cases(spark, d), f"{base}/cases.csv")
    rows = readers.read_csv(spark, base, "cases.csv")
    return cleaning.clean(
        rows.withColumn("src_id", F.col("src_id").try_cast("long")), order_by=ORDER
    ).withColumn("cumulative_recovered", F.col("cumulative_recovered").try_cast("double"))


@query
def inferred_csv_types(spark, d):
    """Types found by looking at the file."""
    base = _scratch(spark, "inferred")
    cases = testbed.cases(spark, d).select("src_id", "date", "location_key", "new_confirmed")
    sinks.write_csv(cases, f"{base}/cases.csv")
    return readers.read_typed_csv(spark, base, "cases.csv").withColumn("src_id", F.col("src_id").cast("long"))


@query
def typed_csv_roundtrip(spark, d):
    base = _scratch(spark, "typed")
    cases = testbed.cases(spark, d).select("src_id", "date", "location_key", "new_confirmed")
    sinks.write_csv(cases, f"{base}/cases.csv")
    return readers.read_typed_csv(
        spark,
        base,
        "cases.csv",
        "src_id long, date date, location_key string, new_confirmed double",
    )


@query
def optional_demographics(spark, d):
    """Population text read back where the file is there and has the column."""
    base = _scratch(spark, "demographics")
    sinks.write_csv(testbed.demographics(spark, d), f"{base}/demographics.csv")
    return readers.read_demographics(spark, base)


@query
def counts_text(spark, d):
    """Tab-separated counts as the line-oriented job writes them."""
    path = _scratch(spark, "counts")
    sinks.write_counts(count_keys(testbed.cases(spark, d)), path)
    return spark.read.text(path)


@query
def preview_rows(spark, d):
    return quality.row_counts({"preview": readers.preview(testbed.cases(spark, d), 500)})


@query
def explored_regions(spark, d):
    regions = summaries.regional_summary(_regional(spark, d))
    return views.explore(regions, "_HIGH_F", sort_by="total_confirmed")


@query
def key_line_counts(spark, d):
    """Keys counted off written lines, as the line-oriented job does."""
    base = _scratch(spark, "lines")
    cases = testbed.cases(spark, d)
    sinks.write_csv(cases.select("date", "location_key", "new_confirmed"), base)
    return count_keys(readers.read_key_lines(spark, base))


@query
def empty_metric(spark, d):
    """Vaccinations never reported: their result is empty, the others are not."""
    frame = _country_cases(spark, d)
    return quality.row_counts(
        {
            "country_summary": summaries.country_summary(frame),
            "vaccination_summary": summaries.vaccination_summary(frame),
            "hospitalization_summary": summaries.hospitalization_summary(frame),
        }
    )


@query
def filtered_country_view(spark, d):
    view = views.View("1996-01-01", "2000-12-31", COUNTRIES, {"total_confirmed": 1_000})
    return views.country_view(_country_daily(spark, d), view, testbed.demographics(spark, d))


@query
def filtered_series_view(spark, d):
    view = views.View(
        "1996-01-01", "2000-12-31", COUNTRIES, frequency="monthly", cumulative=True
    )
    return views.series_view(_daily(spark, d), _country_daily(spark, d), view)
