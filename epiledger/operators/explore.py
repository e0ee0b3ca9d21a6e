"""Questions asked of results: filters, search, rankings, comparisons, distributions.

Frames here hold one row per country or region, far smaller than the facts.
Sorting and numbering a per-country table in one task is bounded by the
two-character key; everything that also takes per-region or per-day rows is
written without a single-task step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from epiledger.functions.metrics import dose_metric, positive, zero
from epiledger.functions.quantiles import exact_quantiles
from epiledger.operators.lookups import with_continent
from epiledger.operators.summaries import location_totals


# --- filters -----------------------------------------------------------------


def only(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with one of the values; no values means no filter."""
    return df.filter(F.col(column).isin(list(values))) if values else df


def at_least(df: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    """Rows reaching every minimum, null counting as 0; absent metrics do not filter."""
    for column, minimum in minimums.items():
        if column in df.columns:
            df = df.filter(zero(F.col(column).cast("double")) >= minimum)
    return df


def above(df: DataFrame, column: str, floor: float) -> DataFrame:
    return df.filter(F.col(column) > floor)


def point(df: DataFrame, key: str, column: str = "location_key") -> DataFrame:
    return df.filter(F.col(column) == key)


def of_continent(df: DataFrame, continent: str = "All") -> DataFrame:
    return df if continent == "All" else df.filter(F.col("continent") == continent)


def search_places(df: DataFrame, pattern: str) -> DataFrame:
    """Name or key matches the regular expression, ignoring case."""
    wanted = pattern.strip()
    if not wanted:
        return df
    hits = [F.col(c).rlike(f"(?i){wanted}") for c in ("country_name", "location_key")]
    return df.filter(_any_of(hits))


def search_anywhere(df: DataFrame, text: str) -> DataFrame:
    """Any column contains the literal text, ignoring case."""
    if not text:
        return df
    wanted = F.lit(text.lower())
    return df.filter(
        _any_of([F.lower(F.col(c).cast("string")).contains(wanted) for c in df.columns])
    )


def _any_of(tests: Sequence[Column]) -> Column:
    hit = F.lit(False)
    for test in tests:
        hit = hit | F.coalesce(test, F.lit(False))
    return hit


# --- order and top -----------------------------------------------------------


def sort_rows(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """Sorted with nulls last in either direction."""
    order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return df.orderBy(order)


def top(df: DataFrame, metric: str, n: int, tie: str = "location_key") -> DataFrame:
    """The ``n`` largest by a metric, rows without it left out."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), tie).limit(n)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def numbered(df: DataFrame, metric: str, tie: str = "location_key") -> DataFrame:
    """Per-country rows numbered from the largest metric down."""
    order = Window.orderBy(F.desc_nulls_last(metric), tie)
    return df.withColumn("position", F.row_number().over(order))


# --- tables ------------------------------------------------------------------


def continent_totals(country: DataFrame, continents: DataFrame | None = None) -> DataFrame:
    """Totals and ratio-of-sums rates per continent."""
    placed = with_continent(country, continents)
    return (
        placed.groupBy("continent")
        .agg(
            F.sum("total_confirmed").alias("total_confirmed"),
            F.sum("total_deceased").alias("total_deceased"),
            F.sum("total_recovered").alias("total_recovered"),
            F.coalesce(F.sum("population"), F.lit(0)).alias("population"),
        )
        .withColumns(
            {
                "cases_per_million": F.col("total_confirmed")
                / (positive("population") / 1_000_000),
                "deaths_per_million": F.col("total_deceased")
                / (positive("population") / 1_000_000),
            }
        )
    )


def ranked_breakdown(
    country: DataFrame,
    continent: str = "All",
    pattern: str = "",
    continents: DataFrame | None = None,
    world: DataFrame | None = None,
    recovered_not_shown: Sequence[str] = (),
) -> DataFrame:
    """Countries numbered by cases, under a total row for the continent or the world.

    The total row has position 0.  A continent's is computed; the world's is the
    caller's row.  A search shows matches only.  Values that are not
    positive are null, and so are recoveries of the countries named as not shown.
    """
    shown = [
        "total_confirmed", "total_deceased", "total_recovered",
        "cases_per_million", "deaths_per_million", "population",
    ]
    placed = of_continent(with_continent(country, continents), continent)
    name = F.coalesce("country_name", "location_key")
    rows = numbered(search_places(placed, pattern), "total_confirmed").select(
        "position",
        name.alias("place"),
        "total_confirmed",
        "total_deceased",
        F.when(~name.isin(list(recovered_not_shown)), positive("total_recovered")).alias(
            "total_recovered"
        ),
        *[positive(c).alias(c) for c in shown[3:]],
    )
    if pattern.strip():
        return rows
    if continent == "All":
        head = world
    else:
        head = continent_totals(placed).withColumn(
            "place", F.concat("continent", F.lit(" Total"))
        )
        head = head.withColumns({c: positive(c) for c in ("total_recovered", "population")})
    if head is None:
        return rows
    total = head.select(
        F.lit(0).alias("position"),
        F.col("place") if "place" in head.columns else F.lit("World").alias("place"),
        *[
            F.col(c) if c in head.columns else F.lit(None).cast("double").alias(c)
            for c in shown
        ],
    )
    return total.unionByName(rows).orderBy("position")


def compare(df: DataFrame, countries: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Each metric of the chosen countries as percent of the choice's maximum."""
    chosen = only(df, "country_name", countries)
    present = [c for c in metrics if c in df.columns]
    peaks = chosen.agg(F.struct(*[F.max(c).alias(c) for c in present]).alias("_peaks"))
    scaled = chosen.withColumn("_peaks", peaks.scalar())

    def percent(c: str) -> Column:
        peak = F.col("_peaks")[c]
        return F.when(peak > 0, F.col(c) / peak * 100).otherwise(F.lit(0.0))

    return scaled.select(
        "country_name", "location_key", *[percent(c).alias(c) for c in present]
    )


def adhoc(df: DataFrame, group: str, metric: str, how: str) -> DataFrame:
    """One metric by one grouping; rows without a group form a group of their own."""
    if how == "median":
        medians = exact_quantiles(df, metric, [0.5], by=group)
        return medians.select(group, F.col("quantiles")[0].alias(metric))
    functions = {"sum": F.sum, "mean": F.avg, "max": F.max}
    value = functions[how](metric)
    if how == "sum":
        value = zero(value)
    return df.groupBy(group).agg(value.alias(metric))


def hierarchy(df: DataFrame, parent: str, child: str, metric: str) -> DataFrame:
    """Totals per child, per parent, and overall; ``level`` tells which."""
    return (
        df.rollup(parent, child)
        .agg(
            F.sum(metric).alias(metric),
            (F.grouping(parent) + F.grouping(child)).cast("int").alias("level"),
        )
        .select(parent, child, "level", metric)
    )


# --- key figures -------------------------------------------------------------

_KPIS = {
    "total_cases": "total_confirmed",
    "total_deaths": "total_deceased",
    "total_recoveries": "total_recovered",
    "active_cases": "active_cases",
    "total_vaccine_doses_administered": "total_vaccine_doses_administered",
    "total_people_vaccinated": "total_people_vaccinated",
}


def kpis(
    world: DataFrame | None,
    country: DataFrame | None,
    daily: DataFrame | None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Key figures: the world row where it has them, else country sums, else defaults.

    One-row frames are stacked with a rank and the best non-null value per figure
    is picked, which needs no join.
    """
    figures = [*_KPIS, "countries_regions", "latest_data_date"]
    kinds = {c: "double" for c in _KPIS}
    kinds |= {"countries_regions": "long", "latest_data_date": "date"}
    parts = []

    def stack(frame: DataFrame, rank: int, values: Mapping[str, Column]) -> None:
        columns = [
            values.get(f, F.lit(None)).cast(kinds[f]).alias(f) for f in figures
        ]
        parts.append(frame.select(F.lit(rank).alias("_rank"), *columns))

    if world is not None:
        names = {f: f for f in figures} | {
            "active_cases": "active_cases_worldwide",
            "countries_regions": "countries_reporting",
        }
        stack(world, 0, {f: F.col(c) for f, c in names.items() if c in world.columns})
    if country is not None:
        some = F.count(F.lit(1)) > 0
        sums = {
            f: F.when(some, zero(F.sum(c)))
            for f, c in _KPIS.items()
            if c in country.columns
        }
        if "location_key" in country.columns:
            sums["countries_regions"] = F.count_distinct("location_key")
        totals = country.agg(*[v.alias(f) for f, v in sums.items()])
        stack(totals, 1, {f: F.col(f) for f in sums})
    if daily is not None and "date" in daily.columns:
        stack(
            daily.agg(F.max("date").alias("date")), 2, {"latest_data_date": F.col("date")}
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    picked = rows.agg(
        *[
            F.min_by(f, F.when(_usable(f), F.col("_rank"))).alias(f)
            for f in figures
        ]
    ).fillna(0, ["countries_regions"])
    return _with_defaults(picked, defaults)


def key_figures(
    frame: DataFrame, by_world: bool = True, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """What ``kpis`` picks from the results of one clean frame, in one pass over it.

    World totals, country totals and the latest day are all functions of one row per location, so
    the frame collapses to that once and the levels are conditional sums of it, without a join or a
    second scan.  Without ``by_world`` only locations with a name count, as in country results.
    """
    locations = location_totals(frame, F.max("country_name").alias("country_name"))
    named = F.col("country_name").isNotNull()
    counts = F.lit(True) if by_world else named
    sources = dict(zip(_KPIS, ("confirmed", "deceased", "recovered", "open", "doses", "people"), strict=True))
    some = F.count_if(named) > 0
    picked = locations.agg(
        *[
            F.coalesce(F.sum(F.when(counts, F.col(c))), F.when(some, F.lit(0.0))).alias(f)
            for f, c in sources.items()
        ],
        F.count_if(counts & F.col("location_key").isNotNull()).alias("countries_regions"),
        F.max("latest_date").alias("latest_data_date"),
    )
    return _with_defaults(picked, defaults)


def _with_defaults(picked: DataFrame, defaults: Mapping[str, object] | None) -> DataFrame:
    """Each figure that is null or zero takes its default; a date only where it is null."""
    kinds = {f: "double" for f in _KPIS} | {"countries_regions": "long", "latest_data_date": "date"}
    values = {
        f: F.coalesce(_non_zero(f, kinds[f]), F.lit(v).cast(kinds[f])) for f, v in (defaults or {}).items()
    }
    return picked.withColumns(values) if values else picked


def _usable(figure: str) -> Column:
    found = F.col(figure).isNotNull()
    return found & (F.col(figure) != 0) if figure == "countries_regions" else found


def _non_zero(figure: str, kind: str) -> Column:
    if kind == "date":
        return F.col(figure)
    return F.when(F.col(figure) != 0, F.col(figure))


def vaccination_kpis(vaccination: DataFrame) -> DataFrame:
    """Total, leading country and number of countries."""
    metric = dose_metric(vaccination)
    order = F.struct(F.col(metric), F.col("country_name"))
    return vaccination.agg(
        zero(F.sum(metric)).alias("total"),
        F.max_by("country_name", F.when(F.col(metric).isNotNull(), order)).alias(
            "top_country"
        ),
        F.count(F.lit(1)).alias("countries"),
    )


def regional_kpis(regional: DataFrame) -> DataFrame:
    return regional.agg(
        F.count(F.lit(1)).alias("regions"),
        F.sum("total_confirmed").alias("total_confirmed"),
        F.sum("total_recovered").alias("total_recovered"),
        F.sum("total_deceased").alias("total_deceased"),
    )


def filter_bounds(country: DataFrame) -> DataFrame:
    """Highest value of each metric a minimum can be set on."""
    metrics = ["total_confirmed", "population", dose_metric(country)]
    return country.agg(
        *[
            F.max(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"max_{c}")
            for c in metrics
            if c in country.columns
        ]
    )


def distinct_keys(df: DataFrame, column: str = "location_key") -> DataFrame:
    return df.agg(F.count_distinct(column).alias("distinct_keys"))


# --- distributions -----------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def correlations(df: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form over the rows where both metrics are known.

    All moments come from one aggregation.  A constant metric has no correlation:
    null.
    """
    names = list(metrics or numeric_columns(df))
    cells = []
    for i, a in enumerate(names):
        for b in names[i:]:
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            both = x.isNotNull() & y.isNotNull()
            spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
            cells.append(
                F.struct(
                    F.array(*[F.lit(n) for n in dict.fromkeys([a, b])]).alias("names"),
                    F.try_divide(F.covar_pop(x, y), spread).alias("correlation"),
                )
            )
    pairs = df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))
    return pairs.select(F.explode("names").alias("metric_a"), "names", "correlation").select(
        "metric_a",
        F.when(F.col("metric_a") == F.element_at("names", 1), F.element_at("names", -1))
        .otherwise(F.element_at("names", 1))
        .alias("metric_b"),
        "correlation",
    )


def histogram(df: DataFrame, metric: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, empty bins included."""
    rows = df.filter(F.col(metric).isNotNull()).select(F.col(metric).alias("_value"))
    bounds = rows.agg(F.min("_value").alias("low"), F.max("_value").alias("high"))
    low = bounds.select("low").scalar()
    width = bounds.select(((F.col("high") - F.col("low")) / bins).alias("w")).scalar()
    bin_number = F.when(
        width > 0, F.least(F.floor((F.col("_value") - low) / width), F.lit(bins - 1))
    ).otherwise(F.lit(0))
    counted = rows.groupBy(bin_number.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    edges = bounds.filter(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        "low",
        ((F.col("high") - F.col("low")) / bins).alias("width"),
    )
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def quartiles(df: DataFrame, metric: str, by: str | None = None) -> DataFrame:
    """Quartiles and the fences 1.5 interquartile ranges outside them."""
    known = df.filter(F.col(metric).isNotNull())
    q = exact_quantiles(known, metric, [0.25, 0.5, 0.75], by)
    first, median, third = (F.col("quantiles")[i] for i in range(3))
    reach = (third - first) * 1.5
    return q.select(
        *([by] if by else []),
        first.alias("q1"),
        median.alias("median"),
        third.alias("q3"),
        (first - reach).alias("lower_fence"),
        (third + reach).alias("upper_fence"),
    )


def outliers(df: DataFrame, metric: str, by: str) -> DataFrame:
    """Rows outside the fences of their group."""
    fences = quartiles(df, metric, by).select(by, "lower_fence", "upper_fence")
    value = F.col(metric)
    return (
        df.join(fences, by)
        .filter((value < F.col("lower_fence")) | (value > F.col("upper_fence")))
        .drop("lower_fence", "upper_fence")
    )


def whiskers(df: DataFrame, metric: str, by: str) -> DataFrame:
    """Box per group: quartiles and the extreme values still inside the fences."""
    box = ["q1", "median", "q3"]
    inside = F.col(metric).between(F.col("lower_fence"), F.col("upper_fence"))
    return (
        df.join(quartiles(df, metric, by), by)
        .filter(inside)
        .groupBy(by, *box)
        .agg(F.min(metric).alias("lower_whisker"), F.max(metric).alias("upper_whisker"))
    )
