import datetime as dt
import math

import numpy as np
import pytest
from conftest import rows

from epiledger.functions.quantiles import exact_quantiles
from epiledger.operators import explore, lookups


@pytest.fixture
def country(spark):
    return spark.createDataFrame(
        [
            ("India", "IN", 100.0, 5.0, 50.0, 10, None),
            ("Japan", "JP", 100.0, 1.0, 40.0, 20, 5.0),
            ("France", "FR", 300.0, 6.0, None, 0, 7.0),
            (None, "XX", 50.0, 2.0, 0.0, None, 9.0),
        ],
        "country_name string, location_key string, total_confirmed double, "
        "total_deceased double, total_recovered double, population long, "
        "case_fatality_rate double",
    ).selectExpr("*", "total_confirmed * 2 AS cases_per_million", "1D AS deaths_per_million")


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed):
    """A third of the values are one value; groups differ in size by 1000 times."""
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(6000) < 0.33, 7.0, rng.normal(50, 1e4, 6000).round(1))
    groups = ["big"] * 5990 + ["small"] * 7 + ["one"] + [None] * 2
    data = [(g, float(v)) for g, v in zip(groups, values)] + [("small", None)]
    df = spark.createDataFrame(data, "g string, v double")
    p = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = rows(exact_quantiles(df, "v", p, "g"), "g")
    for g in ("big", "small", "one", None):
        own = [v for h, v in data if h == g and v is not None]
        assert np.allclose(found[g]["quantiles"], np.quantile(own, p), rtol=1e-12)
    whole = exact_quantiles(df, "v", p).first().quantiles
    assert np.allclose(whole, np.quantile(values, p), rtol=1e-12)


def test_median_keeps_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), (None, 5.0), ("b", None)], "g string, m double"
    )
    assert {r.g: r.m for r in explore.adhoc(df, "g", "m", "median").collect()} == {
        "a": 1.5, None: 5.0, "b": None,
    }


def test_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([("a", None)], "g string, m double")
    assert explore.adhoc(df, "g", "m", "sum").first().m == 0.0


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 7.0, 5.0)],
        "a double, b double, c double",
    )
    found = {(r.metric_a, r.metric_b): r.correlation for r in explore.correlations(df).collect()}
    assert len(found) == 9
    expected = np.corrcoef([1, 2, 4], [2, 4, 7])[0, 1]
    assert math.isclose(found["a", "b"], expected) and math.isclose(found["b", "a"], expected)
    assert found["c", "c"] is None and found["a", "c"] is None


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    assert [r.rows for r in explore.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.rows for r in explore.histogram(flat, "v", 2).orderBy("bin").collect()] == [2, 0]


def test_outliers(spark):
    df = spark.createDataFrame(
        [("a", float(v)) for v in range(10)] + [("a", 100.0), ("b", 1.0)], "g string, v double"
    )
    assert [r.v for r in explore.outliers(df, "v", "g").collect()] == [100.0]
    box = rows(explore.whiskers(df, "v", "g"), "g")
    assert box["a"]["upper_whisker"] == 9.0


def test_ranked_breakdown_world_and_hidden_values(country, spark):
    world = spark.createDataFrame([("World", 9.0)], "place string, total_confirmed double")
    open_rows = explore.ranked_breakdown(country, world=world).collect()
    assert [r.total_recovered for r in open_rows] == [None, None, 50.0, 40.0, None]
    found = explore.ranked_breakdown(
        country, world=world, recovered_not_shown=("India", "Japan")
    ).collect()
    assert [(r.position, r.place) for r in found] == [
        (0, "World"), (1, "France"), (2, "India"), (3, "Japan"), (4, "XX"),
    ]
    assert [r.total_recovered for r in found] == [None] * 5


def test_ranked_breakdown_of_a_continent(country):
    found = explore.ranked_breakdown(country, "Asia").collect()
    assert [r.place for r in found] == ["Asia Total", "India", "Japan"]
    assert found[0].total_confirmed == 200.0 and found[0].population == 30


def test_searches(country):
    assert explore.search_places(country, "^IN").count() == 1
    assert explore.search_places(country, "[ij]").count() == 2
    assert explore.search_anywhere(country, "[ij]").count() == 0
    assert explore.search_anywhere(country, "RAN").count() == 1
    assert explore.search_anywhere(country, "").count() == 4


def test_sort_puts_nulls_last_both_ways(country):
    for descending in (True, False):
        rates = [
            r.case_fatality_rate
            for r in explore.sort_rows(country, "case_fatality_rate", descending).collect()
        ]
        assert rates[-1] is None


def test_top_leaves_nulls_out_and_breaks_ties(country):
    assert [r.location_key for r in explore.top(country, "total_confirmed", 2).collect()] == ["FR", "IN"]
    assert explore.top(country, "case_fatality_rate", 10).count() == 3


def test_thresholds_count_null_as_zero(country):
    assert explore.at_least(country, {"population": 0}).count() == 4
    assert explore.at_least(country, {"population": 1, "absent": 5}).count() == 2


def test_compare_scales_to_the_choice(country):
    found = rows(
        explore.compare(country, ["India", "France"], ["total_confirmed", "case_fatality_rate"]),
        "location_key",
    )
    assert found["IN"]["total_confirmed"] == pytest.approx(100 / 3)
    assert found["IN"]["case_fatality_rate"] is None


def test_kpis_prefer_world_then_countries_then_default(country, spark):
    world = spark.createDataFrame(
        [(None, 12.0, 3)],
        "total_cases double, total_deaths double, countries_reporting long",
    )
    daily = spark.createDataFrame([(dt.date(2021, 1, 1),)], "date date")
    row = explore.kpis(world, country, daily, {"active_cases": 5.0}).first()
    assert row.total_cases == 550.0
    assert row.total_deaths == 12.0
    assert row.countries_regions == 3
    assert row.active_cases == 5.0
    assert row.latest_data_date == dt.date(2021, 1, 1)


def test_override_writes_nulls(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    right = spark.createDataFrame([("a", None)], "k string, v double")
    assert {r.k: r.v for r in lookups.override_merge(left, right, "k").collect()} == {
        "a": None, "b": 2.0,
    }


def test_coalescing_merge_keeps_left(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    right = spark.createDataFrame(
        [("a", 9.0, "x"), ("b", 8.0, "y"), ("b", 8.0, "y")], "k string, v double, w string"
    )
    found = {r.k: (r.v, r.w) for r in lookups.coalescing_merge(left, right, "k", ["v", "w"]).collect()}
    assert found == {"a": (1.0, "x"), "b": (8.0, "y")}


def test_unknown_continent_is_other(spark):
    df = spark.createDataFrame([("NZ",), ("ST",), ("??",)], "location_key string")
    found = {r.location_key: r.continent for r in lookups.with_continent(df).collect()}
    assert found == {"NZ": "Oceania", "ST": "Other", "??": "Other"}
    wider = lookups.continent_table(spark)
    found = {r.location_key: r.continent for r in lookups.with_continent(df, wider).collect()}
    assert found["ST"] == "Africa"


def test_map_names(spark):
    df = spark.createDataFrame([("Türkiye",), ("Peru",), (None,)], "country_name string")
    assert {r.map_country_name for r in lookups.with_map_names(df).collect()} == {"Turkey", "Peru"}


def test_each_continent_code_once_and_known(spark):
    kept = {r.location_key: r.continent for r in lookups.continent_table(spark).collect()}
    assert kept == lookups.CONTINENTS
    for code, continent in {"MO": "Asia", "XK": "Europe", "GI": "Europe", "JE": "Europe",
                            "GG": "Europe", "IM": "Europe", "GF": "South America"}.items():
        assert kept[code] == continent
    assert set(lookups.ONLY_ESTIMATED) <= set(kept)


def test_key_figures_of_all_null_columns_are_zero(spark):
    country = spark.createDataFrame(
        [("A", None)], "location_key string, total_confirmed double"
    )
    assert explore.kpis(None, country, None).first().total_cases == 0.0


def test_quantiles_of_mostly_equal_values_and_nan(spark):
    rows = [(0.0,)] * 999 + [(float(k),) for k in range(1, 1000)]
    df = spark.createDataFrame(rows, "v double")
    found = explore.quartiles(df, "v").first()
    ordered = sorted(v for (v,) in rows)
    assert found.q1 == 0.0 and found.median == 0.5
    at = 0.75 * (len(ordered) - 1)
    low = ordered[int(at)]
    assert found.q3 == low + (ordered[int(at) + 1] - low) * (at - int(at))
    text = spark.createDataFrame([("1",), ("NaN",), ("3",)], "v string")
    from epiledger.functions.metrics import number
    numbers = text.select(number("v").alias("v"))
    assert explore.quartiles(numbers, "v").first().median == 2.0
