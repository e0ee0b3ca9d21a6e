"""Every registered query against its SQL twin."""

from pathlib import Path

import pytest

from verification.compare import connect, differences
from verification.oracles import ORACLES
from verification.queries import QUERIES

SMALL, FULL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# Its twin names the months that occur at the larger scale.
AT_FULL = {"country_month_pivot"}

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connections():
    return {d: connect(d) for d in (SMALL, FULL)}


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_twin(spark, connections, name):
    folder = FULL if name in AT_FULL else SMALL
    assert differences(spark, connections[folder], folder, name) is None


@pytest.mark.parametrize(
    "name",
    [
        "country_frame_rows", "global_metrics", "kpis", "ranked_breakdown",
        "normalized_comparison", "metric_histogram", "metric_quartiles", "metric_outliers",
        "resample_weekly", "monthly_top_countries",
    ],
)
def test_plans_hold_without_broadcasts(spark, name):
    """No nested loop, cartesian product or Python even when nothing may be broadcast."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    for word in ("CartesianProduct", "NestedLoop", "Python"):
        assert word not in plan
