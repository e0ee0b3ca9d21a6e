import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

INDEX_DDL = (
    "location_key string, country_name string, country_code string, "
    "subregion1_name string, aggregation_level string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def index(spark):
    return spark.createDataFrame(
        [
            ("IN", "India", "IN", None, "0"),
            ("US", "United States", "US", None, "0"),
            ("BR", "Brazil", "BR", None, "0"),
            ("US_CA", "United States", "US", "California", "1"),
            ("US_CA_06", "United States", "US", "California", "2"),
            ("IN_MH", "India", "IN", "Maharashtra", "1"),
        ],
        INDEX_DDL,
    )


@pytest.fixture
def cases(spark):
    """Text rows as a CSV scan gives them: two days of three countries and oddities."""
    return spark.createDataFrame(
        [
            ("2021-01-01", "IN", "15000", "200", "12000", "1000000", "15000", "900000"),
            ("2021-01-02", "IN", "16000", "210", "13000", "1016000", "15210", "913000"),
            ("2021-01-01", "US", "250000", "3000", "200000", "20000000", "350000", None),
            ("2021-01-02", "US", "260000", "3100", "210000", "20260000", "353100", "0"),
            ("2021-01-01", "BR", "-50", "abc", None, "5000000", "100000", "9000000"),
            ("2021-13-45", "BR", "7", "1", "1", "10", "1", "1"),
            ("2021-14-45", "BR", "7", "1", "1", "10", "1", "1"),
            ("2021-01-03", "US", None, "9", "9", None, "9", "9"),
            (None, "US", "1", "1", "1", "1", "1", "1"),
            ("2021-01-01", None, "1", "1", "1", "1", "1", "1"),
            ("2021-01-01", "ZZ", "40", "4", "4", "40", "4", "4"),
            ("2021-01-01", "US_CA", "100", "10", "5", "1000", "100", "50"),
            ("2021-01-01", "US_CA_06", "30", "3", "1", "300", "30", "10"),
            ("2021-01-01", "IN_MH", "20", "2", "1", "200", "20", "10"),
            ("2021-01-01", "QQ_X", "5", "1", "0", "50", "5", "0"),
        ],
        "date string, location_key string, new_confirmed string, new_deceased string, "
        "new_recovered string, cumulative_confirmed string, cumulative_deceased string, "
        "cumulative_recovered string",
    )


@pytest.fixture
def vaccinations(spark):
    return spark.createDataFrame(
        [
            ("2021-01-01", "IN", "5000", "100000", "6000", "120000"),
            ("2021-01-02", "IN", "5500", "105500", "0", "126000"),
            ("2021-01-02", "US", "55000", "1055000", "60000", "1100000"),
            ("2021-01-01", "US_CA", "50", "500", "60", "600"),
        ],
        "date string, location_key string, new_persons_vaccinated string, "
        "cumulative_persons_vaccinated string, new_vaccine_doses_administered string, "
        "cumulative_vaccine_doses_administered string",
    )


@pytest.fixture
def hospitalizations(spark):
    return spark.createDataFrame(
        [
            ("2021-01-01", "IN", "800", "8000"),
            ("2021-01-02", "IN", "825", "8100"),
            ("2021-01-01", "US", "-4", "1"),
        ],
        "date string, location_key string, new_hospitalized_patients string, "
        "current_hospitalized_patients string",
    )


@pytest.fixture
def demographics(spark):
    return spark.createDataFrame(
        [("IN", "1400000.0"), ("US", "0"), ("US", "0"), ("BR", "n/a")],
        "location_key string, population string",
    )


def rows(df, *keys):
    """Rows as dicts, by the given key columns."""
    return {
        tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict()
        for r in df.collect()
    }
