"""The driver's test tables read as daily reports.

Orders become case reports, line items vaccinations and admissions, nations and
customers the dimensions.  Locations and metrics are read off each fact row
itself, so the adapter adds no join and no window.  Keys give two-character
countries, first-level (``03_URGENT``) and second-level (``03_URGENT_F``) regions;
nulls, negatives, repeated reports and unmatched keys all occur.  No row is left out:
dimension rows that are to match nothing get a key of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGION_CODES = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]
STATUSES = ["F", "O", "P"]

# Declared, so that opening a table starts no job to infer its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


@dataclass(frozen=True)
class Sources:
    cases: DataFrame
    vaccinations: DataFrame
    hospitalizations: DataFrame
    index: DataFrame
    demographics: DataFrame
    continents: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place_key(number: str) -> str:
    """At least two digits, and more where the number has more."""
    text = f"cast({number} AS string)"
    return f"lpad({text}, greatest(2, length({text})), '0')"


def _country(number: str) -> str:
    """Customers and suppliers report from 25 places."""
    return place_key(f"({number} % 25)")


def _day(date: str) -> str:
    return f"datediff(cast({date} AS date), DATE'1992-01-01')"


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    country, day = _country("o_custkey"), _day("o_orderdate")
    region = f"concat({country}, '_', substr(o_orderpriority, 3))"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS src_id",
        "cast(o_orderdate AS date) AS date",
        f"""CASE WHEN o_orderkey % 97 = 0 THEN null
                 WHEN o_orderkey % 2 = 0 THEN {country}
                 WHEN o_orderkey % 7 = 3 THEN concat({region}, '_', o_orderstatus)
                 ELSE {region} END AS location_key""",
        """CASE WHEN o_orderkey % 17 <> 0 THEN cast(o_orderkey % 1000 - 50 AS double) END
           AS new_confirmed""",
        """CASE WHEN o_orderstatus = 'F' THEN cast(o_orderkey % 20 AS double) ELSE 0D END
           AS new_deceased""",
        """CASE WHEN o_orderstatus = 'P' THEN cast(o_orderkey % 300 AS double) END
           AS new_recovered""",
        f"""CASE WHEN o_orderkey % 34 <> 0 THEN cast({day} * 40 + o_orderkey % 40 AS double)
            END AS cumulative_confirmed""",
        f"cast({day} * 2 + o_orderkey % 2 AS double) AS cumulative_deceased",
        f"""CASE WHEN o_orderkey % 11 = 0 THEN cast({day} * 60 AS double)
                 WHEN o_orderkey % 13 <> 0 THEN cast({day} * 10 + o_orderkey % 10 AS double)
            END AS cumulative_recovered""",
    )


def _deliveries(spark: SparkSession, sf_dir: str, *metrics: str) -> DataFrame:
    country = _country("l_suppkey")
    codes = ", ".join(f"'{c}'" for c in REGION_CODES)
    region = f"element_at(array({codes}), cast(l_partkey % 5 + 1 AS int))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_shipdate AS date) AS date",
        f"""CASE WHEN l_orderkey % 2 = 0 THEN {country}
                 ELSE concat({country}, '_', {region}) END AS location_key""",
        *metrics,
    )


def vaccinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _deliveries(spark, sf_dir, "l_linenumber", "l_quantity")
        .groupBy("date", "location_key")
        .agg(
            F.sum("l_linenumber").alias("people"),
            F.sum("l_quantity").alias("new_vaccine_doses_administered"),
        )
        .selectExpr(
            "date",
            "location_key",
            "cast(people AS double) AS new_persons_vaccinated",
            "new_vaccine_doses_administered",
            f"cast({_day('date')} * 30 AS double) AS cumulative_persons_vaccinated",
            f"cast({_day('date')} * 200 AS double) AS cumulative_vaccine_doses_administered",
        )
    )


def hospitalizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _deliveries(
            spark,
            sf_dir,
            "CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned",
            "CASE WHEN l_linestatus = 'O' THEN l_quantity END AS open",
        )
        .groupBy("date", "location_key")
        .agg(
            F.sum("returned").alias("new_hospitalized_patients"),
            F.sum("open").alias("current_hospitalized_patients"),
        )
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their first- and second-level regions; facts of place 24 find none."""
    regions = [f"_{code}" for code in REGION_CODES]
    deeper = [f"{region}_{status}" for region in regions for status in STATUSES]
    suffixes = ", ".join(f"'{s}'" for s in ["", *regions, *deeper])
    return (
        table(spark, sf_dir, "nation")
        .selectExpr(
            "n_name",
            f"CASE WHEN n_nationkey = 24 THEN 'ZZ' ELSE {place_key('n_nationkey')} END"
            " AS country_code",
            f"explode(array({suffixes})) AS suffix",
        )
        .selectExpr(
            "concat(country_code, suffix) AS location_key",
            "n_name AS country_name",
            "country_code",
            "CASE WHEN suffix <> '' THEN concat(n_name, ' ', split_part(suffix, '_', 2)) END"
            " AS subregion1_name",
            "size(split(suffix, '_')) - 1 AS aggregation_level",
        )
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population from customer counts; zero for nation 3, elsewhere for nation 5."""
    return (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("people"))
        .selectExpr(
            f"CASE WHEN c_nationkey = 5 THEN 'ZY' ELSE {place_key('c_nationkey')} END"
            " AS location_key",
            "CASE WHEN c_nationkey = 3 THEN 0 ELSE people * 100000 END AS population",
        )
    )


def continents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region names by nation; place 7 finds none."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        f"CASE WHEN n_nationkey = 7 THEN 'ZX' ELSE {place_key('n_nationkey')} END"
        " AS location_key",
        "r_name AS continent",
    )


def load(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        cases=cases(spark, sf_dir),
        vaccinations=vaccinations(spark, sf_dir),
        hospitalizations=hospitalizations(spark, sf_dir),
        index=index(spark, sf_dir),
        demographics=demographics(spark, sf_dir),
        continents=continents(spark, sf_dir),
    )
