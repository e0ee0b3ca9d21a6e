"""SQL twins of the registered queries, over the driver's tables.

Shared relations are named pieces; a twin names the pieces it needs and gets
them, with what they depend on, as common table expressions.
"""

from __future__ import annotations

import re

COUNTRIES = "('NATION_1', 'NATION_2', 'NATION_3', 'NATION_8')"
CODES = "['URGENT', 'HIGH', 'MEDIUM', 'NOT SPECIFIED', 'LOW']"
MONTHS = [f"{y}-{m:02d}-01" for y in range(1995, 2002) for m in range(1, 13)][:79]

CLEANED = [
    "new_confirmed", "new_deceased", "new_recovered",
    "cumulative_confirmed", "cumulative_deceased",
    "new_persons_vaccinated", "cumulative_persons_vaccinated",
    "new_vaccine_doses_administered", "cumulative_vaccine_doses_administered",
    "new_hospitalized_patients",
]
CASES = CLEANED[:5]
VACCINES = CLEANED[5:9]


def _key(number):
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(2, length({text})) AS INTEGER), '0')"


def _clean(columns, table=""):
    dot = f"{table}." if table else ""
    return ", ".join(
        f"coalesce(CASE WHEN {dot}{c} < 0 THEN 0.0 ELSE {dot}{c} END, 0.0) AS {c}"
        for c in columns
    )


def _frame(level, joins, columns, extra="", where=""):
    return f"""
      SELECT e.date, e.location_key, i.country_name, {_clean(columns)},
             cumulative_recovered {extra}
      FROM (SELECT *, row_number() OVER (PARTITION BY date, location_key ORDER BY src_id) AS rn
            FROM cases
            WHERE {level} AND date IS NOT NULL
              AND (new_confirmed IS NOT NULL OR cumulative_confirmed IS NOT NULL)) e
      LEFT JOIN idx i ON i.location_key = e.location_key
      {joins}
      WHERE rn = 1 {where}"""


_VACC = "LEFT JOIN vacc v ON v.date = e.date AND v.location_key = e.location_key"
_HOSP = "LEFT JOIN hosp h ON h.date = e.date AND h.location_key = e.location_key"
_PARENT = "LEFT JOIN idx p ON p.location_key = split_part(e.location_key, '_', 1)"
_PARENT_COLUMNS = (
    ", split_part(e.location_key, '_', 1) AS country_code, p.country_name AS parent_country"
)
_COUNTRY = "length(location_key) = 2"
_REGIONAL = "length(location_key) > 2"
_ACTIVE = (
    "greatest(coalesce(cumulative_confirmed, 0.0) - coalesce(cumulative_deceased, 0.0)"
    " - coalesce(cumulative_recovered, 0.0), 0.0)"
)
_CFR = (
    "round(total_deceased / CASE WHEN total_confirmed > 0 THEN total_confirmed ELSE 1 END"
    " * 100, 4)"
)
_PER_MILLION = (
    "CASE WHEN population > 0 THEN round({0} / (population / 1000000), 2) END"
)
_WEEK = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_SO_FAR = "OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_SERIES = [
    ("new_confirmed", "confirmed"), ("new_deceased", "deceased"),
    ("new_recovered", "recovered"), ("new_persons_vaccinated", "vaccinated"),
    ("new_vaccine_doses_administered", "vaccine_doses_administered"),
]
_GLOBAL = [f"global_new_{s}" for _, s in _SERIES]

PIECES = {
    "cases": f"""
      SELECT o_orderkey AS src_id, CAST(o_orderdate AS DATE) AS date,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL
             WHEN o_orderkey % 2 = 0 THEN {_key('o_custkey % 25')}
             WHEN o_orderkey % 7 = 3 THEN {_key('o_custkey % 25')}
               || '_' || substr(o_orderpriority, 3) || '_' || o_orderstatus
             ELSE {_key('o_custkey % 25')}
               || '_' || substr(o_orderpriority, 3) END AS location_key,
        CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 1000 - 50 AS DOUBLE) END
          AS new_confirmed,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 20 AS DOUBLE)
             ELSE CAST(0 AS DOUBLE) END AS new_deceased,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey % 300 AS DOUBLE) END
          AS new_recovered,
        CASE WHEN o_orderkey % 34 <> 0 THEN CAST(d * 40 + o_orderkey % 40 AS DOUBLE) END
          AS cumulative_confirmed,
        CAST(d * 2 + o_orderkey % 2 AS DOUBLE) AS cumulative_deceased,
        CASE WHEN o_orderkey % 11 = 0 THEN CAST(d * 60 AS DOUBLE)
             WHEN o_orderkey % 13 <> 0 THEN CAST(d * 10 + o_orderkey % 10 AS DOUBLE) END
          AS cumulative_recovered
      FROM (SELECT *, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS d
            FROM orders)""",
    "deliveries": f"""
      SELECT *, CAST(l_shipdate AS DATE) AS date,
        {_key('l_suppkey % 25')}
          || CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE '_' ||
             CASE l_partkey % 5 WHEN 0 THEN 'URGENT' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM'
                                WHEN 3 THEN 'NOT SPECIFIED' ELSE 'LOW' END END AS location_key
      FROM lineitem""",
    "vacc": """
      SELECT date, location_key, CAST(sum(l_linenumber) AS DOUBLE) AS new_persons_vaccinated,
        sum(l_quantity) AS new_vaccine_doses_administered,
        CAST(date_diff('day', DATE '1992-01-01', date) * 30 AS DOUBLE)
          AS cumulative_persons_vaccinated,
        CAST(date_diff('day', DATE '1992-01-01', date) * 200 AS DOUBLE)
          AS cumulative_vaccine_doses_administered
      FROM deliveries GROUP BY date, location_key""",
    "hosp": """
      SELECT date, location_key,
        sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS new_hospitalized_patients,
        sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS current_hospitalized_patients
      FROM deliveries GROUP BY date, location_key""",
    "idx": f"""
      SELECT CASE WHEN n_nationkey = 24 THEN 'ZZ' ELSE {_key('n_nationkey')} END || s.suffix AS location_key,
        n_name AS country_name,
        CASE WHEN n_nationkey = 24 THEN 'ZZ' ELSE {_key('n_nationkey')} END AS country_code,
        CASE WHEN s.level > 0 THEN n_name || ' ' || split_part(s.suffix, '_', 2) END
          AS subregion1_name,
        CAST(s.level AS INTEGER) AS aggregation_level
      FROM nation, (
        SELECT '' AS suffix, 0 AS level
        UNION ALL SELECT '_' || c, 1 FROM (SELECT unnest({CODES}) AS c)
        UNION ALL SELECT '_' || c || '_' || t, 2
          FROM (SELECT unnest({CODES}) AS c), (SELECT unnest(['F', 'O', 'P']) AS t)) s""",
    "demo": f"""
      SELECT CASE WHEN c_nationkey = 5 THEN 'ZY' ELSE {_key('c_nationkey')} END AS location_key,
        CAST(CASE WHEN c_nationkey = 3 THEN 0 ELSE count(*) * 100000 END AS BIGINT)
          AS population
      FROM customer GROUP BY c_nationkey""",
    "cont": f"""
      SELECT CASE WHEN n_nationkey = 7 THEN 'ZX' ELSE {_key('n_nationkey')} END AS location_key, r_name AS continent
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "overrides": f"""
      SELECT {_key('n_nationkey')} AS location_key,
        'Republic ' || n_name AS country_name,
        CAST(n_nationkey * 1000 + 5 AS DOUBLE) AS total_confirmed,
        CAST(n_nationkey * 10 AS DOUBLE) AS total_deceased,
        CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey * 500 AS DOUBLE) END
          AS total_recovered,
        CAST(n_nationkey AS DOUBLE) * 1000000 AS population
      FROM nation WHERE n_regionkey = 1""",
    "increments": """
      SELECT date, location_key,
        greatest(coalesce(new_confirmed, 0.0), 0.0) AS new_confirmed,
        greatest(coalesce(new_deceased, 0.0), 0.0) AS new_deceased,
        greatest(coalesce(new_recovered, 0.0), 0.0) AS new_recovered,
        coalesce(cumulative_confirmed, 0.0) AS cumulative_confirmed,
        coalesce(cumulative_deceased, 0.0) AS cumulative_deceased,
        coalesce(cumulative_recovered, 0.0) AS cumulative_recovered
      FROM cases""",
    "country": _frame(
        _COUNTRY, f"{_VACC} {_HOSP}", CLEANED, ", current_hospitalized_patients"
    ),
    "regional": _frame(
        _REGIONAL, f"{_VACC} {_PARENT}", CASES + VACCINES, _PARENT_COLUMNS
    ),
    "latest_open": f"""
      SELECT location_key, active FROM (
        SELECT location_key, {_ACTIVE} AS active,
          row_number() OVER (PARTITION BY location_key ORDER BY date DESC) AS rn
        FROM country) WHERE rn = 1""",
    "totals": """
      SELECT country_name, location_key, sum(new_confirmed) AS total_confirmed,
        sum(new_deceased) AS total_deceased, sum(new_recovered) AS total_recovered,
        sum(new_persons_vaccinated) AS total_people_vaccinated,
        sum(new_vaccine_doses_administered) AS total_vaccine_doses_administered,
        max(cumulative_vaccine_doses_administered) AS cumulative_vaccine_doses_administered,
        max(cumulative_confirmed) AS peak_cumulative_confirmed,
        max(cumulative_deceased) AS peak_cumulative_deceased,
        max(new_confirmed) AS peak_daily_confirmed, count(date) AS days_reported
      FROM country WHERE country_name IS NOT NULL GROUP BY country_name, location_key""",
    "country_sum": f"""
      SELECT t.*, l.active AS active_cases, {_CFR} AS case_fatality_rate, population,
        {_PER_MILLION.format('total_confirmed')} AS cases_per_million,
        {_PER_MILLION.format('total_deceased')} AS deaths_per_million,
        total_people_vaccinated AS total_vaccinated
      FROM totals t LEFT JOIN latest_open l ON l.location_key = t.location_key
      LEFT JOIN demo d ON d.location_key = t.location_key""",
    "daily_sums": f"""
      SELECT date, {', '.join(f'sum({c}) AS global_new_{s}' for c, s in _SERIES)}
      FROM country GROUP BY date""",
    "daily": f"""
      SELECT *, {', '.join(f'sum(global_new_{s}) {_SO_FAR} AS cumulative_global_{s}'
                           for _, s in _SERIES)},
        round(avg(global_new_confirmed) {_WEEK}, 0) AS rolling_avg_confirmed_7d,
        round(avg(global_new_deceased) {_WEEK}, 0) AS rolling_avg_deceased_7d,
        round(avg(global_new_confirmed) {_WEEK}, 0) AS rolling_avg_7d,
        round(avg(global_new_deceased) {_WEEK}, 0) AS rolling_avg_deaths_7d
      FROM daily_sums""",
    "country_daily": """
      SELECT country_name, location_key, date, sum(new_confirmed) AS new_confirmed,
        sum(new_deceased) AS new_deceased, sum(new_recovered) AS new_recovered,
        sum(new_persons_vaccinated) AS new_persons_vaccinated,
        sum(new_vaccine_doses_administered) AS new_vaccine_doses_administered,
        max(cumulative_confirmed) AS cumulative_confirmed,
        max(cumulative_deceased) AS cumulative_deceased,
        max(cumulative_recovered) AS cumulative_recovered,
        max(cumulative_persons_vaccinated) AS cumulative_persons_vaccinated,
        max(cumulative_vaccine_doses_administered) AS cumulative_vaccine_doses_administered
      FROM country WHERE country_name IS NOT NULL GROUP BY country_name, location_key, date""",
    "vaccination": """
      SELECT country_name, location_key, sum(new_persons_vaccinated) AS total_people_vaccinated,
        max(cumulative_persons_vaccinated) AS cumulative_people_vaccinated,
        max(new_persons_vaccinated) AS peak_daily_people_vaccinated,
        count(CASE WHEN new_persons_vaccinated > 0 THEN 1 END) AS vaccination_days,
        sum(new_vaccine_doses_administered) AS total_vaccine_doses_administered,
        max(cumulative_vaccine_doses_administered) AS cumulative_vaccine_doses_administered,
        max(new_vaccine_doses_administered) AS peak_daily_vaccine_doses_administered,
        sum(new_persons_vaccinated) AS total_vaccinated
      FROM country WHERE country_name IS NOT NULL GROUP BY country_name, location_key""",
    "hospitalization": """
      SELECT country_name, location_key, sum(new_hospitalized_patients) AS total_hospitalized,
        max(new_hospitalized_patients) AS peak_hospitalized,
        round(avg(new_hospitalized_patients), 2) AS avg_daily_hospitalized
      FROM country WHERE new_hospitalized_patients > 0 AND country_name IS NOT NULL
      GROUP BY country_name, location_key""",
    "regional_sum": """
      SELECT location_key, coalesce(country_name, location_key) AS region_name,
        country_code, parent_country, sum(new_confirmed) AS total_confirmed,
        sum(new_deceased) AS total_deceased, sum(new_recovered) AS total_recovered,
        count(date) AS days_reported,
        sum(new_persons_vaccinated) AS total_people_vaccinated,
        sum(new_vaccine_doses_administered) AS total_vaccine_doses_administered
      FROM regional GROUP BY ALL""",
    "world": f"""
      SELECT sum(new_confirmed) AS total_cases, sum(new_deceased) AS total_deaths,
        sum(new_recovered) AS total_recoveries,
        count(DISTINCT location_key) AS countries_reporting,
        sum(new_persons_vaccinated) AS total_people_vaccinated,
        sum(new_vaccine_doses_administered) AS total_vaccine_doses_administered,
        max(date) AS latest_data_date,
        (SELECT sum(active) FROM latest_open) AS active_cases_worldwide
      FROM country""",
    "raw": f"""
      SELECT e.date, e.location_key, i.country_name, e.new_confirmed, e.new_deceased,
        e.cumulative_confirmed, v.new_persons_vaccinated, v.cumulative_persons_vaccinated,
        h.new_hospitalized_patients
      FROM cases e LEFT JOIN idx i ON i.location_key = e.location_key {_VACC} {_HOSP}
      WHERE length(e.location_key) = 2
        AND (e.new_confirmed IS NOT NULL OR e.cumulative_confirmed IS NOT NULL)""",
    "vacc_totals": """
      SELECT v.location_key, coalesce(sum(new_persons_vaccinated), 0.0)
          AS new_persons_vaccinated,
        max(cumulative_persons_vaccinated) AS cumulative_persons_vaccinated,
        coalesce(sum(new_vaccine_doses_administered), 0.0) AS new_vaccine_doses_administered,
        max(cumulative_vaccine_doses_administered) AS cumulative_vaccine_doses_administered,
        count(date) AS vaccination_days
      FROM vacc v WHERE length(location_key) = 2 GROUP BY v.location_key""",
    "estimated_base": """
      SELECT e.location_key, sum(new_confirmed) AS total_confirmed,
        sum(new_deceased) AS total_deceased, sum(new_recovered) AS total_recovered,
        max(cumulative_confirmed) AS peak_cumulative,
        max(cumulative_deceased) AS cumulative_deceased,
        max(cumulative_recovered) AS cumulative_recovered, count(date) AS days_reported
      FROM increments e WHERE length(e.location_key) = 2 GROUP BY e.location_key""",
    "estimated": """
      SELECT b.location_key,
        CASE WHEN o.location_key IS NOT NULL THEN o.country_name ELSE i.country_name END
          AS country_name,
        coalesce(c.continent, 'Other') AS continent,
        CASE WHEN o.location_key IS NOT NULL THEN o.total_confirmed ELSE b.total_confirmed END
          AS total_confirmed,
        CASE WHEN o.location_key IS NOT NULL THEN o.total_deceased ELSE b.total_deceased END
          AS total_deceased,
        CASE WHEN o.location_key IS NOT NULL THEN o.total_recovered ELSE b.total_recovered END
          AS total_recovered,
        CASE WHEN o.location_key IS NOT NULL THEN o.population
             ELSE coalesce(CAST(d.population AS DOUBLE), 0.0) END AS population,
        peak_cumulative, cumulative_deceased, cumulative_recovered, days_reported,
        coalesce(v.new_persons_vaccinated, 0.0) AS total_vaccinated,
        coalesce(v.new_persons_vaccinated, 0.0) AS new_persons_vaccinated,
        coalesce(v.new_vaccine_doses_administered, 0.0) AS new_vaccine_doses_administered,
        coalesce(v.new_persons_vaccinated, 0.0) AS total_people_vaccinated,
        coalesce(v.new_vaccine_doses_administered, 0.0) AS total_vaccine_doses_administered
      FROM estimated_base b
      JOIN idx i ON i.location_key = b.location_key AND i.aggregation_level = 0
      LEFT JOIN cont c ON c.location_key = b.location_key
      LEFT JOIN vacc_totals v ON v.location_key = b.location_key
      LEFT JOIN demo d ON d.location_key = b.location_key
      LEFT JOIN overrides o ON o.location_key = b.location_key""",
    "by_continent": """
      SELECT s.*, coalesce(c.continent, 'Other') AS continent
      FROM country_sum s LEFT JOIN cont c ON c.location_key = s.location_key""",
    "monthly": """
      SELECT country_name, CAST(date_trunc('month', date) AS DATE) AS month,
        sum(new_confirmed) AS new_confirmed
      FROM country_daily WHERE date IS NOT NULL GROUP BY 1, 2""",
    "month_ranks": """
      SELECT country_name, row_number() OVER (
        ORDER BY coalesce(sum(new_confirmed), 0.0) DESC, country_name) AS rn
      FROM monthly GROUP BY country_name""",
    "shown": """
      SELECT continent, row_number() OVER (ORDER BY total_confirmed DESC, location_key)
          AS all_position, location_key,
        coalesce(country_name, location_key) AS place, total_confirmed, total_deceased,
        CASE WHEN total_recovered > 0 THEN total_recovered END AS total_recovered,
        CASE WHEN cases_per_million > 0 THEN cases_per_million END AS cases_per_million,
        CASE WHEN deaths_per_million > 0 THEN deaths_per_million END AS deaths_per_million,
        CASE WHEN population > 0 THEN population END AS population
      FROM by_continent""",
    "continent_rows": """
      SELECT continent, sum(total_confirmed) AS total_confirmed,
        sum(total_deceased) AS total_deceased, sum(total_recovered) AS total_recovered,
        CAST(coalesce(sum(population), 0) AS BIGINT) AS population
      FROM by_continent GROUP BY continent""",
    "continent_sums": """
      SELECT *, CASE WHEN population > 0 THEN total_confirmed / (population / 1000000) END
          AS cases_per_million,
        CASE WHEN population > 0 THEN total_deceased / (population / 1000000) END
          AS deaths_per_million
      FROM continent_rows""",
    "doses_box": """
      SELECT location_key,
        quantile_cont(new_vaccine_doses_administered, 0.25) AS q1,
        quantile_cont(new_vaccine_doses_administered, 0.5) AS median,
        quantile_cont(new_vaccine_doses_administered, 0.75) AS q3
      FROM vacc GROUP BY location_key""",
}


def _twin(body: str) -> str:
    """The body with the pieces it names, and theirs, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", todo.pop()))
        for name in words & PIECES.keys() - needed:
            needed.add(name)
            todo.append(PIECES[name])
    pieces = [f"{n} AS ({PIECES[n]})" for n in PIECES if n in needed]
    return (f"WITH {', '.join(pieces)} " if pieces else "") + body


_POPULATION = """
  SELECT country_name, location_key, {columns},
    greatest(coalesce(cumulative_confirmed, 0.0) - coalesce(cumulative_deceased, 0.0)
      - coalesce(cumulative_recovered, 0.0), 0.0) AS active_cases,
    population,
    total_confirmed / (CASE WHEN population <> 0 THEN population END / 1000000)
      AS cases_per_million,
    total_deceased / (CASE WHEN population <> 0 THEN population END / 1000000)
      AS deaths_per_million,
    total_vaccine_doses_administered / (CASE WHEN population <> 0 THEN population END / 100)
      AS vaccinations_per_hundred
  FROM (
    SELECT country_name, c.location_key, {sums}, {lasts}, any_value(population) AS population
    FROM country_daily c LEFT JOIN demo d ON d.location_key = c.location_key
    {where} GROUP BY country_name, c.location_key) {having}"""
_TOTALS = {
    "new_confirmed": "total_confirmed", "new_deceased": "total_deceased",
    "new_recovered": "total_recovered", "new_persons_vaccinated": "total_people_vaccinated",
    "new_vaccine_doses_administered": "total_vaccine_doses_administered",
}
_LASTS = [
    "cumulative_confirmed", "cumulative_deceased", "cumulative_recovered",
    "cumulative_persons_vaccinated", "cumulative_vaccine_doses_administered",
]


def _period(where="", having=""):
    return _POPULATION.format(
        columns=", ".join([*_TOTALS.values(), *_LASTS]),
        sums=", ".join(f"coalesce(sum({c}), 0.0) AS {t}" for c, t in _TOTALS.items()),
        lasts=", ".join(f"arg_max_null({c}, date) AS {c}" for c in _LASTS),
        where=where,
        having=having,
    )


def _selected(where=""):
    sums = ", ".join(f"sum({c}) AS global_new_{s}" for c, s in _SERIES)
    return f"""SELECT date, {sums} FROM country_daily
      WHERE country_name IN {COUNTRIES} AND date IS NOT NULL {where} GROUP BY date"""


_LABELS = {
    "day": ("date", "INTERVAL 1 DAY"),
    "week": ("CAST(date_trunc('week', date) AS DATE) + 6", "INTERVAL 7 DAY"),
    "month": ("CAST(date_trunc('month', date) AS DATE)", "INTERVAL 1 MONTH"),
}


def _resampled(unit, source="daily"):
    label, step = _LABELS[unit]
    sums = ", ".join(f"sum({g}) AS {g}" for g in _GLOBAL)
    return f"""
      SELECT c.date, {', '.join(f'b.{g}' for g in _GLOBAL)}
      FROM (SELECT CAST(unnest(generate_series(min(date), max(date), {step})) AS DATE) AS date
            FROM (SELECT {label} AS date FROM {source})) c
      LEFT JOIN (SELECT {label} AS date, {sums} FROM {source} GROUP BY 1) b
        ON b.date = c.date"""


def _running(body):
    sums = ", ".join(
        f"sum(coalesce(global_new_{s}, 0.0)) {_SO_FAR} AS cumulative_{s}" for _, s in _SERIES
    )
    return f"SELECT *, {sums} FROM ({body})"


def _top(source, metric, n, where=""):
    return f"""SELECT * FROM {source} WHERE {metric} IS NOT NULL {where}
      ORDER BY {metric} DESC, location_key LIMIT {n}"""


def _correlation(source, metrics):
    cells = []
    for a in metrics:
        for b in metrics:
            x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            spread = f"(stddev_pop({x}) * stddev_pop({y}))"
            cells.append(
                f"""SELECT '{a}' AS metric_a, '{b}' AS metric_b,
                round(covar_pop({x}, {y}) / nullif({spread}, 0), 6) AS correlation
                FROM {source} WHERE {both}"""
            )
    return " UNION ALL ".join(cells)


def _quality(name, source, columns, order):
    missing = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    listed = ", ".join(columns)
    return f"""
      SELECT {order} AS o, '{name}' AS result, count(*) AS rows,
        CAST({len(columns)} AS INTEGER) AS columns, {missing} AS missing_cells,
        (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {source})) AS different
      FROM {source}"""


_CASE_COLUMNS = [
    "date", "location_key", *CASES, "cumulative_recovered",
]
_COUNTRY_COLUMNS = [
    "country_name", "location_key", "total_confirmed", "total_deceased", "total_recovered",
    "total_people_vaccinated", "total_vaccine_doses_administered",
    "cumulative_vaccine_doses_administered", "peak_cumulative_confirmed",
    "peak_cumulative_deceased", "peak_daily_confirmed", "days_reported", "active_cases",
    "case_fatality_rate", "population", "cases_per_million", "deaths_per_million",
    "total_vaccinated",
]
_CLEAN_CASES = f"""SELECT src_id, date, location_key, {_clean(CASES)}, cumulative_recovered
  FROM (SELECT *, row_number() OVER (PARTITION BY date, location_key ORDER BY src_id) AS rn
        FROM cases WHERE date IS NOT NULL AND location_key IS NOT NULL) WHERE rn = 1"""
_ESTIMATED_DAILY = f"""
  SELECT e.date, e.global_new_confirmed, e.global_new_deceased, e.global_new_recovered,
    CAST(round_even(avg(e.global_new_confirmed) OVER (
      ORDER BY e.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0) AS DOUBLE) AS rolling_avg_7d,
    coalesce(v.global_new_vaccinated, 0.0) AS global_new_vaccinated
  FROM (SELECT date, sum(new_confirmed) AS global_new_confirmed,
          sum(new_deceased) AS global_new_deceased, sum(new_recovered) AS global_new_recovered
        FROM increments WHERE length(location_key) = 2 GROUP BY date) e
  LEFT JOIN (SELECT date, sum(new_persons_vaccinated) AS global_new_vaccinated
             FROM vacc WHERE length(location_key) = 2 GROUP BY date) v ON v.date = e.date"""
_SHOWN = (
    "place, total_confirmed, total_deceased, total_recovered, cases_per_million,"
    " deaths_per_million, CAST(population AS {0}) AS population"
)
_COMPARED = ["total_confirmed", "total_deceased", "case_fatality_rate", "days_reported"]
_BOX = """SELECT {0} quantile_cont({1}, 0.25) AS q1, quantile_cont({1}, 0.5) AS median,
  quantile_cont({1}, 0.75) AS q3 FROM cases {2}"""
_FENCES = """SELECT *, q1 - (q3 - q1) * 1.5 AS lower_fence, q3 + (q3 - q1) * 1.5 AS upper_fence
  FROM ({0})"""

BODIES = {
    "clean_records": _CLEAN_CASES,
    "clean_negatives_only": f"""SELECT src_id, date, location_key, {', '.join(
        f'CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END AS {c}' for c in CASES)},
        cumulative_recovered FROM cases""",
    "clean_increments": "SELECT * FROM increments",
    "drop_missing_keys": "SELECT * FROM cases WHERE date IS NOT NULL AND location_key IS NOT NULL",
    "fill_all_numeric": f"""SELECT src_id, date, location_key, {', '.join(
        f'coalesce({c}, 0.0) AS {c}' for c in [*CASES, 'cumulative_recovered'])} FROM cases""",
    "dedupe_first": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY date, location_key ORDER BY src_id) AS rn FROM cases) WHERE rn = 1""",
    "latest_rows": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY location_key ORDER BY date DESC, src_id) AS rn
        FROM cases WHERE location_key IS NOT NULL) WHERE rn = 1""",
    "country_level_rows": """SELECT * FROM cases WHERE length(location_key) = 2
        AND (new_confirmed IS NOT NULL OR cumulative_confirmed IS NOT NULL)""",
    "regional_level_rows": """SELECT * FROM cases WHERE length(location_key) > 2
        AND (new_confirmed IS NOT NULL OR cumulative_confirmed IS NOT NULL)""",
    "index_level_rows": "SELECT * FROM idx WHERE aggregation_level = 1",
    "level_one_members": """SELECT * FROM cases WHERE location_key IN (
        SELECT location_key FROM idx WHERE aggregation_level = 1)""",
    "named_cases": """SELECT c.*, i.country_name FROM cases c
        LEFT JOIN idx i ON i.location_key = c.location_key""",
    "parent_countries": """SELECT c.*, split_part(c.location_key, '_', 1) AS country_code,
        i.country_name AS parent_country FROM cases c
        LEFT JOIN idx i ON i.location_key = split_part(c.location_key, '_', 1)
        WHERE length(c.location_key) > 2""",
    "continents_of_cases": """SELECT c.*, coalesce(t.continent, 'Other') AS continent
        FROM cases c LEFT JOIN cont t ON t.location_key = c.location_key""",
    "country_frame_rows": "SELECT * FROM country",
    "regional_frame_rows": "SELECT * FROM regional",
    "facts_frame_rows": """
      SELECT c.date, c.location_key, country_name, new_confirmed, new_deceased, new_recovered,
        cumulative_confirmed, cumulative_deceased, cumulative_recovered,
        new_persons_vaccinated, cumulative_persons_vaccinated,
        new_vaccine_doses_administered, cumulative_vaccine_doses_administered,
        new_hospitalized_patients, current_hospitalized_patients,
        location_key AS country_code, country_name AS parent_country, 'country' AS level
      FROM country c
      UNION ALL
      SELECT date, location_key, country_name, new_confirmed, new_deceased, new_recovered,
        cumulative_confirmed, cumulative_deceased, cumulative_recovered,
        new_persons_vaccinated, cumulative_persons_vaccinated,
        new_vaccine_doses_administered, cumulative_vaccine_doses_administered,
        0.0, NULL, country_code, parent_country, 'regional'
      FROM regional""",
    "global_metrics": "SELECT * FROM world",
    "country_summary": "SELECT * FROM country_sum",
    "country_summary_no_population": f"""
      SELECT t.country_name, t.location_key, total_confirmed, total_deceased, total_recovered,
        CAST(NULL AS DOUBLE) AS total_people_vaccinated,
        CAST(NULL AS DOUBLE) AS total_vaccine_doses_administered,
        CAST(NULL AS DOUBLE) AS cumulative_vaccine_doses_administered,
        peak_cumulative_confirmed, peak_cumulative_deceased, peak_daily_confirmed,
        days_reported, l.active AS active_cases, {_CFR} AS case_fatality_rate,
        CAST(NULL AS BIGINT) AS population, CAST(NULL AS DOUBLE) AS cases_per_million,
        CAST(NULL AS DOUBLE) AS deaths_per_million, CAST(NULL AS DOUBLE) AS total_vaccinated
      FROM totals t LEFT JOIN latest_open l ON l.location_key = t.location_key""",
    "daily_summary": "SELECT * FROM daily",
    "country_daily_summary": "SELECT * FROM country_daily",
    "vaccination_summary": "SELECT * FROM vaccination",
    "hospitalization_summary": "SELECT * FROM hospitalization",
    "regional_summary": "SELECT * FROM regional_sum",
    "run_all_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS result, count(*) AS rows FROM {p}"
        for n, p in {
            "global_metrics": "world", "country_summary": "country_sum",
            "daily_summary": "daily", "country_daily_summary": "country_daily",
            "vaccination_summary": "vaccination",
            "hospitalization_summary": "hospitalization", "regional_summary": "regional_sum",
        }.items()
    ),
    "country_summary_raw": f"""SELECT *, {_CFR} AS case_fatality_rate FROM (
        SELECT country_name, location_key, sum(new_confirmed) AS total_confirmed,
          sum(new_deceased) AS total_deceased,
          sum(new_persons_vaccinated) AS total_vaccinated,
          max(cumulative_confirmed) AS peak_cumulative, count(date) AS days_reported
        FROM raw WHERE country_name IS NOT NULL GROUP BY country_name, location_key)""",
    "daily_summary_raw": f"""SELECT *, round(avg(global_new_confirmed) {_WEEK}, 0)
        AS rolling_avg_7d FROM (SELECT date, sum(new_confirmed) AS global_new_confirmed,
          sum(new_deceased) AS global_new_deceased,
          sum(new_persons_vaccinated) AS global_new_vaccinated FROM raw GROUP BY date)""",
    "vaccination_summary_raw": """SELECT country_name, location_key,
        sum(new_persons_vaccinated) AS total_vaccinated,
        max(cumulative_persons_vaccinated) AS cumulative_vaccinated,
        max(new_persons_vaccinated) AS peak_daily_vaccinated
        FROM raw WHERE country_name IS NOT NULL GROUP BY country_name, location_key""",
    "hospitalization_summary_raw": """SELECT country_name, location_key,
        sum(new_hospitalized_patients) AS total_hospitalized,
        max(new_hospitalized_patients) AS peak_hospitalized,
        round(avg(new_hospitalized_patients), 2) AS avg_daily_hospitalized
        FROM raw WHERE country_name IS NOT NULL AND new_hospitalized_patients > 0
        GROUP BY country_name, location_key""",
    "country_summary_estimated": """SELECT *,
        CASE WHEN population > 0 THEN coalesce(CAST(round_even(
          total_confirmed / (population / 1000000), 1) AS DOUBLE), 0.0) ELSE 0.0 END
          AS cases_per_million,
        CASE WHEN population > 0 THEN coalesce(CAST(round_even(
          total_deceased / (population / 1000000), 1) AS DOUBLE), 0.0) ELSE 0.0 END
          AS deaths_per_million,
        CASE WHEN total_recovered > 0
          THEN greatest(total_confirmed - total_deceased - total_recovered, 0.0)
          ELSE CAST(round_even(total_confirmed * 0.05, 0) AS DOUBLE) END AS active_cases,
        CASE WHEN total_confirmed > 0 THEN CAST(round_even(
          total_deceased / total_confirmed * 100, 4) AS DOUBLE) ELSE 0.0 END
          AS case_fatality_rate
        FROM estimated""",
    "daily_summary_vaccinated": _ESTIMATED_DAILY,
    "chunked_daily_totals": _ESTIMATED_DAILY,
    "vaccination_summary_all_days": """SELECT v.*, i.country_name,
        new_persons_vaccinated AS total_vaccinated,
        cumulative_persons_vaccinated AS cumulative_vaccinated,
        CAST(0 AS DOUBLE) AS peak_daily_vaccinated FROM vacc_totals v
        LEFT JOIN idx i ON i.location_key = v.location_key AND i.aggregation_level = 0""",
    "hospitalization_all_rows": """SELECT h.location_key, i.country_name,
        coalesce(sum(new_hospitalized_patients), 0.0) AS total_hospitalized,
        max(new_hospitalized_patients) AS peak_hospitalized,
        CAST(round_even(avg(new_hospitalized_patients), 2) AS DOUBLE)
          AS avg_daily_hospitalized,
        count(date) AS hospitalization_days FROM hosp h
        JOIN idx i ON i.location_key = h.location_key AND i.aggregation_level = 0
        GROUP BY h.location_key, i.country_name""",
    "regional_summary_level1": """SELECT e.location_key, i.subregion1_name AS region_name,
        i.country_code, i.country_name AS parent_country,
        sum(new_confirmed) AS total_confirmed, sum(new_deceased) AS total_deceased,
        sum(new_recovered) AS total_recovered, count(date) AS days_reported,
        CAST(0 AS DOUBLE) AS total_vaccine_doses_administered
        FROM increments e JOIN idx i ON i.location_key = e.location_key
        WHERE i.aggregation_level = 1
        GROUP BY e.location_key, i.subregion1_name, i.country_code, i.country_name""",
    "override_merge": f"""SELECT s.* REPLACE (
        {', '.join(f'CASE WHEN o.location_key IS NOT NULL THEN o.{c} ELSE s.{c} END AS {c}'
                   for c in ['country_name', 'total_confirmed', 'total_deceased',
                             'total_recovered', 'population'])})
        FROM country_sum s LEFT JOIN overrides o ON o.location_key = s.location_key""",
    "country_row_counts": """SELECT trim(location_key) AS location_key, count(*) AS rows
        FROM cases WHERE length(trim(location_key)) = 2 GROUP BY 1""",
    "added_counts": """SELECT trim(location_key) AS location_key,
        CAST(2 * count(*) AS BIGINT) AS rows
        FROM cases WHERE length(trim(location_key)) = 2 GROUP BY 1""",
    "period_summary": _period("WHERE date >= DATE '1996-03-01' AND date < DATE '1999-11-01'"),
    "period_summary_all": _period(),
    "date_range": """SELECT * FROM daily
        WHERE date >= DATE '1996-03-01' AND date <= DATE '1999-10-31'""",
    "selected_countries_daily": _selected(),
    "resample_daily": _resampled("day"),
    "resample_weekly": _resampled("week"),
    "resample_monthly": _resampled("month"),
    "resample_weekly_cumulative": _running(_resampled("week")),
    "monthly_top_countries": """SELECT * FROM monthly WHERE country_name IN (
        SELECT country_name FROM month_ranks WHERE rn <= 12)""",
    "country_month_pivot": f"""SELECT country_name, {', '.join(
        f'''coalesce(sum(CASE WHEN month = DATE '{m}' THEN new_confirmed END), 0.0) AS "{m}"'''
        for m in MONTHS)}
        FROM monthly WHERE country_name IN (
          SELECT country_name FROM month_ranks WHERE rn <= 20) GROUP BY country_name""",
    "peak_day": """SELECT max(global_new_confirmed) AS peak_value,
        (SELECT date FROM daily_sums ORDER BY global_new_confirmed DESC NULLS LAST, date LIMIT 1)
          AS peak_date, count(*) AS periods FROM daily_sums""",
    "date_bounds": "SELECT min(date) AS first_date, max(date) AS last_date FROM cases",
    "enriched_country_metrics": """SELECT s.* EXCLUDE (cases_per_million, deaths_per_million),
        coalesce(c.continent, 'Other') AS continent,
        v.peak_daily_vaccine_doses_administered,
        s.total_confirmed / (CASE WHEN population <> 0 THEN population END / 1000000)
          AS cases_per_million,
        s.total_deceased / (CASE WHEN population <> 0 THEN population END / 1000000)
          AS deaths_per_million,
        s.total_people_vaccinated / (CASE WHEN population <> 0 THEN population END / 100)
          AS people_vaccinated_per_hundred,
        s.total_vaccine_doses_administered
          / (CASE WHEN population <> 0 THEN population END / 100) AS vaccinations_per_hundred
        FROM country_sum s LEFT JOIN vaccination v ON v.location_key = s.location_key
        LEFT JOIN cont c ON c.location_key = s.location_key""",
    "coalescing_merge": """SELECT s.location_key,
        coalesce(CASE WHEN days_reported % 2 = 0 THEN s.total_people_vaccinated END,
          v.total_people_vaccinated) AS total_people_vaccinated,
        v.peak_daily_vaccine_doses_administered
        FROM country_sum s LEFT JOIN vaccination v ON v.location_key = s.location_key""",
    "late_population": """SELECT t.* REPLACE (
          CAST(NULL AS DOUBLE) AS total_people_vaccinated,
          CAST(NULL AS DOUBLE) AS total_vaccine_doses_administered,
          CAST(NULL AS DOUBLE) AS cumulative_vaccine_doses_administered,
          CAST(NULL AS DOUBLE) AS total_vaccinated, CAST(population AS DOUBLE) AS population,
          total_confirmed / (CASE WHEN population <> 0 THEN population END / 1000000)
            AS cases_per_million,
          total_deceased / (CASE WHEN population <> 0 THEN population END / 1000000)
            AS deaths_per_million),
        CAST(NULL AS DOUBLE) AS vaccinations_per_hundred FROM country_sum t""",
    "renamed_doses": """SELECT *, total_vaccine_doses_administered AS total_vaccine_doses
        FROM vaccination""",
    "map_names": """SELECT location_key, country_name, CASE country_name
        WHEN 'NATION_1' THEN 'First Nation' WHEN 'NATION_2' THEN 'Second Nation'
        ELSE country_name END AS map_country_name
        FROM country_sum WHERE country_name IS NOT NULL""",
    "kpis": """SELECT total_cases, total_deaths, total_recoveries,
        active_cases_worldwide AS active_cases, total_vaccine_doses_administered,
        total_people_vaccinated, countries_reporting AS countries_regions, latest_data_date
        FROM world""",
    "kpis_from_countries": """SELECT sum(total_confirmed) AS total_cases,
        sum(total_deceased) AS total_deaths, sum(total_recovered) AS total_recoveries,
        coalesce(nullif(sum(active_cases), 0), 22.0) AS active_cases,
        sum(total_vaccine_doses_administered) AS total_vaccine_doses_administered,
        sum(total_people_vaccinated) AS total_people_vaccinated,
        count(DISTINCT location_key) AS countries_regions,
        (SELECT max(date) FROM daily_sums) AS latest_data_date FROM country_sum""",
    "continent_totals": "SELECT * FROM continent_sums",
    "ranked_breakdown": f"""SELECT CAST(all_position AS INTEGER) AS position,
        {_SHOWN.format('DOUBLE')} FROM shown
        UNION ALL SELECT 0, 'World', sum(total_confirmed), sum(total_deceased),
          sum(total_recovered), NULL, NULL, NULL FROM country_sum""",
    "ranked_breakdown_continent": f"""SELECT CAST(row_number() OVER (
          ORDER BY total_confirmed DESC, location_key) AS INTEGER) AS position,
        {_SHOWN.format('BIGINT')} FROM shown WHERE continent = 'ASIA'
        UNION ALL SELECT 0, continent || ' Total', total_confirmed, total_deceased,
          CASE WHEN total_recovered > 0 THEN total_recovered END,
          cases_per_million, deaths_per_million,
          CASE WHEN population > 0 THEN population END
        FROM continent_sums WHERE continent = 'ASIA'""",
    "ranked_breakdown_search": f"""SELECT CAST(row_number() OVER (
          ORDER BY total_confirmed DESC, location_key) AS INTEGER) AS position,
        {_SHOWN.format('BIGINT')} FROM shown
        WHERE regexp_matches(lower(place), '_1[0-9]$|^04')
           OR regexp_matches(lower(location_key), '_1[0-9]$|^04')""",
    "vaccination_kpis": """SELECT coalesce(sum(total_vaccine_doses_administered), 0.0) AS total,
        (SELECT country_name FROM vaccination ORDER BY
           total_vaccine_doses_administered DESC NULLS LAST, country_name DESC LIMIT 1)
          AS top_country, count(*) AS countries FROM vaccination""",
    "regional_kpis": """SELECT count(*) AS regions, sum(total_confirmed) AS total_confirmed,
        sum(total_recovered) AS total_recovered, sum(total_deceased) AS total_deceased
        FROM regional_sum""",
    "adhoc_sum": """SELECT continent, coalesce(sum(total_confirmed), 0.0) AS total_confirmed
        FROM by_continent GROUP BY continent""",
    "adhoc_mean": """SELECT continent, avg(days_reported) AS days_reported
        FROM by_continent GROUP BY continent""",
    "adhoc_median": """SELECT continent, median(total_confirmed) AS total_confirmed
        FROM by_continent GROUP BY continent""",
    "adhoc_median_cases": """SELECT location_key, median(new_confirmed) AS new_confirmed
        FROM cases GROUP BY location_key""",
    "adhoc_max": """SELECT continent, max(total_confirmed) AS total_confirmed
        FROM by_continent GROUP BY continent""",
    "hierarchy_rollup": """SELECT parent_country, location_key,
        CAST(grouping(parent_country) + grouping(location_key) AS INTEGER) AS level,
        sum(total_confirmed) AS total_confirmed
        FROM regional_sum GROUP BY ROLLUP (parent_country, location_key)""",
    "normalized_comparison": f"""SELECT country_name, location_key, {', '.join(
        f'''CASE WHEN max({c}) OVER () > 0 THEN {c} / max({c}) OVER () * 100
            WHEN {c} IS NULL THEN NULL ELSE 0.0 END AS {c}''' for c in _COMPARED)}
        FROM country_sum WHERE country_name IN {COUNTRIES}""",
    "metric_correlations": _correlation(
        "country_sum",
        ["total_confirmed", "total_deceased", "total_recovered", "days_reported", "population"],
    ),
    "case_correlations": _correlation(
        "cases", ["new_confirmed", "new_deceased", "new_recovered"]
    ),
    "metric_histogram": """
      SELECT b.bin, low + b.bin * width AS bin_start, coalesce(c.rows, 0) AS rows
      FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin, low, width FROM (
              SELECT min(new_confirmed) AS low,
                (max(new_confirmed) - min(new_confirmed)) / 20 AS width FROM cases)) b
      LEFT JOIN (SELECT CAST(least(floor((new_confirmed - s.low) / s.width), 19) AS INTEGER)
                   AS bin, count(*) AS rows
                 FROM cases, (SELECT min(new_confirmed) AS low,
                   (max(new_confirmed) - min(new_confirmed)) / 20 AS width FROM cases) s
                 WHERE new_confirmed IS NOT NULL GROUP BY 1) c ON c.bin = b.bin""",
    "metric_quartiles": _FENCES.format(_BOX.format("", "new_confirmed", "")),
    "metric_quartiles_by_country": _FENCES.format(
        _BOX.format(
            "location_key,",
            "new_recovered",
            "WHERE length(location_key) = 2 AND new_recovered IS NOT NULL"
            " GROUP BY location_key",
        )
    ),
    "metric_outliers": """SELECT v.* FROM vacc v
        JOIN doses_box b ON b.location_key = v.location_key
        WHERE new_vaccine_doses_administered < q1 - (q3 - q1) * 1.5
           OR new_vaccine_doses_administered > q3 + (q3 - q1) * 1.5""",
    "metric_whiskers": """SELECT v.location_key, q1, median, q3,
        min(new_vaccine_doses_administered) AS lower_whisker,
        max(new_vaccine_doses_administered) AS upper_whisker
        FROM vacc v JOIN doses_box b ON b.location_key = v.location_key
        WHERE new_vaccine_doses_administered BETWEEN q1 - (q3 - q1) * 1.5
          AND q3 + (q3 - q1) * 1.5
        GROUP BY v.location_key, q1, median, q3""",
    "top_countries_cases": _top("country_sum", "total_confirmed", 10),
    "top_countries_deaths": _top("country_sum", "total_deceased", 10),
    "top_cfr": _top("country_sum", "case_fatality_rate", 15),
    "top_cfr_min_volume": _top(
        "country_sum", "case_fatality_rate", 20, "AND total_confirmed > 10000"
    ),
    "top_vaccination": _top("vaccination", "total_vaccine_doses_administered", 15),
    "top_peak_vaccination": _top("vaccination", "peak_daily_vaccine_doses_administered", 15),
    "top_regions": _top("regional_sum", "total_confirmed", 30),
    "regions_of_countries": f"SELECT * FROM regional_sum WHERE parent_country IN {COUNTRIES}",
    "regions_by_name": """SELECT * FROM regional_sum
        WHERE region_name IN ('NATION_4', 'NATION_9')""",
    "point_lookup": "SELECT * FROM country_sum WHERE location_key = '07'",
    "continent_filter": "SELECT * FROM by_continent WHERE continent = 'EUROPE'",
    "threshold_filter": """SELECT * FROM country_sum
        WHERE coalesce(total_confirmed, 0) >= 100000 AND coalesce(population, 0) >= 5000000
          AND coalesce(total_people_vaccinated, 0) >= 10""",
    "search_any_column": """SELECT * FROM regional_sum
        WHERE contains(lower(location_key), '_high_f') OR contains(lower(region_name), '_high_f')
           OR contains(lower(coalesce(parent_country, '')), '_high_f')""",
    "search_regex": """SELECT * FROM country_sum
        WHERE regexp_matches(lower(country_name), '^nation_2|^1[0-3]$')
           OR regexp_matches(lower(location_key), '^nation_2|^1[0-3]$')""",
    "sort_nulls_last": """SELECT location_key, cases_per_million, CAST(row_number() OVER (
        ORDER BY cases_per_million DESC NULLS LAST, location_key) AS INTEGER) AS position
        FROM country_sum""",
    "filter_bounds": """SELECT max(coalesce(total_confirmed, 0.0)) AS max_total_confirmed,
        max(coalesce(CAST(population AS DOUBLE), 0.0)) AS max_population,
        max(coalesce(total_vaccine_doses_administered, 0.0))
          AS max_total_vaccine_doses_administered FROM country_sum""",
    "distinct_keys": "SELECT count(DISTINCT location_key) AS distinct_keys FROM cases",
    "distinct_countries": """SELECT DISTINCT country_name FROM country_sum
        WHERE country_name IS NOT NULL""",
    "source_preview_columns": "SELECT location_key, new_confirmed FROM cases",
    "data_quality": f"""
      SELECT result, rows, columns, missing_cells, CASE WHEN rows = 0 THEN 100.0
        ELSE round(100.0 * missing_cells / greatest(rows * columns, 1), 2) END AS missing_pct,
        rows - different AS duplicates FROM (
      {_quality('cases', 'cases', _CASE_COLUMNS, 1)}
      UNION ALL {_quality('country_summary', 'country_sum', _COUNTRY_COLUMNS, 2)}
      UNION ALL SELECT 3, 'empty', 0, {len(_COUNTRY_COLUMNS)}, 0, 0)""",
    "parquet_roundtrip": "SELECT * FROM regional_sum",
    "compact_parquet": "SELECT * FROM country_sum",
    "documents_roundtrip": "SELECT * FROM country_sum",
    "all_documents_counts": """SELECT 'country_summary' AS result, count(*) AS rows
        FROM country_sum UNION ALL SELECT 'vaccination_summary', count(*) FROM vaccination""",
    "dedupe_default_order": """SELECT date, location_key, new_confirmed, src_id FROM (
        SELECT *, row_number() OVER (PARTITION BY date, location_key
          ORDER BY new_confirmed NULLS LAST, src_id) AS rn
        FROM cases WHERE date IS NOT NULL AND location_key IS NOT NULL) WHERE rn = 1""",
    "repeated_dimension_keys": f"""SELECT c.location_key, src_id, c_mktsegment, c_custkey
        FROM cases c LEFT JOIN (SELECT *, {_key('c_nationkey')} AS k, row_number() OVER (
          PARTITION BY c_nationkey ORDER BY c_mktsegment NULLS LAST, c_custkey) AS rn
          FROM customer) d ON c.location_key = k AND rn = 1""",
    "built_in_continents": """SELECT n_name, code AS location_key, CASE code
          WHEN 'US' THEN 'North America' WHEN 'BR' THEN 'South America' WHEN 'FR' THEN 'Europe'
          WHEN 'IN' THEN 'Asia' WHEN 'ZA' THEN 'Africa' WHEN 'AU' THEN 'Oceania'
          WHEN 'MO' THEN 'Asia' ELSE 'Other' END AS continent
        FROM (SELECT n_name, ['US', 'BR', 'FR', 'IN', 'ZA', 'AU', 'MO', 'QQ']
          [n_nationkey % 8 + 1] AS code FROM nation)""",
    "documents_json": """SELECT '{"location_key":"' || location_key || '","country_name":"'
        || country_name || '","days_reported":' || days_reported
        || coalesce(',"population":' || population, '')
        || ',"_loaded_at":"2024-01-01T00:00:00Z"}' AS document FROM country_sum""",
    "load_with_fallback": "SELECT *, 'parquet' AS source FROM vaccination",
    "csv_roundtrip": _CLEAN_CASES,
    "typed_csv_roundtrip": "SELECT src_id, date, location_key, new_confirmed FROM cases",
    "optional_demographics": """SELECT location_key, CAST(population AS VARCHAR) AS population
        FROM demo""",
    "counts_text": """SELECT trim(location_key) || chr(9) || count(*) AS value
        FROM cases WHERE length(trim(location_key)) = 2 GROUP BY trim(location_key)""",
    "preview_rows": "SELECT 'preview' AS result, least(count(*), 500) AS rows FROM cases",
    "explored_regions": """SELECT * FROM regional_sum
        WHERE contains(lower(location_key), '_high_f') OR contains(lower(region_name), '_high_f')
           OR contains(lower(coalesce(parent_country, '')), '_high_f')""",
    "key_line_counts": """SELECT trim(location_key) AS location_key, count(*) AS rows
        FROM cases WHERE length(trim(location_key)) = 2 GROUP BY 1""",
    "empty_metric": """SELECT 'country_summary' AS result, count(*) AS rows FROM country_sum
        UNION ALL SELECT 'vaccination_summary', 0 UNION ALL SELECT 'hospitalization_summary', 0""",
    "filtered_country_view": _period(
        f"""WHERE date >= DATE '1996-01-01' AND date < DATE '2001-01-01'
            AND country_name IN {COUNTRIES}""",
        "WHERE total_confirmed >= 1000",
    ),
}
PIECES["selected_range"] = _selected(
    "AND date >= DATE '1996-01-01' AND date < DATE '2001-01-01'"
)
BODIES["filtered_series_view"] = _running(_resampled("month", "selected_range"))
_DAYS = "OVER ({by} ORDER BY date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND CURRENT ROW)"
BODIES["daily_summary_calendar"] = PIECES["daily"].replace(_WEEK, _DAYS.format(by="", n=6))
_BY_PLACE = _DAYS.format(by="PARTITION BY location_key", n="{n}")
BODIES["country_calendar_means"] = f"""
  SELECT location_key, date, new_confirmed, new_deceased,
    round(avg(new_confirmed) {_BY_PLACE.format(n=6)}, 6) AS new_confirmed_mean_7d,
    round(avg(new_deceased) {_BY_PLACE.format(n=6)}, 6) AS new_deceased_mean_7d
  FROM country_daily"""
BODIES["country_calendar_sums"] = f"""
  SELECT location_key, date, new_confirmed,
    round(coalesce(sum(new_confirmed) {_BY_PLACE.format(n=13)}, 0.0) / 14, 6) AS new_confirmed_mean_14d
  FROM country_daily"""
# Every expected day laid out, where the operator works from gaps.
BODIES["monthly_completeness"] = """
  SELECT location_key, month, count(*) AS days_expected, count(reported) AS days_reported,
    round(100.0 * count(reported) / count(*), 2) AS completeness_pct,
    coalesce(sum(confirmed), 0)::BIGINT AS days_with_new_confirmed,
    coalesce(sum(cumulative), 0)::BIGINT AS days_with_cumulative_confirmed
  FROM (
    SELECT e.location_key, CAST(date_trunc('month', e.day) AS DATE) AS month, r.date AS reported, confirmed, cumulative
    FROM (SELECT location_key, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS day
          FROM cases WHERE location_key IS NOT NULL AND date IS NOT NULL GROUP BY location_key) e
    LEFT JOIN (SELECT location_key, date, max(CASE WHEN new_confirmed IS NOT NULL THEN 1 ELSE 0 END) AS confirmed,
                 max(CASE WHEN cumulative_confirmed IS NOT NULL THEN 1 ELSE 0 END) AS cumulative
               FROM cases GROUP BY location_key, date) r
      ON r.location_key = e.location_key AND r.date = e.day)
  GROUP BY location_key, month"""


def _zscore(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN NULL
      WHEN stddev_pop({c}) OVER (PARTITION BY country_name) > 0
      THEN round(({c} - avg({c}) OVER (PARTITION BY country_name))
        / stddev_pop({c}) OVER (PARTITION BY country_name), 6) + 0.0 ELSE 0.0 END AS {c}_zscore"""


BODIES["country_zscores"] = f"""
  SELECT country_name, location_key, date, new_confirmed, new_hospitalized_patients,
    {_zscore('new_confirmed')}, {_zscore('new_hospitalized_patients')} FROM country"""
BODIES["country_zscores_merged"] = BODIES["country_zscores"]
BODIES["custom_metrics"] = """
  SELECT location_key, total_confirmed, total_deceased, total_recovered, days_reported, population,
    total_deceased / nullif(total_confirmed, 0) * 100 AS deaths_per_case,
    (total_confirmed - total_recovered - total_deceased) / nullif(CAST(population AS DOUBLE), 0) AS open_share,
    greatest(-total_recovered, abs(total_deceased - 3.5)) + coalesce(CAST(population AS DOUBLE), 1e3) AS balance,
    total_confirmed / nullif(CAST(days_reported AS DOUBLE) - 100, 0) AS per_quiet_day
  FROM country_sum"""
_PAGED = """
  SELECT location_key, date, nullif(new_confirmed, 0) AS new_confirmed,
    row_number() OVER (ORDER BY nullif(new_confirmed, 0) DESC NULLS LAST, location_key, date) - 1 AS row
  FROM country_daily"""
BODIES["paged_reports"] = f"SELECT *, CAST(row // 50 AS BIGINT) AS page FROM ({_PAGED})"
BODIES["page_after_key"] = f"SELECT * FROM ({_PAGED}) WHERE row BETWEEN 150 AND 199"


def _rule(name: str, fails: str) -> str:
    key = "coalesce(location_key, 'null') || '|' || coalesce(CAST(date AS VARCHAR), 'null')"
    order = "location_key {0} NULLS {1}, date {0} NULLS {1}"
    pick = "first({key} ORDER BY {order}) FILTER (WHERE {fails})"
    return f"""SELECT '{name}' AS rule, count(*) AS checked, count(*) FILTER (WHERE {fails}) AS failed,
      {pick.format(key=key, order=order.format('ASC', 'FIRST'), fails=fails)} AS first_key,
      {pick.format(key=key, order=order.format('DESC', 'LAST'), fails=fails)} AS last_key
      FROM (SELECT *, row_number() OVER (PARTITION BY location_key, date) AS nth FROM cases)"""


BODIES["value_contracts"] = " UNION ALL ".join(
    _rule(name, fails)
    for name, fails in {
        "location_key is there": "location_key IS NULL",
        "new_confirmed is there": "new_confirmed IS NULL",
        "location_key reads as int": "location_key IS NOT NULL AND TRY_CAST(location_key AS INT) IS NULL",
        "new_confirmed between 0 and 900": "new_confirmed < 0 OR new_confirmed > 900",
        "new_deceased is listed": "new_deceased NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14)",
        "location_key has the shape ^[0-9]{2}(_[A-Z]+)?$": "NOT regexp_matches(location_key, '^[0-9]{2}(_[A-Z]+)?$')",
        "new_recovered at most cumulative_recovered": "new_recovered > cumulative_recovered",
        "keys are unique": "nth > 1",
    }.items()
)
BODIES["chunk_totals_merged"] = BODIES["chunked_daily_totals"]
BODIES["unparseable_dates"] = f"""SELECT src_id, date, location_key, {_clean(CASES)}, cumulative_recovered
  FROM (SELECT *, row_number() OVER (PARTITION BY date, location_key ORDER BY src_id) AS rn FROM (
    SELECT * REPLACE (CASE WHEN src_id % 13 <> 5 THEN date END AS date)
    FROM cases WHERE (date IS NOT NULL OR src_id % 13 = 5) AND location_key IS NOT NULL)) WHERE rn = 1"""
BODIES["sort_ascending"] = """SELECT cases_per_million,
  CAST(row_number() OVER (ORDER BY cases_per_million NULLS LAST) AS INTEGER) AS position FROM country_sum"""
BODIES["inferred_csv_types"] = BODIES["typed_csv_roundtrip"]
_RUNS = {
    "clean": {
        name: name
        for name in (
            "global_metrics", "country_summary", "daily_summary", "country_daily_summary",
            "vaccination_summary", "hospitalization_summary", "regional_summary",
        )
    },
    "raw": {
        f"{name}_summary": f"{name}_summary_raw" for name in ("country", "daily", "vaccination", "hospitalization")
    },
    "estimated": {
        "country_summary": "country_summary_estimated",
        "daily_summary": "daily_summary_vaccinated",
        "regional_summary": "regional_summary_level1",
        "vaccination_summary": "vaccination_summary_all_days",
        "hospitalization_summary": "hospitalization_all_rows",
    },
}
_PLACE = ["location_key", "country_name"]
_KEYS = {
    "global_metrics": ["latest_data_date"],
    "daily_summary": ["date"],
    "country_daily_summary": [*_PLACE, "date"],
    "regional_summary": ["location_key", "region_name", "country_code", "parent_country"],
}


def _values(result: str, body: str, keys: list[str]) -> str:
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"""SELECT '{result}' AS result, key, metric, value FROM (
      UNPIVOT (SELECT {key} AS key, CAST(COLUMNS(* EXCLUDE ({', '.join(keys)})) AS DOUBLE) FROM ({body}))
      ON COLUMNS(* EXCLUDE (key)) INTO NAME metric VALUE value)"""


for _variant, _parts in _RUNS.items():
    BODIES[f"stored_run_{_variant}"] = " UNION ALL ".join(
        _values(
            result,
            BODIES[twin],
            [*_PLACE, "continent"] if twin == "country_summary_estimated" else _KEYS.get(result, _PLACE),
        )
        for result, twin in _parts.items()
    )
BODIES["kpis_from_stored_results"] = BODIES["kpis"]
BODIES["merged_country_metrics"] = BODIES["enriched_country_metrics"]
for _variant in ("raw", "estimated"):
    BODIES[f"documents_roundtrip_{_variant}"] = BODIES[f"country_summary_{_variant}"]

ORACLES = {name: _twin(body) for name, body in BODIES.items()}
