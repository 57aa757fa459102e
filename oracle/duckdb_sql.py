"""Oracle SQL for DuckDB: the same results as the Spark queries, written
independently as plain SQL over the driver's tables.

The silver chain is a list of CTEs in chain order; a query for step k is
``WITH <feeds>, <steps up to k> SELECT ...``. Hash surrogate keys cannot be
reproduced outside Spark, so gold queries join and group on the natural
keys they are computed from (event_name; event_name + athlete_id).
"""

from __future__ import annotations

LEN = '"event_distance/length"'

FEED_MAIN = r"""
feed_main AS (
 SELECT CAST(year(l_shipdate) - l_partkey % 6 AS INTEGER) AS year_of_event,
  CASE l_orderkey % 11
   WHEN 0 THEN CAST(year(l_shipdate) AS VARCHAR)||'-'||lpad(CAST(month(l_shipdate) AS VARCHAR),2,'0')||'-'||lpad(CAST(day(l_shipdate) AS VARCHAR),2,'0')
   WHEN 1 THEN lpad(CAST(day(l_shipdate) AS VARCHAR),2,'0')||'.-'||lpad(CAST(day(l_shipdate + INTERVAL 1 DAY) AS VARCHAR),2,'0')||'.'||lpad(CAST(month(l_shipdate + INTERVAL 1 DAY) AS VARCHAR),2,'0')||'.'||CAST(year(l_shipdate + INTERVAL 1 DAY) AS VARCHAR)
   WHEN 2 THEN '31.04.'||CAST(year(l_shipdate) AS VARCHAR)
   WHEN 3 THEN NULL
   ELSE lpad(CAST(day(l_shipdate) AS VARCHAR),2,'0')||'.'||lpad(CAST(month(l_shipdate) AS VARCHAR),2,'0')||'.'||CAST(year(l_shipdate) AS VARCHAR) END AS event_dates,
  'Ultra '||CAST(l_partkey AS VARCHAR)||' (C'||lpad(CAST(l_partkey % 25 AS VARCHAR),2,'0')||')' AS event_name,
  CASE l_partkey % 8 WHEN 0 THEN '50km' WHEN 1 THEN '100km' WHEN 2 THEN '50mi' WHEN 3 THEN '6h' WHEN 4 THEN '24h' WHEN 5 THEN '6d' WHEN 6 THEN '173km/2Etappen' ELSE '12h' END AS "event_distance/length",
  CAST(1 + (l_partkey * 7) % 900 AS INTEGER) AS event_number_of_finishers,
  CASE WHEN l_suppkey % 50 = 0 THEN NULL
   WHEN (l_partkey % 8 IN (0,1,2,5,6)) = (l_linenumber < 7) THEN
    CASE WHEN l_suppkey % 20 = 7 THEN '1d ' ELSE '' END
    || CAST(CAST(floor(CAST(floor(l_extendedprice * 2.5) AS INTEGER) / 3600.0) AS INTEGER) AS VARCHAR)
    ||':'||lpad(CAST(CAST(floor(CAST(floor(l_extendedprice * 2.5) AS INTEGER) / 60.0) AS INTEGER) % 60 AS VARCHAR),2,'0')
    ||':'||lpad(CAST(CAST(floor(l_extendedprice * 2.5) AS INTEGER) % 60 AS VARCHAR),2,'0')||' h'
   ELSE CAST(l_quantity * 12.5 AS VARCHAR)||' km' END AS athlete_performance,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '*'||c_mktsegment ELSE c_mktsegment END AS athlete_club,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE 'C'||lpad(CAST(CASE WHEN c_nationkey < 23 AND c_custkey % 4 = 1 THEN 7 WHEN c_nationkey < 23 AND c_custkey % 4 = 2 THEN 3 ELSE c_nationkey END AS VARCHAR),2,'0') END AS athlete_country,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(1890 + (c_custkey * 13) % 100 AS DOUBLE) END AS athlete_year_of_birth,
  CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'F' ELSE 'M' END AS athlete_gender,
  CASE WHEN c_custkey % 4 <> 0 THEN 'M' WHEN l_orderkey % 2 = 0 THEN 'F' ELSE 'W' END||CAST(20 + 5 * (c_custkey % 10) AS VARCHAR) AS athlete_age_category,
  CASE l_suppkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '18:00:00' WHEN 2 THEN '1.5' WHEN 3 THEN '25.0' ELSE CAST(3.0 + l_quantity / 4 AS VARCHAR) END AS athlete_average_speed,
  c_custkey AS athlete_id
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

FEED_SECOND = r"""
feed_second AS (
 SELECT CAST(2024 AS INTEGER) AS year_of_event, 'Trail Classic (C07)' AS event_name,
  '50km' AS "event_distance/length", CAST(84 AS INTEGER) AS event_number_of_finishers,
  CAST(5 + o_orderkey % 9 AS VARCHAR)||':30:00 h' AS athlete_performance,
  'C'||lpad(CAST(CASE WHEN c_nationkey < 23 AND c_custkey % 4 = 1 THEN 7 WHEN c_nationkey < 23 AND c_custkey % 4 = 2 THEN 3 ELSE c_nationkey END AS VARCHAR),2,'0') AS athlete_country,
  CAST(1950 + c_custkey % 50 AS DOUBLE) AS athlete_year_of_birth,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS athlete_gender,
  CASE WHEN c_custkey % 2 = 0 THEN 'F40' ELSE 'M40' END AS athlete_age_category,
  '7.5' AS athlete_average_speed, c_custkey AS athlete_id,
  DATE '2024-06-15' AS event_start_date, DATE '2024-06-15' AS event_end_date
 FROM orders JOIN customer ON o_custkey = c_custkey)"""

LOOKUP = r"""
country_lookup AS (
 SELECT 'C'||lpad(CAST(n_nationkey AS VARCHAR),2,'0') AS athlete_country, n_name AS country_name
 FROM nation WHERE n_nationkey < 23)"""

FEED = "feed AS (SELECT * FROM feed_main UNION ALL BY NAME SELECT * FROM feed_second)"

_EURO = r"regexp_extract(event_dates, '^(\d{2})', 1) || '.' || regexp_extract(event_dates, '(\d{2}\.\d{4})', 1)"
_ISO = r"CAST(try_strptime(event_dates, '%Y-%m-%d') AS DATE)"
_HMS = r"'(\d+):(\d+):(\d+)'"
_KM = r"'\d+\.?\d*\s*km'"

# (step name, CTE body) in chain order; each reads the previous one.
STEPS = [
    ("filter_fill_unknown", "SELECT * REPLACE (coalesce(CAST(athlete_club AS VARCHAR), 'Unknown') AS athlete_club, "
                            "coalesce(CAST(athlete_country AS VARCHAR), 'Unknown') AS athlete_country) FROM {prev}"),
    ("clean_validate_units", f"SELECT * FROM {{prev}} WHERE CASE WHEN regexp_matches({LEN}, 'km|mi|mile') "
                             f"THEN ends_with(athlete_performance, 'h') WHEN regexp_matches({LEN}, 'h') "
                             f"THEN ends_with(athlete_performance, 'km') ELSE false END"),
    ("parse_event_type", f"SELECT *, CASE WHEN regexp_matches({LEN}, 'km|mi|mile') THEN 'distance' "
                         f"WHEN regexp_matches({LEN}, 'h') THEN 'time' END AS event_type FROM {{prev}}"),
    ("parse_event_dates",
     "SELECT * FROM (SELECT * REPLACE ("
     f"coalesce(CAST(try_strptime({_EURO}, '%d.%m.%Y') AS DATE), {_ISO}, event_start_date) AS event_start_date, "
     r"coalesce(CAST(try_strptime(regexp_extract(event_dates, '(\d{2}\.\d{2}\.\d{4})$', 1), '%d.%m.%Y') AS DATE), "
     f"{_ISO}, event_end_date) AS event_end_date) FROM {{prev}}) WHERE event_start_date IS NOT NULL"),
    ("parse_performance",
     "SELECT * FROM (SELECT *, "
     f"CASE WHEN regexp_matches(athlete_performance, '\\d+:\\d+:\\d+') THEN TRY_CAST("
     f"TRY_CAST(regexp_extract(athlete_performance, {_HMS}, 1) AS BIGINT) * 3600 + "
     f"TRY_CAST(regexp_extract(athlete_performance, {_HMS}, 2) AS BIGINT) * 60 + "
     f"TRY_CAST(regexp_extract(athlete_performance, {_HMS}, 3) AS BIGINT) AS INTEGER) END AS performance_seconds, "
     f"CASE WHEN regexp_matches(athlete_performance, {_KM}) THEN "
     r"TRY_CAST(regexp_extract(athlete_performance, '(\d+\.?\d*)', 1) AS DOUBLE) END AS performance_km "
     "FROM {prev}) WHERE (performance_seconds > 3600 OR regexp_matches(athlete_performance, "
     f"{_KM})) AND (performance_seconds > 3600 OR performance_km > 0)"),
    ("clean_realistic_performance",
     "SELECT * FROM {prev} WHERE CASE WHEN event_type = 'distance' THEN performance_seconds BETWEEN 3600 AND 216000 "
     "WHEN event_type = 'time' THEN performance_km BETWEEN 1 AND 500 ELSE false END"),
    ("clean_speed",
     "SELECT * REPLACE (coalesce(athlete_average_speed, CAST(0.0 AS DOUBLE)) AS athlete_average_speed) FROM "
     "(SELECT * REPLACE (TRY_CAST(athlete_average_speed AS DOUBLE) AS athlete_average_speed) FROM {prev}) "
     "WHERE athlete_average_speed IS NULL OR athlete_average_speed BETWEEN 2.0 AND 20.8"),
    ("filter_drop_nulls",
     f"SELECT * FROM {{prev}} WHERE athlete_performance IS NOT NULL AND athlete_id IS NOT NULL "
     f"AND athlete_gender IS NOT NULL AND athlete_age_category IS NOT NULL AND {LEN} IS NOT NULL "
     f"AND event_start_date IS NOT NULL AND athlete_year_of_birth IS NOT NULL"),
    ("filter_any_not_null",
     "SELECT * FROM {prev} WHERE performance_seconds IS NOT NULL OR performance_km IS NOT NULL"),
    ("clean_age",
     "SELECT * FROM (SELECT * REPLACE (TRY_CAST(trunc(TRY_CAST(athlete_year_of_birth AS DOUBLE)) AS INTEGER) "
     "AS athlete_year_of_birth) FROM {prev}) "
     "WHERE year(event_start_date) - athlete_year_of_birth BETWEEN 18 AND 100"),
    ("enrich_age_category",
     "SELECT * REPLACE (regexp_replace(athlete_age_category, '^F', 'W') AS athlete_age_category) FROM {prev}"),
    # Hash ids are Spark-only; this step adds nothing comparable.
    ("enrich_surrogate_keys", "SELECT * FROM {prev}"),
    ("enrich_club_names",
     r"SELECT * REPLACE (regexp_replace(athlete_club, '^\*', '') AS athlete_club) FROM {prev}"),
]
STEP_NAMES = [n for n, _ in STEPS]


def chain(upto: str | None = None) -> list[str]:
    """CTE definitions for the feeds and the chain up to ``upto`` (inclusive);
    the last CTE is named ``s_<upto>``, and ``silver`` is always defined
    when the whole chain is requested."""
    ctes = [FEED_MAIN.strip(), FEED_SECOND.strip(), LOOKUP.strip(), FEED]
    prev = "feed"
    for name, body in STEPS:
        ctes.append(f"s_{name} AS ({body.replace('{prev}', prev)})")
        prev = f"s_{name}"
        if name == upto:
            return ctes
    ctes.append(f"silver AS (SELECT * FROM {prev} JOIN country_lookup USING (athlete_country))")
    return ctes


def with_chain(select: str, upto: str | None = None, extra: list[str] | None = None) -> str:
    return "WITH " + ",\n".join(chain(upto) + (extra or [])) + "\n" + select


GOLD = [
    "fact AS (SELECT event_name, athlete_id, performance_seconds, performance_km, "
    "athlete_average_speed AS average_speed, athlete_club AS club, athlete_age_category AS age_category "
    "FROM silver)",
    "dim_event AS (SELECT event_name, MIN(event_type) AS event_type, MIN(year_of_event) AS event_year, "
    "MIN(event_start_date) AS start_date, MIN(event_end_date) AS end_date, "
    f"MIN({LEN}) AS distance, MAX(event_number_of_finishers) AS number_finishers "
    "FROM silver GROUP BY event_name)",
    "dim_athlete AS (SELECT athlete_id, MIN(athlete_country) AS country_code, MIN(country_name) AS country_name, "
    "MIN(athlete_year_of_birth) AS birth_year, MIN(athlete_gender) AS gender FROM silver GROUP BY athlete_id)",
    "dim_date AS (SELECT DISTINCT event_start_date AS date, CAST(year(event_start_date) AS INTEGER) AS year, "
    "CAST(month(event_start_date) AS INTEGER) AS month, CAST(day(event_start_date) AS INTEGER) AS day, "
    "CAST(quarter(event_start_date) AS INTEGER) AS quarter, "
    "CAST(dayofweek(event_start_date) + 1 AS INTEGER) AS day_of_week, "
    "monthname(event_start_date) AS month_name, dayname(event_start_date) AS day_name "
    "FROM silver WHERE event_start_date IS NOT NULL)",
]


def _mart_distance(k: int) -> str:
    return (
        f"mart_distance AS (SELECT f.performance_seconds, "
        f"f.performance_seconds / CAST(3600.0 AS DOUBLE) AS performance_hours, f.average_speed, f.age_category, "
        f"e.event_name, e.distance, e.start_date, e.end_date, e.event_year, e.number_finishers, "
        f"a.athlete_id, a.gender, a.country_name, a.birth_year "
        f"FROM fact f JOIN dim_event e ON f.event_name = e.event_name JOIN dim_athlete a ON f.athlete_id = a.athlete_id "
        f"WHERE e.event_type = 'distance' AND a.country_name IN "
        f"(SELECT country_name FROM dim_athlete GROUP BY country_name HAVING COUNT(*) >= {k}))")


def _mart_time(k: int) -> str:
    return (
        f"mart_time AS (SELECT f.performance_km, f.average_speed, f.age_category, "
        f"e.event_name, e.distance, e.start_date, e.event_year, e.number_finishers, "
        f"a.athlete_id, a.gender, a.country_name, a.birth_year "
        f"FROM fact f JOIN dim_event e ON f.event_name = e.event_name JOIN dim_athlete a ON f.athlete_id = a.athlete_id "
        f"WHERE e.event_type = 'time' AND a.country_name IN "
        f"(SELECT country_name FROM dim_athlete GROUP BY country_name HAVING COUNT(*) >= {k}))")


MART_OVERVIEW = (
    "mart_overview AS (SELECT e.event_name, e.event_type, e.start_date, e.event_year, e.distance, "
    "e.number_finishers, f.performance_seconds, f.performance_km, f.average_speed, f.age_category, "
    "a.athlete_id, a.gender, a.country_name, a.birth_year, d.month_name, d.quarter, d.day_name "
    "FROM fact f JOIN dim_event e ON f.event_name = e.event_name "
    "JOIN dim_athlete a ON f.athlete_id = a.athlete_id JOIN dim_date d ON e.start_date = d.date)")


def gold(select: str, mart_k: int | None = None, overview: bool = False) -> str:
    extra = list(GOLD)
    if mart_k is not None:
        extra += [_mart_distance(mart_k), _mart_time(mart_k)]
    if overview:
        extra.append(MART_OVERVIEW)
    return with_chain(select, None, extra)


def round_half_up(expr: str, digits: int) -> str:
    """Spark's ROUND on a double rounds the shortest decimal text half-up;
    going through a wide decimal gives the same digits here."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"
