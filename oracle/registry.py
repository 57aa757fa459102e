"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from oracle.duckdb_sql import STEP_NAMES, gold, round_half_up, with_chain

K100, K50 = 100, 50
SPOILT_EVERY = 97
SLICE_COUNTRY, SLICE_YEARS = "NATION_7", (1995, 2020)
PROBE_EVENT, PROBE_TEXT = "Trail Classic (C07)", "C07"

# Raw feed names (snake name, raw name, Spark type name) in file order.
RAW = [
    ("year_of_event", "Year of event", "int"),
    ("event_dates", "Event dates", "string"),
    ("event_name", "Event name", "string"),
    ("event_distance/length", "Event distance/length", "string"),
    ("event_number_of_finishers", "Event number of finishers", "int"),
    ("athlete_performance", "Athlete performance", "string"),
    ("athlete_club", "Athlete club", "string"),
    ("athlete_country", "Athlete country", "string"),
    ("athlete_year_of_birth", "Athlete year of birth", "double"),
    ("athlete_gender", "Athlete gender", "string"),
    ("athlete_age_category", "Athlete age category", "string"),
    ("athlete_average_speed", "Athlete average speed", "string"),
    ("athlete_id", "Athlete ID", "bigint"),
]
RAW_SELECT = ", ".join(f'"{s}" AS "{r}"' for s, r, _ in RAW)
RAW_CTE = f"raw_main AS (SELECT {RAW_SELECT} FROM feed_main)"


def _raw(select: str) -> str:
    return with_chain(select, "filter_fill_unknown", [RAW_CTE])


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _unit_verdict(length: str, perf: str) -> str:
    return (f"CASE WHEN regexp_matches({length}, 'km|mi|mile') THEN ends_with({perf}, 'h') "
            f"WHEN regexp_matches({length}, 'h') THEN ends_with({perf}, 'km') ELSE false END")


def _avg(expr: str, digits: int) -> str:
    return round_half_up(f"AVG({expr})", digits)


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}

    # Sources and sinks
    o["src_stream_csv"] = _raw("SELECT * FROM raw_main")
    o["src_batch_csv"] = _raw("SELECT * FROM raw_main")
    o["src_table_scan"] = _raw("SELECT * FROM raw_main")
    # What Spark infers from the landing CSV: integers stay int while they
    # fit, whole doubles keep their point, mixed texts are strings.
    inferred = {"int": "int", "bigint": "int", "double": "double", "string": "string"}
    o["src_infer_schema"] = "SELECT * FROM (VALUES " + ", ".join(
        f"({_sql_str(r)}, {i + 1}, {_sql_str(inferred[t])})" for i, (_, r, t) in enumerate(RAW)
    ) + ") v(column_name, ordinal, data_type)"
    o["meta_list_files"] = _raw("SELECT COUNT(*) AS listed_records, 0 AS other_records, true AS sizes_agree FROM raw_main")
    inventory = [
        ("racelake_bronze", "raw_results", "Raw results feed - bronze layer", "feed_main"),
        ("racelake_bronze", "second_feed", "Second results feed - bronze layer", "feed_second"),
        ("racelake_bronze", "country_codes", "Country code lookup - bronze layer", "country_lookup"),
        ("racelake_silver", "results", "Cleaned and validated one big table - silver layer", "silver"),
        ("racelake_gold", "fct_results", "Fact table - gold layer", "fact"),
        ("racelake_gold", "dim_event", "Dim event - gold layer", "dim_event"),
        ("racelake_gold", "dim_athlete", "Dim athlete - gold layer", "dim_athlete"),
        ("racelake_gold", "dim_date", "Dim date - gold layer", "dim_date"),
    ]
    o["meta_catalog_tables"] = gold(" UNION ALL ".join(
        f"SELECT {_sql_str(db)} AS database, {_sql_str(t)} AS table_name, {_sql_str(c)} AS comment, "
        f"COUNT(*) AS num_rows FROM {src}" for db, t, c, src in inventory))

    o["meta_list_schemas"] = gold(
        "SELECT 'spark_catalog' AS catalog, database AS schema, COUNT(*) AS num_tables, "
        "CAST(SUM(num_rows) AS BIGINT) AS num_rows FROM (" + " UNION ALL ".join(
            f"SELECT {_sql_str(db)} AS database, COUNT(*) AS num_rows FROM {src}"
            for db, _t, _c, src in inventory) + ") GROUP BY database")
    channels = _raw(
        "SELECT 'accepted' AS channel, CAST(NULL AS VARCHAR) AS reason, COUNT(*) AS num_rows FROM raw_main "
        f'WHERE "Athlete ID" % {SPOILT_EVERY} <> 0 UNION ALL '
        f"SELECT 'quarantine', 'record', COUNT(*) FROM raw_main WHERE \"Athlete ID\" % {SPOILT_EVERY} = 0 UNION ALL "
        "SELECT 'quarantine', 'header', COUNT(*) FROM feed_second")
    o["src_quarantine"] = o["src_quarantine_stream"] = channels

    # Shaping and set operations
    o["shape_snake_case"] = with_chain("SELECT * FROM feed_main", "filter_fill_unknown")
    o["setop_union_by_name"] = with_chain("SELECT * FROM feed", "filter_fill_unknown")

    # Silver chain
    for name in STEP_NAMES:
        o[name] = with_chain(f"SELECT * FROM s_{name}", name)
    o["enrich_surrogate_keys"] = with_chain(
        "SELECT COUNT(*) AS num_rows, COUNT(DISTINCT event_name) AS num_event_ids, "
        "COUNT(DISTINCT (event_name, athlete_id)) AS num_result_ids, "
        "COUNT(DISTINCT event_name) AS num_event_names, "
        "COUNT(DISTINCT (event_name, athlete_id)) AS num_event_athletes, true AS ids_non_negative "
        "FROM s_enrich_surrogate_keys", "enrich_surrogate_keys")
    o["join_country_lookup"] = with_chain("SELECT * FROM silver")
    o["silver_obt"] = with_chain("SELECT * FROM silver")
    o["silver_stream"] = with_chain("SELECT * FROM silver")
    verdict = _unit_verdict('"Event distance/length"', '"Athlete performance"')
    o["audit_unit_validity"] = _raw(
        f"SELECT {verdict} AS is_valid, COUNT(*) AS count FROM raw_main GROUP BY 1")
    o["audit_rejected_units"] = _raw(
        f'SELECT "Event distance/length", "Athlete performance" FROM raw_main '
        f"WHERE NOT coalesce({verdict}, false) "
        f'ORDER BY "Event distance/length" NULLS FIRST, "Athlete performance" NULLS FIRST LIMIT 20')

    o["audit_unmatched_countries"] = with_chain(
        "SELECT athlete_country, COUNT(*) AS num_results, COUNT(DISTINCT athlete_id) AS num_athletes "
        f"FROM s_{STEP_NAMES[-1]} ANTI JOIN country_lookup USING (athlete_country) GROUP BY athlete_country")
    o["parse_days_and_ranges"] = """
        WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS a,
                CAST(l_shipdate AS DATE) + CAST(l_orderkey % 40 AS INTEGER) AS b,
                CAST(floor(l_extendedprice * 2.5) AS BIGINT) AS s, l_linenumber % 4 AS days FROM lineitem),
        r AS (SELECT *, l_linenumber % 2 = 1 AS named FROM t)
        SELECT l_orderkey, l_linenumber,
            CASE WHEN named THEN strftime(a, '%d.%m.%Y-') ELSE strftime(a, '%d.%m.-') END
                || strftime(b, '%d.%m.%Y') AS dates,
            CASE WHEN days > 0 THEN days || 'd ' ELSE '' END
                || printf('%02d:%02d:%02d h', s // 3600, s // 60 % 60, s % 60) AS performance,
            CAST(s AS INTEGER) AS seconds, CAST(s + 86400 * days AS INTEGER) AS seconds_with_days,
            CASE WHEN named THEN a ELSE CAST(try_strptime(strftime(a, '%d.') || strftime(b, '%m.%Y'), '%d.%m.%Y') AS DATE)
                END AS start_date, a AS range_start, b AS range_end FROM r"""

    o["waterfall_stream"] = with_chain(" UNION ALL ".join(
        f"SELECT {_sql_str(n)} AS step, COUNT(*) AS num_rows FROM s_{n}" for n in STEP_NAMES), STEP_NAMES[-1])

    # Gold
    o["fct_results"] = gold("SELECT * FROM fact")
    o["fct_results_stream"] = gold("SELECT * FROM fact")
    o["fct_results_refresh"] = o["fct_results"]
    o["dim_athlete"] = o["dim_athlete_refresh"] = gold("SELECT * FROM dim_athlete")
    o["dim_event"] = o["dim_event_refresh"] = gold("SELECT * FROM dim_event")
    o["dim_date"] = gold("SELECT * FROM dim_date")
    o["mart_distance_events"] = o["mart_distance_colocated"] = gold("SELECT * FROM mart_distance", K100)
    o["mart_time_events"] = gold("SELECT * FROM mart_time", K100)
    o["mart_distance_events_min50"] = gold("SELECT * FROM mart_distance", K50)
    o["mart_time_events_min50"] = gold("SELECT * FROM mart_time", K50)
    o["mart_overview"] = gold("SELECT * FROM mart_overview", None, True)
    o["join_semi_having"] = gold(
        "SELECT * FROM dim_athlete WHERE country_name IN (SELECT country_name FROM dim_athlete "
        f"GROUP BY country_name HAVING COUNT(*) >= {K100})")

    # Business questions
    for suffix, k in (("", K100), ("_min50", K50)):
        o["q1_athletes_by_country" + suffix] = gold(
            "SELECT country_name, COUNT(DISTINCT athlete_id) AS num_athletes FROM mart_distance "
            "WHERE country_name IS NOT NULL GROUP BY country_name "
            "ORDER BY num_athletes DESC, country_name LIMIT 5", k)
        o["q2_gender_share" + suffix] = gold(
            "SELECT gender, n AS num_athletes, "
            "CAST((n * 1000 * 2 + SUM(n) OVER ()) // (2 * SUM(n) OVER ()) AS DOUBLE) / 10 AS percentage "
            "FROM (SELECT gender, COUNT(DISTINCT athlete_id) AS n FROM mart_distance "
            "WHERE gender IS NOT NULL GROUP BY gender)", k)
        o["q3_events_by_year" + suffix] = gold(
            "SELECT event_year, COUNT(DISTINCT event_name) AS num_events FROM mart_distance "
            "WHERE event_year IS NOT NULL GROUP BY event_year "
            "ORDER BY num_events DESC, event_year LIMIT 10", k)
        o["q5_speed_by_gender" + suffix] = gold(
            f"SELECT gender, {_avg('average_speed', 2)} AS avg_speed FROM mart_distance "
            "WHERE average_speed > 0 GROUP BY gender", k)
        o["q6b_finisher_sum" + suffix] = gold(
            "SELECT event_name, CAST(SUM(number_finishers) AS BIGINT) AS total_participants, "
            "COUNT(DISTINCT event_year) AS years_held, "
            f"{_avg('number_finishers', 0)} AS avg_participants_per_year "
            "FROM mart_distance WHERE event_name IS NOT NULL AND number_finishers IS NOT NULL "
            "GROUP BY event_name ORDER BY total_participants DESC, event_name LIMIT 10", k)
        for key in ("country_name", "age_category"):
            tail = "country" if key == "country_name" else "age"
            o[f"rpt_distance_by_{tail}{suffix}"] = gold(
                f"SELECT {key}, {_avg('performance_hours', 2)} AS avg_hours, COUNT(*) AS num_results "
                f"FROM mart_distance GROUP BY {key}", k)
            o[f"rpt_time_by_{tail}{suffix}"] = gold(
                f"SELECT {key}, {_avg('performance_km', 2)} AS avg_km, COUNT(*) AS num_results "
                f"FROM mart_time GROUP BY {key}", k)
    o["q4_max_finishers"] = gold(
        "SELECT event_name, MAX(number_finishers) AS finishers FROM mart_overview "
        "GROUP BY event_name ORDER BY finishers DESC, event_name LIMIT 5", None, True)
    o["q6_popular_events"] = gold(
        "SELECT event_name, unique_participants FROM (SELECT event_name, event_type, "
        "COUNT(DISTINCT athlete_id) AS unique_participants FROM mart_overview GROUP BY event_name, event_type "
        "ORDER BY unique_participants DESC, event_name, event_type LIMIT 10)", None, True)
    o["rpt_kpis"] = gold(
        "SELECT COUNT(*) AS num_results, COUNT(DISTINCT athlete_id) AS num_athletes, "
        "COUNT(DISTINCT event_name) AS num_events, COUNT(DISTINCT country_name) AS num_countries "
        "FROM mart_overview", None, True)
    o["rpt_growth"] = gold(
        "SELECT event_year, COUNT(*) AS num_results FROM mart_overview GROUP BY event_year", None, True)
    o["rpt_gender_distribution"] = gold(
        "SELECT gender, COUNT(DISTINCT athlete_id) AS num_athletes, COUNT(*) AS num_results "
        "FROM mart_overview GROUP BY gender", None, True)
    o["rpt_top_countries"] = gold(
        "SELECT country_name, COUNT(DISTINCT athlete_id) AS num_athletes, COUNT(*) AS num_results "
        "FROM mart_overview GROUP BY country_name ORDER BY num_athletes DESC, country_name LIMIT 10",
        None, True)

    # Sanity checks
    o["check_layer_row_counts"] = gold(
        "SELECT 'fct_results' AS table_name, COUNT(*) AS num_rows FROM fact UNION ALL "
        "SELECT 'dim_event', COUNT(*) FROM dim_event UNION ALL "
        "SELECT 'dim_athlete', COUNT(*) FROM dim_athlete UNION ALL "
        "SELECT 'dim_date', COUNT(*) FROM dim_date")
    o["check_metric_coverage"] = gold(
        "SELECT COUNT(*) AS total, COUNT(performance_seconds) AS seconds_count, "
        "COUNT(performance_km) AS km_count, "
        "CAST(SUM(CASE WHEN performance_seconds = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_seconds FROM fact")
    o["check_min_max_by_type"] = gold(
        "SELECT e.event_type, MIN(f.performance_seconds) AS min_seconds, "
        "MAX(f.performance_seconds) AS max_seconds FROM fact f "
        "LEFT JOIN dim_event e ON e.event_name = f.event_name "
        "WHERE f.performance_seconds > 0 GROUP BY e.event_type")
    o["check_speed_by_country"] = gold(
        f"SELECT a.country_name, {_avg('f.average_speed', 2)} AS avg_speed "
        "FROM fact f JOIN dim_athlete a USING (athlete_id) GROUP BY a.country_name "
        "ORDER BY avg_speed DESC, country_name LIMIT 20")
    o["check_results_by_year_type"] = gold(
        "SELECT e.event_year, e.event_type, COUNT(*) AS num_results "
        "FROM fact f JOIN dim_event e USING (event_name) GROUP BY e.event_year, e.event_type")
    o["check_gender_by_type"] = gold(
        "SELECT e.event_type, a.gender, COUNT(*) AS num_athletes FROM fact f "
        "JOIN dim_athlete a USING (athlete_id) JOIN dim_event e USING (event_name) "
        "GROUP BY e.event_type, a.gender")
    lo, hi = SLICE_YEARS
    o["gold_country_year_slice"] = gold(
        "SELECT a.athlete_id, f.age_category, a.birth_year, f.club, a.gender, e.event_name, e.event_type, "
        "e.event_year, e.start_date, e.end_date, e.distance, f.performance_seconds, f.performance_km, "
        "f.average_speed FROM dim_athlete a LEFT JOIN fact f ON a.athlete_id = f.athlete_id "
        "LEFT JOIN dim_event e ON f.event_name = e.event_name "
        f"WHERE a.country_name = {_sql_str(SLICE_COUNTRY)} AND e.event_year BETWEEN {lo} AND {hi}")
    o["check_hours_by_age_category"] = gold(
        "SELECT f.age_category, COUNT(*) AS total_rows, "
        f"{_avg('f.performance_seconds / CAST(3600.0 AS DOUBLE)', 4)} AS avg_performance_hours "
        "FROM dim_athlete a JOIN fact f ON a.athlete_id = f.athlete_id GROUP BY f.age_category")
    o["filter_like_distinct"] = with_chain(
        f"SELECT DISTINCT event_name FROM silver WHERE event_name LIKE {_sql_str('%' + PROBE_TEXT + '%')}")
    o["check_event_dim_row"] = gold(
        "SELECT event_name, event_type, event_year, start_date, end_date, distance, number_finishers "
        f"FROM dim_event WHERE event_name = {_sql_str(PROBE_EVENT)}")
    o["check_event_in_gold"] = gold(
        "SELECT f.athlete_id, f.performance_seconds, f.performance_km, f.average_speed, f.club, "
        "f.age_category, e.event_name, e.event_type, e.event_year, e.start_date, e.end_date, e.distance, "
        "e.number_finishers FROM fact f JOIN dim_event e ON f.event_name = e.event_name "
        f"WHERE e.event_name = {_sql_str(PROBE_EVENT)} ORDER BY f.athlete_id, f.performance_seconds, "
        "f.performance_km, f.average_speed, f.club, f.age_category LIMIT 5")
    o["check_duplicate_keys"] = gold(
        "SELECT athlete_id, COUNT(*) AS num_rows FROM dim_athlete GROUP BY athlete_id "
        "HAVING COUNT(*) > 1 ORDER BY athlete_id LIMIT 10")
    o["check_duplicate_results"] = gold(
        "SELECT event_name, athlete_id, COUNT(*) AS num_rows FROM fact GROUP BY event_name, athlete_id "
        "HAVING COUNT(*) > 1 ORDER BY num_rows DESC, event_name, athlete_id LIMIT 10")
    o["check_distinct_clubs"] = gold("SELECT DISTINCT club FROM fact")

    # Profiling of the raw feed
    n = len(RAW)
    values = ", ".join(f"({_sql_str(r)}, {i + 1}, {_sql_str(t)})" for i, (_, r, t) in enumerate(RAW))
    o["profile_shape"] = _raw(
        f"SELECT (SELECT COUNT(*) FROM raw_main) AS num_rows, {n} AS num_columns, "
        f"v.column_name, v.ordinal, v.data_type "
        f"FROM (VALUES {values}) v(column_name, ordinal, data_type)")
    nulls = " UNION ALL ".join(
        f"SELECT {_sql_str(r)} AS column_name, {i + 1} AS ordinal, "
        f'COUNT(*) FILTER (WHERE "{r}" IS NULL) AS nulls FROM raw_main' for i, (_, r, _t) in enumerate(RAW))
    o["profile_null_counts"] = _raw(f"SELECT * FROM ({nulls}) WHERE nulls > 0")
    distinct = " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, {_sql_str(r)} AS column_name, "
        f'COUNT(DISTINCT "{r}") AS num_distinct, COUNT(DISTINCT "{r}") + '
        f'CAST(COUNT(*) > COUNT("{r}") AS BIGINT) AS num_distinct_with_null FROM raw_main'
        for i, (_, r, _t) in enumerate(RAW))
    o["profile_distinct_counts"] = _raw(distinct)
    o["profile_distinct_values"] = _raw('SELECT DISTINCT "Event name" FROM raw_main')
    numeric = [(i, r) for i, (_, r, t) in enumerate(RAW) if t in ("int", "bigint", "double")]
    summary = " UNION ALL ".join(
        f"SELECT {_sql_str(r)} AS column_name, {j + 1} AS ordinal, "
        f'CAST(COUNT("{r}") AS BIGINT) AS count, '
        f'{round_half_up(f"AVG(CAST({chr(34)}{r}{chr(34)} AS DOUBLE))", 6)} AS mean, '
        f'{round_half_up(f"STDDEV_SAMP(CAST({chr(34)}{r}{chr(34)} AS DOUBLE))", 6)} AS stddev, '
        f'CAST(MIN("{r}") AS DOUBLE) AS min, CAST(MAX("{r}") AS DOUBLE) AS max FROM raw_main'
        for j, (_i, r) in enumerate(numeric))
    o["profile_numeric_summary"] = _raw(summary)
    quartiles = " UNION ALL ".join(
        f"SELECT {_sql_str(r)} AS column_name, {j + 1} AS ordinal, " + ", ".join(
            f'CAST(quantile_disc("{r}", {q}) AS DOUBLE) AS p{round(100 * q)}' for q in (0.25, 0.5, 0.75))
        + " FROM raw_main" for j, (_i, r) in enumerate(numeric))
    o["profile_quartiles"] = _raw(quartiles)
    o["profile_preview"] = _raw(
        'SELECT * FROM raw_main ORDER BY "Athlete ID" NULLS FIRST, "Event name" NULLS FIRST, '
        '"Event dates" NULLS FIRST, "Athlete performance" NULLS FIRST, '
        '"Athlete average speed" NULLS FIRST, "Athlete age category" NULLS FIRST, '
        '"Event number of finishers" NULLS FIRST LIMIT 10')
    o["agg_count_by_key"] = _raw(
        'SELECT "Athlete age category", COUNT(*) AS count FROM raw_main GROUP BY 1')
    o["topk_countries"] = _raw(
        'SELECT "Athlete country", COUNT(*) AS count FROM raw_main GROUP BY 1 '
        'ORDER BY count DESC, "Athlete country" NULLS FIRST LIMIT 20')
    return o


ORACLE: dict[str, str] = _oracle()
