"""Operator unit tests on small literal rows (FIXTURES.md §2 cases and the
"""

import datetime as dt

from pyspark.sql import functions as F

from racelake.functions import race as R
from racelake.functions import to_snake_case
from racelake.operators import (clean_club_names, drop_null_rows, fill_unknown,
                                filter_athlete_age, filter_athlete_speed,
                                filter_realistic_performance, generate_ids,
                                join_lookup, normalize_age_category,
                                parse_event_dates, parse_event_type,
                                parse_performance, rename_to_snake_case,
                                require_any_not_null, select_by_type,
                                union_by_name, validate_performance_units)
from racelake.operators.joins import semi_join_on_group_count
from racelake.plans.context import Layers
from racelake.plans.profile import distinct_counts
from racelake.plans.reports import event_row
from support import SF0001

LEN = "event_distance/length"


def test_snake_case():
    assert to_snake_case(" Event  Name ") == "event_name"
    assert to_snake_case("Event distance/length") == "event_distance/length"
    assert to_snake_case("Athlete ID") == "athlete_id"


def test_rename_by_position(spark):
    df = spark.createDataFrame([(1, 2)], "`Year of event` int, `Athlete ID` int")
    assert rename_to_snake_case(df).columns == ["year_of_event", "athlete_id"]


def test_validate_units(spark):
    rows = [("50km", "6:21:03 h", True), ("50km", "80 km", False), ("6h", "61.5 km", True),
            ("6h", "6:00:00 h", False), ("6d", "500 km", False), ("50km", None, False),
            (None, "1 km", False), ("173km/2Etappen", "20:00:00 h", True),
            ("100mi", "20:00:00 h", True), ("6 mile", "1:00:00 h", True)]
    df = spark.createDataFrame([(a, b, i) for i, (a, b, _) in enumerate(rows)],
                               f"`{LEN}` string, athlete_performance string, i int")
    kept = {r.i for r in validate_performance_units(df).collect()}
    assert kept == {i for i, r in enumerate(rows) if r[2]}


def test_event_type_first_match_wins(spark):
    df = spark.createDataFrame([("173km/2Etappen",), ("24h",), ("6d",), (None,)], f"`{LEN}` string")
    got = [r.event_type for r in parse_event_type(df).collect()]
    assert got == ["distance", "time", None, None]


def test_event_dates(spark):
    rows = [("21.-22.04.2018", None, dt.date(2018, 4, 21), dt.date(2018, 4, 22)),
            ("17.06.2018", None, dt.date(2018, 6, 17), dt.date(2018, 6, 17)),
            ("30.04.-02.05.2018", None, dt.date(2018, 5, 30), dt.date(2018, 5, 2)),
            ("28.12.2017-01.01.2018", None, dt.date(2017, 12, 28), dt.date(2018, 1, 1)),
            ("31.04.2018", None, None, None),
            ("2024-06-15", None, dt.date(2024, 6, 15), dt.date(2024, 6, 15)),
            ("6.05.2018", None, None, None),
            (None, dt.date(2024, 6, 15), dt.date(2024, 6, 15), dt.date(2024, 6, 15))]
    df = spark.createDataFrame(
        [(i, t, s, s) for i, (t, s, _, _) in enumerate(rows)],
        "i int, event_dates string, event_start_date date, event_end_date date")
    got = {r.i: (r.event_start_date, r.event_end_date) for r in parse_event_dates(df).collect()}
    want = {i: (s, e) for i, (_, _, s, e) in enumerate(rows) if s is not None}
    assert got == want


def test_event_dates_without_existing_columns(spark):
    df = spark.createDataFrame([("17.06.2018",)], "event_dates string")
    r = parse_event_dates(df).collect()[0]
    assert r.event_start_date == dt.date(2018, 6, 17)


def test_performance(spark):
    rows = [("6:21:03 h", 22863, None), ("1:00:00 h", None, None), ("1:00:01 h", 3601, None),
            ("1d 05:30:00 h", 19800, None), ("123.5 km", None, 123.5), ("0 km", None, None),
            ("0:00:00 h", None, None), ("99999999999:00:00 h", None, None)]
    df = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(rows)],
                               "i int, athlete_performance string")
    got = {r.i: (r.performance_seconds, r.performance_km) for r in parse_performance(df).collect()}
    want = {i: (s, k) for i, (_, s, k) in enumerate(rows) if s is not None or k is not None}
    assert got == want


def test_realistic(spark):
    rows = [("distance", 216000, None, True), ("distance", 216001, None, False),
            ("distance", 3600, None, True), ("time", None, 1.0, True), ("time", None, 0.9, False),
            ("time", None, 500.0, True), ("time", None, 500.1, False), (None, 5000, 5.0, False)]
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c, _) in enumerate(rows)],
                               "i int, event_type string, performance_seconds int, performance_km double")
    kept = {r.i for r in filter_realistic_performance(df).collect()}
    assert kept == {i for i, r in enumerate(rows) if r[3]}


def test_speed(spark):
    rows = [("2.0", 2.0), ("20.8", 20.8), ("1.99", None), ("20.81", None), ("18:00:00", 0.0), (None, 0.0)]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)],
                               "i int, athlete_average_speed string")
    got = {r.i: r.athlete_average_speed for r in filter_athlete_speed(df).collect()}
    assert got == {i: v for i, (_, v) in enumerate(rows) if v is not None}


def test_age(spark):
    rows = [(2000.0, True), (2001.0, False), (1918.0, True), (1917.0, False), (None, False)]
    df = spark.createDataFrame([(i, dt.date(2018, 5, 1), b) for i, (b, _) in enumerate(rows)],
                               "i int, event_start_date date, athlete_year_of_birth double")
    out = filter_athlete_age(df)
    assert dict(out.dtypes)["athlete_year_of_birth"] == "int"
    assert {r.i for r in out.collect()} == {i for i, r in enumerate(rows) if r[1]}


def test_age_from_text_year(spark):
    df = spark.createDataFrame([(dt.date(2018, 5, 1), "1978.0")],
                               "event_start_date date, athlete_year_of_birth string")
    assert filter_athlete_age(df).collect()[0].athlete_year_of_birth == 1978


def test_age_category_and_club(spark):
    df = spark.createDataFrame([("F40", "*A"), ("W40", "**A"), ("WU23", "A*"), ("MF40", None)],
                               "athlete_age_category string, athlete_club string")
    out = clean_club_names(normalize_age_category(df)).collect()
    assert [r.athlete_age_category for r in out] == ["W40", "W40", "WU23", "MF40"]
    assert [r.athlete_club for r in out] == ["A", "*A", "A*", None]


def test_fill_unknown_and_nulls(spark):
    df = spark.createDataFrame([(None, 1, None), ("x", None, 2.0)], "a string, b int, c double")
    f = fill_unknown(df, ["a", "b"]).collect()
    assert (f[0].a, f[0].b) == ("Unknown", "1") and f[1].b == "Unknown"
    assert drop_null_rows(df, ["a", "b"]).count() == 0
    assert drop_null_rows(df, ["a"]).count() == 1
    assert require_any_not_null(df, ["b", "c"]).count() == 2


def test_ids_are_content_keys(spark):
    df = spark.createDataFrame([("E", 1), ("E", 1), ("E", 2), ("F", 1)], "event_name string, athlete_id int")
    out = generate_ids(df).collect()
    assert out[0].event_id == out[2].event_id != out[3].event_id
    assert out[0].result_id == out[1].result_id != out[2].result_id
    assert all(r.event_id >= 0 and r.result_id >= 0 for r in out)
    # int and bigint ids hash alike
    df2 = spark.createDataFrame([("E", 1)], "event_name string, athlete_id bigint")
    assert generate_ids(df2).collect()[0].result_id == out[0].result_id


def test_union_by_name_text_clash(spark):
    a = spark.createDataFrame([("18:00:00", 1)], "s string, x int")
    b = spark.createDataFrame([(7.5, dt.date(2024, 1, 1))], "s double, d date")
    out = union_by_name(a, b)
    assert dict(out.dtypes)["s"] == "string"
    assert sorted(r.s for r in out.collect()) == ["18:00:00", "7.5"]
    assert out.filter(F.col("d").isNull()).count() == 1


def test_select_by_type(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "a int, b double, c string, d bigint")
    df = df.withColumn("e", F.col("a").cast("decimal(10,2)"))
    assert select_by_type(df).columns == ["a", "b", "d", "e"]


def test_join_lookup_leaves_the_strategy_to_spark(spark):
    big = spark.range(100).withColumn("k", (F.col("id") % 3).cast("string"))
    lk = spark.createDataFrame([("0", "zero"), ("1", "one")], "k string, name string")
    out = join_lookup(big, lk, "k")
    assert out.count() == 67
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def _explained(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_semi_join_on_group_count(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "c string")
    assert [r.c for r in semi_join_on_group_count(df, df, "c", 2).collect()] == ["A", "A"]


def test_distinct_counts_keep_every_column(spark):
    df = spark.createDataFrame([(1, "x", None), (1, None, None), (2, "x", None)], "a int, b string, c string")
    rows = {r["column_name"]: (r["num_distinct"], r["num_distinct_with_null"])
            for r in distinct_counts(df).collect()}
    assert rows == {"a": (2, 2), "b": (1, 2), "c": (0, 1)}
    empty = distinct_counts(df.limit(0)).collect()
    assert sorted((r["column_name"], r["num_distinct"], r["num_distinct_with_null"]) for r in empty) == [
        ("a", 0, 0), ("b", 0, 0), ("c", 0, 0)]


def test_event_row_is_the_named_event(spark):
    events = spark.createDataFrame([(1, "e", 2001), (2, "f", 2002)], "event_id bigint, event_name string, event_year int")
    assert [tuple(r) for r in event_row(events, "f").collect()] == [("f", 2002)]
    assert event_row(events, "g").collect() == []


def test_dates_equal_the_pattern_parse(spark):
    """One-day texts take a short cut; it must read what the pattern reads."""
    texts = ["21.04.2018", "31.04.2018", "30.04.2018", "29.02.2019", "29.02.2020", "00.01.2018", "01.00.2018",
             "01.13.2018", "01.01.0000", "01.01.0001", "31.12.9999", "32.01.2018", "21.04.2018\n", " 21.04.2018",
             "21.-22.04.2018", "2018-04-21", "2018-02-30", "21/04/2018", "21.04.18", "1.04.20180", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", R.event_start_date("t").cast("string").alias("start"), R.event_end_date("t").cast("string").alias("end"),
        F.try_to_date(F.when(F.col("t").rlike(r"^\d{2}\.\d{2}\.\d{4}$") & (F.length("t") == 10), F.col("t")),
                      "dd.MM.yyyy").cast("string").alias("plain"))
    got = {r.t: r for r in rows.collect()}
    for t in texts[:12]:
        assert got[t].start == got[t].end == got[t].plain, t
    assert got["21.04.2018"].start == got["2018-04-21"].start == "2018-04-21"
    assert (got["21.-22.04.2018"].start, got["21.-22.04.2018"].end) == ("2018-04-21", "2018-04-22")
    assert got["31.04.2018"].start is None and got["01.01.0000"].end == "0000-01-01"
    assert got["21.04.2018\n"].end == "2018-04-21"
    assert all(got[t].start is None for t in ("21/04/2018", "21.04.18", "", None))


def test_feed_texts_are_made_and_matched_once(spark):
    """The first filter stays above the mapping that makes the feed's texts,
    and the time in a performance is matched by one expression."""
    plan = Layers(spark, SF0001).silver._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not [line for line in filters if "l_extendedprice" in line]
    assert plan.count(R.HMS) == 1
