"""Bitmap counts, exact quartiles, day-aware forms, co-located joins and the
stream's waterfall."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from racelake.functions import race
from racelake.functions.bitmaps import distinct_ids, id_bitmaps, merge_bitmaps
from racelake.plans import gold as G
from racelake.plans import profile as P
from racelake.plans import reports as R
from racelake.plans.colocated import colocated_star, write_colocated
from racelake.session import scratch_path
from racelake.sources.tables import ensure_databases


def test_bitmaps_count_like_sets_and_merge(spark):
    rng = random.Random(1)
    ids = [None, 0, -1, 1, 32767, 32768, 32769, -32768, 2**40] + [rng.randrange(-10**5, 10**5) for _ in range(500)]
    rows = [(rng.choice("ab"), i) for i in ids for _ in range(rng.randint(1, 3))]
    df = spark.createDataFrame(rows, "g string, id bigint").repartition(3)
    want = {g: len({i for h, i in rows if h == g and i is not None}) for g in "ab"}
    state = id_bitmaps(df, "id", ["g"])
    assert {r.g: r.n for r in state.groupBy("g").agg(distinct_ids().alias("n")).collect()} == want
    odd = id_bitmaps(df.filter("id % 2 <> 0 OR id IS NULL"), "id", ["g"])
    merged = merge_bitmaps(odd, id_bitmaps(df.filter("id % 3 <> 0 OR id % 2 = 0"), "id", ["g"]), by=["g"])
    assert {r.g: r.n for r in merged.groupBy("g").agg(distinct_ids().alias("n")).collect()} == want
    assert id_bitmaps(df.limit(0), "id").agg(distinct_ids().alias("n")).first().n == 0


def test_kpis_count_without_multiplying_rows(spark):
    rows = [(1, "A", "x"), (1, "A", "x"), (2, "B", None), (None, None, "y"), (3, None, "x")]
    df = spark.createDataFrame(rows, "athlete_id bigint, event_name string, country_name string")
    out = R.kpis(df)
    assert tuple(out.first()) == (5, 3, 2, 2)
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert tuple(R.kpis(df.limit(0)).first()) == (0, 0, 0, 0)


def test_quartiles_are_exact_on_any_distribution(spark):
    rng = random.Random(7)
    n = 3000
    cols = {
        "even": [rng.uniform(-5, 5) for _ in range(n)],
        "ties": [float(rng.randint(0, 3)) for _ in range(n)],
        "steep": [math.exp(rng.uniform(-600, 600)) for _ in range(n)],
        "wide": [rng.choice([-1.7e308, 1.7e308, 0.0, 1e-300]) for _ in range(n)],
        "gaps": [None if rng.random() < 0.5 else rng.gauss(0, 1) for _ in range(n)],
        "none": [None] * n, "one": [4.5] * n,
        "odd": [math.nan if rng.random() < 0.3 else rng.random() for _ in range(n)],
    }
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in P.numeric_quartiles(df).collect()}
    for c, values in cols.items():
        x = sorted(v for v in values if v is not None and not math.isnan(v))
        assert got[c] == tuple(x[math.ceil(q * len(x)) - 1] if x else None for q in (0.25, 0.5, 0.75)), c
    assert [r.p50 for r in P.numeric_quartiles(df.limit(0).select("even")).collect()] == [None]


def test_days_and_cross_month_ranges_as_options(spark):
    texts = ["1d 05:30:00 h", "5:30:00 h", "12 days 1:00:00 h", "2d", "1:00:00 1d h", "99999999999d 1:00:00 h", None, "3d 0:00:01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(race.performance_seconds("t"), race.performance_seconds_with_days("t")).collect()]
    assert got == [(19800, 106200), (19800, 19800), (3600, 3600 + 12 * 86400), (None, None), (3600, 3600),
                   (3600, None), (None, None), (1, 3 * 86400 + 1)]
    d = dt.date
    cases = {
        "30.04.-02.05.2018": (d(2018, 4, 30), d(2018, 5, 2)), "30.12.-02.01.2018": (d(2017, 12, 30), d(2018, 1, 2)),
        "28.12.2017-01.01.2018": (d(2017, 12, 28), d(2018, 1, 1)), "21.-22.04.2018": (d(2018, 4, 21), d(2018, 4, 22)),
        "17.06.2018": (d(2018, 6, 17), d(2018, 6, 17)), "2024-06-15": (d(2024, 6, 15), d(2024, 6, 15)),
        "31.04.-02.05.2018": (None, d(2018, 5, 2)), "01.05.-02.05.2018": (d(2018, 5, 1), d(2018, 5, 2)), None: (None, None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    rows = df.select("t", *race.range_dates("t"), race.event_start_date("t")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == cases
    assert {r[0]: r[3] for r in rows}["30.04.-02.05.2018"] == d(2018, 5, 30)  # the default is unchanged


def test_unmatched_and_matched_add_up(spark):
    from racelake.operators.joins import join_lookup

    rows = spark.createDataFrame([(1, "A"), (2, "A"), (2, "X"), (2, "X"), (3, "X"), (4, None), (5, "Y")],
                                 "athlete_id bigint, athlete_country string")
    lookup = spark.createDataFrame([("A", "Aland")], "athlete_country string, country_name string")
    lost = {r.athlete_country: (r.num_results, r.num_athletes) for r in R.unmatched_countries(rows, lookup).collect()}
    assert lost == {"X": (3, 2), "Y": (1, 1), None: (1, 1)}
    assert sum(n for n, _ in lost.values()) + join_lookup(rows, lookup, "athlete_country").count() == rows.count()


def test_colocated_join_moves_neither_side(spark):
    fact = spark.range(4000).select(
        F.col("id").alias("result_id"), (F.col("id") % 7).alias("event_id"), (F.col("id") % 300).alias("athlete_id"),
        F.lit(4000).alias("performance_seconds"), F.lit(1.0).alias("performance_km"), F.lit(8.0).alias("average_speed"),
        F.lit("M40").alias("age_category"))
    events = spark.range(7).select(
        F.col("id").alias("event_id"), F.col("id").cast("string").alias("event_name"), F.lit("distance").alias("event_type"),
        F.lit("50km").alias("distance"), F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(2018).alias("event_year"), F.lit(9).alias("number_finishers"))
    athletes = spark.range(300).select(F.col("id").alias("athlete_id"), F.lit("M").alias("gender"),
                                       F.concat(F.lit("c"), F.col("id") % 2).alias("country_name"), F.lit(1980).alias("birth_year"))
    ensure_databases(spark, ["t_star"], scratch_path(spark, "t-star"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        write_colocated(fact, events, athletes, "t_star", buckets=4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        star = colocated_star(spark, "t_star")
        mart = G.mart_distance_events(None, None, None, 100, star=star)
        for df in (star, mart):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        want = G.star_results(fact, events, athletes)
        assert star.exceptAll(want.select(*star.columns)).count() == 0 and star.count() == want.count() == 4000
        assert mart.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.sql("DROP DATABASE t_star CASCADE")
