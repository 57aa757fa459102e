"""A hot key holding a third of all rows: results stay whole and the joins
split the hot partition instead of sending it to one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from racelake.operators import generate_ids
from racelake.plans.gold import Gold, with_events
from racelake.session import scratch_path
from racelake.sinks import write_layer

N = 30_000


@pytest.fixture()
def skewed_silver(spark):
    hot = F.col("id") % 3 == 0
    df = spark.range(N).select(
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("athlete_id"),
        F.when(hot, F.lit("Hot Ultra")).otherwise(F.concat(F.lit("Race "), (F.col("id") % 50).cast("string")))
         .alias("event_name"),
        F.lit("distance").alias("event_type"),
        F.lit(2019).alias("year_of_event"),
        F.lit(dt.date(2019, 6, 1)).alias("event_start_date"),
        F.lit(dt.date(2019, 6, 2)).alias("event_end_date"),
        F.lit("100km").alias("event_distance/length"),
        F.lit(500).alias("event_number_of_finishers"),
        (F.lit(40000) + F.col("id") % 1000).cast("int").alias("performance_seconds"),
        F.lit(None).cast("double").alias("performance_km"),
        F.lit(7.5).alias("athlete_average_speed"),
        F.lit("Club").alias("athlete_club"),
        F.lit("M40").alias("athlete_age_category"),
        F.lit("C01").alias("athlete_country"),
        F.lit("NATION_1").alias("country_name"),
        F.lit(1970).alias("athlete_year_of_birth"),
        F.lit("M").alias("athlete_gender"),
    )
    return generate_ids(df)


def _final_plan(df) -> str:
    """Run ``df`` and return its explained plan (AQE shows the final plan
    once the query has run)."""
    import contextlib
    import io

    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_keys_keep_all_rows(spark, skewed_silver):
    g = Gold(skewed_silver)
    assert g.dim_athlete.count() == 1 + (N - N // 3)
    assert g.dim_event.count() == 51
    assert g.mart_overview().count() == N
    assert g.mart_distance(1).count() == N


def test_skewed_join_is_split(spark, skewed_silver):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        root = scratch_path(spark, "t-skew-gold")
        g = Gold(skewed_silver, persist=lambda df, name: write_layer(df, f"{root}/{name}"))
        f, a = g.fact.alias("f"), g.dim_athlete.alias("a")
        joined = f.join(a, F.col("f.athlete_id") == F.col("a.athlete_id"))
        plan = _final_plan(joined)
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan, plan
        assert "skew=true" in plan.replace(" ", "").lower(), plan
        assert joined.count() == N
        mart = g.mart_overview()
        assert "skew=true" in _final_plan(mart).replace(" ", "").lower()
        assert mart.count() == N
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_event_is_not_sorted(spark, skewed_silver):
    """A hot event's results stream past the hashed events: no task sorts
    them, whatever their compressed size."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        root = scratch_path(spark, "t-skew-event")
        g = Gold(skewed_silver, persist=lambda df, name: write_layer(df, f"{root}/{name}"))
        joined = with_events(g.fact, g.dim_event)
        plan = _final_plan(joined)
        assert "ShuffledHashJoin" in plan and "Sort" not in plan, plan
        assert joined.count() == N
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
