"""Layer-level tests on the driver tables: the cleaning waterfall, gold
invariants, and the streaming restart contract."""

import os

import pytest
from pyspark.sql import functions as F

from racelake.plans import reports as R
from racelake.plans import silver as S
from racelake.plans.context import Layers
from racelake.plans.gold import fct_results
from racelake.session import scratch_path
from racelake.streaming import stream_fact_results

from support import SF0001

# Expected counts at sf0.001 (FIXTURES.md §4).
WATERFALL = {
    "filter_fill_unknown": 7500, "clean_validate_units": 5517, "parse_event_dates": 4781,
    "parse_performance": 4768, "clean_realistic_performance": 4142, "clean_speed": 3547,
    "filter_drop_nulls": 3454, "clean_age": 3071,
}


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF0001)


def test_waterfall(layers):
    for step, n in WATERFALL.items():
        assert S.clean_until(layers.combined, step).count() == n, step
    assert layers.silver.count() == 2866


def test_silver_checksums(layers):
    r = layers.silver.agg(F.sum("performance_seconds").alias("s"), F.sum("performance_km").alias("k"),
                          F.sum("athlete_average_speed").alias("v")).collect()[0]
    assert (r.s, r.k, r.v) == (139205746, 160662.5, 21647.0)


def test_gold_invariants(layers):
    g = layers.gold
    assert g.dim_event.count() == g.dim_event.select("event_id").distinct().count() == 176
    assert g.dim_athlete.count() == g.dim_athlete.select("athlete_id").distinct().count() == 142
    assert g.dim_date.count() == 1124
    d, t, o = g.mart_distance(5).count(), g.mart_time(5).count(), g.mart_overview().count()
    assert (d, t, o) == (1584, 458, 2866)
    assert d + t <= o
    assert g.mart_distance().count() == 0  # 100 athletes per country: none at this scale


def test_gender_share_sums_to_100(layers):
    rows = R.gender_share(layers.gold.mart_distance(5)).collect()
    assert abs(sum(r.percentage for r in rows) - 100.0) <= 0.1 * len(rows)


def test_fact_stream_restart_adds_nothing(spark, layers):
    silver_dir = scratch_path(spark, "t-silver")
    layers.silver.write.parquet(silver_dir)
    sink, ckpt = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    stream_fact_results(spark, silver_dir, sink, ckpt)
    first = spark.read.parquet(sink).count()
    assert first == 2866
    stream_fact_results(spark, silver_dir, sink, ckpt)  # nothing new
    assert spark.read.parquet(sink).count() == first
    layers.silver.limit(10).write.mode("append").parquet(silver_dir)  # 10 new rows
    stream_fact_results(spark, silver_dir, sink, ckpt)
    assert spark.read.parquet(sink).count() == first + 10


def test_landing_feeds_stay_separate(spark):
    from racelake.plans.registry import _landing
    from racelake.streaming import ingest_landing_root

    root = _landing(spark, SF0001)
    assert os.path.isdir(os.path.join(root, "second_feed"))
    out = ingest_landing_root(spark, root, scratch_path(spark, "t-bronze"), scratch_path(spark, "t-bckpt"))
    assert spark.read.parquet(out["raw_results"]).count() == 6000
    assert spark.read.parquet(out["second_feed"]).count() == 1500
    assert spark.read.parquet(out["country_codes"]).count() == 23


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["gender", "avg_speed"]
    assert df.count() == 2


def test_quartiles_equal_exact_percentiles_on_small_fixture(layers):
    """percentile_approx at accuracy 10000 is exact on a 6,000-row table:
    compare with numpy's inverted-CDF percentiles computed by brute force."""
    import numpy as np

    from racelake.plans.profile import numeric_quartiles

    raw = layers.main_raw
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in numeric_quartiles(raw).collect()}
    pdf = raw.select(*[F.col(f"`{c}`") for c in got]).toPandas()
    for c, qs in got.items():
        x = pdf[c].dropna().astype(float).to_numpy()
        want = tuple(float(np.percentile(x, p, method="inverted_cdf")) for p in (25, 50, 75))
        assert qs == want, c


def test_ingest_archives_processed_files(spark, layers):
    import glob

    from racelake import schemas
    from racelake.sources.csv import write_csv
    from racelake.streaming import ingest_csv_stream

    src = scratch_path(spark, "t-land")
    write_csv(layers.main_raw.repartition(3), src)
    sink, ckpt, arch = (scratch_path(spark, n) for n in ("t-sink2", "t-ckpt2", "t-arch"))
    ingest_csv_stream(spark, src, schemas.MAIN_FEED, sink, ckpt, max_files_per_trigger=1,
                      archive_dir=arch)
    assert spark.read.parquet(sink).count() == 6000
    # Processed files are moved to the archive (asynchronously, after commit).
    import time

    for _ in range(50):
        if len(glob.glob(f"{src}/*.csv")) < 3:
            break
        time.sleep(0.2)
    assert len(glob.glob(f"{src}/*.csv")) < 3


def test_streamed_fact_equals_batch_fact(spark, layers):
    silver_dir = scratch_path(spark, "t-silver-eq")
    layers.silver.write.parquet(silver_dir)
    sink, ckpt = scratch_path(spark, "t-sink-eq"), scratch_path(spark, "t-ckpt-eq")
    stream_fact_results(spark, silver_dir, sink, ckpt, max_files_per_trigger=2)
    streamed = spark.read.parquet(sink)
    batch = fct_results(spark.read.parquet(silver_dir))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_streamed_silver_equals_batch_silver(spark, layers):
    """Main rows, second feed and lookup rows arrive in separate runs; after
    each, silver has the batch chain's rows over what is there."""
    from racelake.streaming import silver_results, stream_cleaned_results

    main_dir, second_dir, codes = (scratch_path(spark, n) for n in ("t-bm", "t-bs", "t-bc"))
    sink, ckpt = scratch_path(spark, "t-ss"), scratch_path(spark, "t-sc")
    late = F.pmod(F.xxhash64("athlete_country"), F.lit(2)) == 1
    steps = [(layers.main_raw, layers.second_raw.limit(0), layers.lookup.filter(~late)),
             (None, None, layers.lookup.filter(late)),
             (None, layers.second_raw, None)]
    for new in steps:
        for df, folder in zip(new, (main_dir, second_dir, codes)):
            if df is not None:
                df.write.mode("append").parquet(folder)
        stream_cleaned_results(spark, [main_dir, second_dir], sink, ckpt, max_files_per_trigger=2)
        got = silver_results(spark, sink, spark.read.parquet(codes))
        want = S.clean_results(S.combine_feeds(spark.read.parquet(main_dir), spark.read.parquet(second_dir)),
                               spark.read.parquet(codes)).select(*got.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0
    assert got.count() == layers.silver.count()


def test_marts_do_not_shuffle_by_country(spark, layers):
    """With broadcast off, the marts over a written star are filters."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in (layers.gold.mart_distance(5), layers.gold.mart_time(5)):
            plan = mart._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "country_athletes" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_waterfall_from_one_pass(layers):
    obs = {}
    S.clean_results(layers.combined, layers.lookup, observations=obs).write.format("noop").mode("overwrite").save()
    got = {k: v.get["rows"] for k, v in obs.items()}
    assert {k: got[k] for k in WATERFALL} == WATERFALL
    assert got["join_country_lookup"] == 2866


def test_refresh_from_csv_landing(spark, layers):
    from racelake.plans.layers import refresh_layers
    from racelake.plans.registry import _landing

    landing, out = _landing(spark, SF0001), scratch_path(spark, "t-refresh")
    t = refresh_layers(spark, landing, out, min_athletes=5)
    assert t["silver/results"].count() == 2866
    assert t["gold/mart_overview"].count() == 2866
    assert t["gold/mart_distance_events"].count() == 1584
    assert t["gold/fct_results"].count() == 2866
    t2 = refresh_layers(spark, landing, out, min_athletes=5)  # no new files
    assert t2["bronze/raw_results"].count() == 6000
    assert t2["silver/results"].count() == 2866
    assert t2["gold/fct_results"].count() == 2866
    # A new file in the landing root: only its rows flow through.
    from racelake.sources.csv import write_csv

    extra = scratch_path(spark, "t-extra")
    write_csv(layers.main_raw.orderBy("Athlete ID", "Event name", "Event dates").limit(500), extra)
    import glob
    import shutil

    new_file = glob.glob(f"{extra}/*.csv")[0]
    shutil.copy(new_file, f"{landing}/part-extra.csv")
    t3 = refresh_layers(spark, landing, out, min_athletes=5)
    added = S.clean_results(S.combine_feeds(spark.read.option("header", True).schema(
        t3["bronze/raw_results"].schema).csv(new_file)), layers.lookup).count()
    assert t3["bronze/raw_results"].count() == 6500
    assert t3["silver/results"].count() == 2866 + added
    assert t3["gold/fct_results"].count() == 2866 + added
    assert t3["gold/mart_overview"].count() == 2866 + added


def test_sf01_layers_match_fixture_numbers(spark):
    """FIXTURES.md §4, sf0.1 column: the marts at the reference's threshold
    of 100 athletes per country, dimension sizes, silver checksums."""
    from racelake.plans.layers import build_layers

    t = build_layers(spark, "/root/testdata/sf0.1", scratch_path(spark, "t-sf01"))
    r = t["silver/results"].agg(F.count(F.lit(1)).alias("n"), F.sum("performance_seconds").alias("s"),
                                F.sum("performance_km").alias("k"),
                                F.sum("athlete_average_speed").alias("v")).collect()[0]
    assert (r.n, r.s, r.k, r.v) == (302727, 15159766377, 17728575.0, 2153233.0)
    assert t["gold/dim_event"].count() == 17497
    assert t["gold/dim_athlete"].count() == 13815
    assert t["gold/dim_date"].count() == 2500
    assert t["gold/mart_distance_events"].count() == 233263
    assert t["gold/mart_time_events"].count() == 69464
    assert t["gold/mart_overview"].count() == 302727
