"""Benchmark: build the layers, then run the report queries on them.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. ``queries`` holds seconds per step: the layer builds
(``build_*``: bronze feeds, silver, each gold table and mart, all written as
parquet) and every report / check / profile query over the written layers,
each forced to run in full with the ``noop`` sink (no driver collect).
``value`` is the sum. Before timing, the same layer build runs once on the
smallest table set (untimed) so JVM class loading and code generation are
not charged to the first measured step.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from racelake.session import get_spark, scratch_path
    from racelake.plans import profile as P
    from racelake.plans import reports as R
    from racelake.plans.gold import MIN_ATHLETES_PER_COUNTRY
    from racelake.plans.layers import build_layers

    spark = get_spark(
        master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
        extra_conf={"spark.ui.showConsoleProgress": "false",
                    "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        build_layers(spark, warm_dir, scratch_path(spark, "bench-warmup"), 5)

    build: dict[str, float] = {}
    out = scratch_path(spark, "bench-layers")
    t = build_layers(spark, sf_dir, out, MIN_ATHLETES_PER_COUNTRY, timings=build)

    fact, ev, ath = t["gold/fct_results"], t["gold/dim_event"], t["gold/dim_athlete"]
    dist, tim, ov = (t["gold/mart_distance_events"], t["gold/mart_time_events"],
                     t["gold/mart_overview"])
    raw = t["bronze/raw_results"]
    queries = {
        "q1_athletes_by_country": lambda: R.athletes_by_country(dist),
        "q2_gender_share": lambda: R.gender_share(dist),
        "q3_events_by_year": lambda: R.events_by_year(dist),
        "q4_max_finishers": lambda: R.max_finishers(ov),
        "q5_speed_by_gender": lambda: R.speed_by_gender(dist),
        "q6_popular_events": lambda: R.popular_events(ov),
        "q6b_finisher_sum": lambda: R.finisher_sum(dist),
        "check_metric_coverage": lambda: R.metric_coverage(fact),
        "check_min_max_by_type": lambda: R.min_max_by_type(fact, ev),
        "check_speed_by_country": lambda: R.speed_by_country(fact, ath),
        "check_results_by_year_type": lambda: R.results_by_year_type(fact, ev),
        "check_gender_by_type": lambda: R.gender_by_type(fact, ath, ev),
        "check_hours_by_age_category": lambda: R.hours_by_age_category(fact, ath),
        "check_duplicate_keys": lambda: R.duplicate_keys(ath, "athlete_id"),
        "rpt_kpis": lambda: R.kpis(ov),
        "rpt_top_countries": lambda: R.top_countries(ov),
        "rpt_distance_by_age": lambda: R.average_by(dist, "age_category", "performance_hours", "avg_hours"),
        "rpt_time_by_country": lambda: R.average_by(tim, "country_name", "performance_km", "avg_km"),
        "profile_null_counts": lambda: P.null_counts(raw),
        "profile_distinct_counts": lambda: P.distinct_counts(raw),
        "profile_numeric_summary": lambda: P.numeric_summary(raw),
    }
    timings = {f"build_{k}": v for k, v in build.items()}
    for name, make in queries.items():
        t0 = time.time()
        make().write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    total = round(sum(timings.values()), 3)
    # Table sizes (parquet footers; not timed) to read the timings against.
    rows = {name.split("/")[-1]: t[name].count() for name in
            ("bronze/raw_results", "silver/results", "gold/fct_results", "gold/dim_athlete",
             "gold/dim_event", "gold/mart_overview")}
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    silver_rate = round(rows["raw_results"] / max(build.get("silver_results", 0), 1e-9))
    print(json.dumps({"metric": "layers_build_plus_reports_total", "value": total,
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus,
                      "rows": rows, "silver_raw_rows_per_sec": silver_rate}))


if __name__ == "__main__":
    main()
