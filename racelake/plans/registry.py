"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator or report.

Every query reads the driver's tables (through the feed mapping in
``racelake.sources.fixtures``) and runs over all of their rows. Queries whose
output would carry hash surrogate keys return the natural keys those keys
are computed from instead, so other engines can reproduce the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake import schemas
from racelake.functions import race
from racelake.operators import clean
from racelake.operators.joins import semi_join_on_group_count
from racelake.operators.shape import rename_to_snake_case
from racelake.plans import profile as P
from racelake.plans import reports as R
from racelake.plans import silver as S
from racelake.plans.context import Layers
from racelake.plans.colocated import colocated_star, write_colocated
from racelake.plans.gold import MIN_ATHLETES_PER_COUNTRY, Gold, fct_results, mart_distance_events
from racelake.plans.merge import DIM_ATHLETE, DIM_EVENT
from racelake.session import scratch_path
from racelake.sinks import read_batches, write_layer
from racelake.sources import csv as csv_src
from racelake.sources import fixtures as fx
from racelake.sources import tables
from racelake.streaming import (ingest_csv_checked, ingest_landing_root, silver_results,
                                stream_cleaned_results, stream_fact_results)
from racelake.streaming.ingest import LOOKUP_DIR, SECOND_FEED_DIR
from racelake.streaming.refresh import GoldRefresh
from racelake.streaming.waterfall import read_waterfall, stream_cleaned_with_counts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered instances. The reference keeps a country in
# the marts at 100 athletes; at the small test scales no country has that
# many, so each mart-based query is also registered at 50 (suffix _min50).
SMALL_SCALE_MIN_ATHLETES = 50
SLICE_COUNTRY, SLICE_YEARS = "NATION_7", (1995, 2020)
PROBE_EVENT, PROBE_TEXT = "Trail Classic (C07)", "C07"
HASH_KEYS = ["event_id", "result_id"]
SPOILT_EVERY = 97  # athletes whose records the quarantine queries spoil
# Checking runs bound their streams; the library waits for completion.
STREAM_TIMEOUT_S = 900


def _without_hash_keys(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in HASH_KEYS if c in df.columns])


def _step(name: str) -> Query:
    def q(spark, d):
        return _without_hash_keys(S.clean_until(Layers(spark, d).combined, name))
    return q


def surrogate_key_counts(spark, d) -> DataFrame:
    """Hash keys are checked by counts: one id per event name, one per
    (event name, athlete), never negative."""
    df = S.clean_until(Layers(spark, d).combined, "enrich_surrogate_keys")
    # One row per combination of keys, then one per value: the rows are
    # shuffled once, and no distinct count multiplies them.
    keys = ["event_id", "result_id", "event_name", "athlete_id"]
    few = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    text = {"event_id": F.col("event_id").cast("string"), "result_id": F.col("result_id").cast("string"),
            "event_name": F.col("event_name"), "event_athlete": F.to_json(F.struct("event_name", "athlete_id"))}
    values = few.select(F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.alias("value"),
                 (F.col("n") if kind == "event_athlete" else F.lit(0).cast("bigint")).alias("n"),
                 F.least("event_id", "result_id").alias("low")) for kind, value in text.items()])).alias("x"))
    counts = values.select("x.*").groupBy("kind", "value").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in (
            ("event_id", "num_event_ids"), ("result_id", "num_result_ids"),
            ("event_name", "num_event_names"), ("event_athlete", "num_event_athletes"))],
        (F.min("low") >= 0).alias("ids_non_negative"),
    )


def silver_obt(spark, d) -> DataFrame:
    """K2: the silver table written as a layer (overwrite) and read back."""
    silver = Layers(spark, d).silver
    return _without_hash_keys(write_layer(silver, scratch_path(spark, "silver")))


def _gold(spark, d):
    return Layers(spark, d).gold


def _with_gold(fn) -> Query:
    """A query over one set of gold tables (built once per call)."""
    return lambda spark, d: fn(_gold(spark, d))


def _mart(kind: str, k: int) -> Query:
    def q(spark, d):
        g = _gold(spark, d)
        m = g.mart_distance if kind == "distance" else g.mart_time
        return m(k, natural_keys=True)
    return q


def _on_mart(report, reads: list[str], kind: str, k: int, **kw) -> Query:
    """A report over the columns ``reads`` of a mart."""
    return lambda spark, d: report(Layers(spark, d).gold_for(kind, reads).mart_for(kind, reads, k), **kw)


def _on_overview(report, reads: list[str]) -> Query:
    return lambda spark, d: report(Layers(spark, d).gold_for("overview", reads).mart_for("overview", reads))


def fct_results_stream(spark, d) -> DataFrame:
    """G1 as a stream: silver is written as an append-only folder, the fact
    stream projects it, and the sink is read back."""
    silver_dir = scratch_path(spark, "silver-append")
    Layers(spark, d).silver.write.mode("append").parquet(silver_dir)
    sink, ckpt = scratch_path(spark, "fact-sink"), scratch_path(spark, "fact-ckpt")
    stream_fact_results(spark, silver_dir, sink, ckpt, natural_keys=True,
                        timeout_s=STREAM_TIMEOUT_S)
    return spark.read.parquet(sink)


def silver_stream(spark, d) -> DataFrame:
    """Silver built incrementally: bronze folders are streamed through the
    cleaning chain in two runs. The second feed arrives for the second run,
    as does half of the lookup, which brings back rows cleaned before."""
    lay = Layers(spark, d)
    main_dir, second_dir = scratch_path(spark, "bronze-main"), scratch_path(spark, "bronze-second")
    codes_dir = scratch_path(spark, "bronze-codes")
    late = F.pmod(F.xxhash64("athlete_country"), F.lit(2)) == 1
    lay.main_raw.write.parquet(main_dir)
    lay.second_raw.limit(0).write.parquet(second_dir)
    lay.lookup.filter(~late).write.parquet(codes_dir)
    sink, ckpt = scratch_path(spark, "silver-cleaned"), scratch_path(spark, "silver-ckpt")
    stream_cleaned_results(spark, [main_dir, second_dir], sink, ckpt, timeout_s=STREAM_TIMEOUT_S)
    write_layer(silver_results(spark, sink, spark.read.parquet(codes_dir)), scratch_path(spark, "silver"))
    lay.second_raw.write.mode("append").parquet(second_dir)
    lay.lookup.filter(late).write.mode("append").parquet(codes_dir)
    stream_cleaned_results(spark, [main_dir, second_dir], sink, ckpt, timeout_s=STREAM_TIMEOUT_S)
    return _without_hash_keys(silver_results(spark, sink, spark.read.parquet(codes_dir)))


def _refreshed(spark, d) -> GoldRefresh:
    """Gold after three refreshes: the main feed with half of the lookup, the
    second feed, then the rest of the lookup."""
    lay = Layers(spark, d)
    main_dir, second_dir = scratch_path(spark, "bronze-main"), scratch_path(spark, "bronze-second")
    codes, cleaned = scratch_path(spark, "bronze-codes"), scratch_path(spark, "silver-cleaned")
    ckpt = scratch_path(spark, "refresh-ckpt")
    gold = GoldRefresh(spark, scratch_path(spark, "gold"), codes, buckets=16)
    late = F.pmod(F.xxhash64("athlete_country"), F.lit(2)) == 1

    def refresh():
        stream_cleaned_results(spark, [main_dir, second_dir], cleaned, f"{ckpt}/silver", timeout_s=STREAM_TIMEOUT_S)
        gold.run(cleaned, f"{ckpt}/gold", max_files_per_trigger=8, timeout_s=STREAM_TIMEOUT_S)

    lay.main_raw.write.parquet(main_dir)
    lay.second_raw.limit(0).write.parquet(second_dir)
    lay.lookup.filter(~late).write.parquet(codes)
    refresh()
    lay.second_raw.write.mode("append").parquet(second_dir)
    refresh()
    lay.lookup.filter(late).write.mode("append").parquet(codes)
    refresh()
    return gold


def fct_results_refresh(spark, d) -> DataFrame:
    """K4 / ST2: the fact appended to by refreshes, the event's name joined
    in from the merged dimension in place of the hash keys."""
    gold = _refreshed(spark, d)
    names = gold.dimension(DIM_EVENT).select("event_id", "event_name")
    return gold.fact().join(names, "event_id").select(
        "event_name", "athlete_id", "performance_seconds", "performance_km", "average_speed", "club", "age_category")


def waterfall_stream(spark, d) -> DataFrame:
    """rows after each cleaning step, summed over the micro-batches of
    two runs of the cleaning stream."""
    lay = Layers(spark, d)
    main_dir, second_dir = scratch_path(spark, "bronze-main"), scratch_path(spark, "bronze-second")
    sink, counts, ckpt = (scratch_path(spark, n) for n in ("silver-cleaned", "waterfall", "silver-ckpt"))
    lay.main_raw.write.parquet(main_dir)
    lay.second_raw.limit(0).write.parquet(second_dir)
    for _ in range(2):
        stream_cleaned_with_counts(spark, [main_dir, second_dir], sink, counts, ckpt,
                                   "waterfall_" + uuid.uuid4().hex[:12], max_files_per_trigger=8,
                                   timeout_s=STREAM_TIMEOUT_S)
        lay.second_raw.write.mode("append").parquet(second_dir)
    return read_waterfall(spark, counts)


def mart_distance_colocated(spark, d) -> DataFrame:
    """The distance mart over the bucketed star of this run's database."""
    g = _gold(spark, d)
    root, db = scratch_path(spark, "warehouse"), "racelake_star_run_" + uuid.uuid4().hex[:12]
    tables.ensure_databases(spark, [db], root)
    try:
        write_colocated(g.fact, g.dim_event, g.dim_athlete, db)
        mart = mart_distance_events(None, None, None, natural_keys=True, star=colocated_star(spark, db))
        return write_layer(mart, f"{root}/mart")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def parse_days_and_ranges(spark, d) -> DataFrame:
    """2.13 (4), (5): durations with days and ranges over a month's end,
    read by default and by the options, on texts made of every lineitem."""
    li = fx.load(spark, d, "lineitem")
    ship, line = F.col("l_shipdate"), F.col("l_linenumber")
    end = F.date_add(ship, (F.col("l_orderkey") % 40).cast("int"))
    day = lambda c, f: F.date_format(c, f)
    dates = F.when(line % 2 == 0, F.concat(day(ship, "dd.MM."), F.lit("-"), day(end, "dd.MM.yyyy"))).otherwise(
        F.concat(day(ship, "dd.MM.yyyy"), F.lit("-"), day(end, "dd.MM.yyyy")))
    seconds = F.floor(F.col("l_extendedprice") * 2.5).cast("bigint")
    hms = F.format_string("%02d:%02d:%02d h", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)
    text = F.concat(F.when(line % 4 > 0, F.concat((line % 4).cast("string"), F.lit("d "))).otherwise(""), hms)
    rows = li.select("l_orderkey", "l_linenumber", dates.alias("dates"), text.alias("performance"))
    start, last = race.range_dates("dates")
    return rows.select("*", race.performance_seconds("performance").alias("seconds"),
                       race.performance_seconds_with_days("performance").alias("seconds_with_days"),
                       race.event_start_date("dates").alias("start_date"), start.alias("range_start"),
                       last.alias("range_end"))


def _landing(spark, d) -> str:
    """A landing root with the three feeds as CSV: the main feed's files in
    the root, the other two in sub-folders."""
    lay = Layers(spark, d)
    root = scratch_path(spark, "landing")
    csv_src.write_csv(lay.main_raw, root)
    csv_src.write_csv(lay.second_raw, f"{root}/{SECOND_FEED_DIR}")
    csv_src.write_csv(lay.lookup, f"{root}/{LOOKUP_DIR}")
    return root


def src_stream_csv(spark, d) -> DataFrame:
    """S2 + K1: incremental ingest of the landing root into bronze."""
    root = _landing(spark, d)
    out = ingest_landing_root(spark, root, scratch_path(spark, "bronze"),
                              scratch_path(spark, "bronze-ckpt"), timeout_s=STREAM_TIMEOUT_S)
    return spark.read.parquet(out["raw_results"])


def src_batch_csv(spark, d) -> DataFrame:
    """S3: batch CSV scan with the feed's declared schema."""
    root = _landing(spark, d)
    return csv_src.read_csv(spark, root, schemas.MAIN_FEED)


def src_infer_schema(spark, d) -> DataFrame:
    """The schema Spark infers from the landing CSV, as rows."""
    root = _landing(spark, d)
    return csv_src.schema_as_rows(spark, csv_src.infer_schema(spark, root))


def _mixed_landing(spark, d) -> str:
    """A landing root into which files of the second feed have strayed, and
    where some records of the main feed hold text for a number."""
    lay = Layers(spark, d)
    root = scratch_path(spark, "landing-mixed")
    spoilt = F.when(F.col("Athlete ID") % SPOILT_EVERY == 0, F.lit("n/a")).otherwise(
        F.col("Event number of finishers").cast("string"))
    csv_src.write_csv(lay.main_raw.withColumn("Event number of finishers", spoilt), root)
    csv_src.write_csv(lay.second_raw, root, mode="append")
    return root


def _channel_counts(good: DataFrame, bad: DataFrame) -> DataFrame:
    return (good.select(F.lit("accepted").alias("channel"), F.lit(None).cast("string").alias("reason"))
            .unionAll(bad.select(F.lit("quarantine"), "reason"))
            .groupBy("channel", "reason").agg(F.count(F.lit(1)).alias("num_rows")))


def src_quarantine(spark, d) -> DataFrame:
    """Batch read with the main feed's schema; files with another
    header and records that do not fit go to quarantine."""
    good, bad = csv_src.read_csv_checked(spark, _mixed_landing(spark, d), schemas.MAIN_FEED)
    return _channel_counts(good, bad)


def src_quarantine_stream(spark, d) -> DataFrame:
    """The same as a stream, written batch by batch into two folders."""
    sink, bad = scratch_path(spark, "bronze-good"), scratch_path(spark, "bronze-bad")
    ingest_csv_checked(spark, _mixed_landing(spark, d), schemas.MAIN_FEED, sink, bad,
                       scratch_path(spark, "bronze-ckpt"), max_files_per_trigger=5, timeout_s=STREAM_TIMEOUT_S)
    return _channel_counts(read_batches(spark, sink), read_batches(spark, bad))


def src_table_scan(spark, d) -> DataFrame:
    """``FROM <table>`` on the bronze feed registered by name."""
    Layers(spark, d).main_raw.createOrReplaceTempView("bronze_raw_results")
    return tables.scan_table(spark, "bronze_raw_results")


def meta_list_files(spark, d) -> DataFrame:
    """The files of a landing root (sub-folders are not listed), held
    against their contents: the records in listed files, the records in
    others, and whether the listed sizes are the files' bytes."""
    root = _landing(spark, d)
    files = tables.list_files(spark, root).select(F.col("path").alias("file"), "length")
    lines = (spark.read.text(root).select(F.col("_metadata.file_path").alias("file"), "value")
             .groupBy("file").agg((F.count(F.lit(1)) - 1).alias("records"),
                                  F.sum(F.octet_length("value") + 1).alias("bytes")))
    both = lines.join(files, "file", "full")
    return both.agg(
        F.sum(F.when(F.col("length").isNotNull(), F.col("records")).otherwise(0)).alias("listed_records"),
        F.sum(F.when(F.col("length").isNull(), F.col("records")).otherwise(0)).alias("other_records"),
        F.min(F.coalesce(F.col("bytes"), F.lit(0)) == F.col("length")).alias("sizes_agree"))


# Fixed table comments of the layer databases.
LAYER_COMMENTS = {
    ("racelake_bronze", "raw_results"): "Raw results feed - bronze layer",
    ("racelake_bronze", "second_feed"): "Second results feed - bronze layer",
    ("racelake_bronze", "country_codes"): "Country code lookup - bronze layer",
    ("racelake_silver", "results"): "Cleaned and validated one big table - silver layer",
    ("racelake_gold", "fct_results"): "Fact table - gold layer",
    ("racelake_gold", "dim_event"): "Dim event - gold layer",
    ("racelake_gold", "dim_athlete"): "Dim athlete - gold layer",
    ("racelake_gold", "dim_date"): "Dim date - gold layer",
}
LAYER_DATABASES = ["racelake_bronze", "racelake_silver", "racelake_gold"]


@contextmanager
def _layer_databases(spark, d):
    """Creates the layer databases and writes each layer's tables into them
    with a comment; gives the folder and the suffix of this run's databases.
    Only these are removed at the end."""
    root = scratch_path(spark, "warehouse")
    run = "_run_" + uuid.uuid4().hex[:12]
    tables.ensure_databases(spark, [db + run for db in LAYER_DATABASES], root)
    lay = Layers(spark, d)

    def keep(db: str, name: str, df: DataFrame) -> DataFrame:
        previous = tables.use_database(spark, db + run)  # the name is unqualified
        try:
            return write_layer(df, f"{root}/{db}{run}.db/{name}", table=name, comment=LAYER_COMMENTS[(db, name)])
        finally:
            tables.use_database(spark, previous)

    try:
        # Each layer is made from the tables of the one before, so the feeds
        # are mapped and cleaned once.
        lay.read_from(main_raw=keep("racelake_bronze", "raw_results", lay.main_raw),
                      second_raw=keep("racelake_bronze", "second_feed", lay.second_raw),
                      lookup=keep("racelake_bronze", "country_codes", lay.lookup))
        g = Gold(keep("racelake_silver", "results", lay.silver), persist=lambda df, name: keep("racelake_gold", name, df))
        for name in ("fact", "dim_event", "dim_athlete", "dim_date"):
            getattr(g, name)
        yield root, run
    finally:
        for db in LAYER_DATABASES:
            spark.sql(f"DROP DATABASE IF EXISTS {db}{run} CASCADE")


def meta_catalog_tables(spark, d) -> DataFrame:
    """K5 / K6: every table of the layer databases with comment and rows."""
    with _layer_databases(spark, d) as (root, run):
        out = None
        for db in LAYER_DATABASES:
            inv = tables.table_inventory(spark, db + run).withColumn("database", F.lit(db))
            out = inv if out is None else out.unionByName(inv)
        return write_layer(out, f"{root}/inventory")  # counted before the databases go


def meta_list_schemas(spark, d) -> DataFrame:
    """SHOW CATALOGS, then SHOW SCHEMAS IN each of them, with the
    tables and rows that each of the run's own schemas holds."""
    with _layer_databases(spark, d) as (root, run):
        found = tables.schema_inventory(spark, f"*{run}")
        return write_layer(found.withColumn("schema", F.regexp_replace("schema", run + "$", "")), f"{root}/schemas")


def _raw_main(spark, d) -> DataFrame:
    return Layers(spark, d).main_raw


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    k100, k50 = MIN_ATHLETES_PER_COUNTRY, SMALL_SCALE_MIN_ATHLETES

    # Sources and sinks
    q["src_infer_schema"] = src_infer_schema
    q["src_stream_csv"] = src_stream_csv
    q["src_batch_csv"] = src_batch_csv
    q["src_table_scan"] = src_table_scan
    q["meta_list_files"] = meta_list_files
    q["meta_catalog_tables"] = meta_catalog_tables
    q["meta_list_schemas"] = meta_list_schemas
    q["src_quarantine"] = src_quarantine
    q["src_quarantine_stream"] = src_quarantine_stream

    # Shaping and set operations
    q["shape_snake_case"] = lambda s, d: rename_to_snake_case(_raw_main(s, d))
    q["setop_union_by_name"] = lambda s, d: Layers(s, d).combined

    # Silver chain, one query per step (the waterfall)
    for name in S.STEP_NAMES:
        q[name] = surrogate_key_counts if name == "enrich_surrogate_keys" else _step(name)
    q["join_country_lookup"] = lambda s, d: _without_hash_keys(Layers(s, d).silver)
    q["silver_obt"] = silver_obt
    q["silver_stream"] = silver_stream
    q["audit_unmatched_countries"] = lambda s, d: R.unmatched_countries(
        S.clean_until(Layers(s, d).combined), Layers(s, d).lookup)
    q["waterfall_stream"] = waterfall_stream
    q["parse_days_and_ranges"] = parse_days_and_ranges
    q["audit_unit_validity"] = lambda s, d: clean.unit_validity_audit(
        _raw_main(s, d), "Event distance/length", "Athlete performance")
    q["audit_rejected_units"] = lambda s, d: clean.rejected_unit_rows(
        _raw_main(s, d), 20, "Event distance/length", "Athlete performance")

    # Gold
    q["fct_results"] = lambda s, d: fct_results(Layers(s, d).silver, natural_keys=True)
    q["fct_results_stream"] = fct_results_stream
    q["fct_results_refresh"] = fct_results_refresh
    q["dim_athlete_refresh"] = lambda s, d: _refreshed(s, d).dimension(DIM_ATHLETE)
    q["dim_event_refresh"] = lambda s, d: _refreshed(s, d).dimension(DIM_EVENT).drop("event_id")
    q["dim_athlete"] = lambda s, d: _gold(s, d).dim_athlete
    q["dim_event"] = lambda s, d: _gold(s, d).dim_event.drop("event_id")
    q["dim_date"] = lambda s, d: _gold(s, d).dim_date
    q["mart_distance_events"] = _mart("distance", k100)
    q["mart_distance_colocated"] = mart_distance_colocated
    q["mart_time_events"] = _mart("time", k100)
    q["mart_distance_events_min50"] = _mart("distance", k50)
    q["mart_time_events_min50"] = _mart("time", k50)
    q["mart_overview"] = lambda s, d: _gold(s, d).mart_overview(natural_keys=True)
    q["join_semi_having"] = _with_gold(lambda g: semi_join_on_group_count(
        g.dim_athlete, g.dim_athlete, "country_name", k100))

    # Business questions
    for suffix, k in (("", k100), ("_min50", k50)):
        q["q1_athletes_by_country" + suffix] = _on_mart(
            R.athletes_by_country, ["country_name", "athlete_id"], "distance", k)
        q["q2_gender_share" + suffix] = _on_mart(R.gender_share, ["gender", "athlete_id"], "distance", k)
        q["q3_events_by_year" + suffix] = _on_mart(R.events_by_year, ["event_year", "event_name"], "distance", k)
        q["q5_speed_by_gender" + suffix] = _on_mart(R.speed_by_gender, ["gender", "average_speed"], "distance", k)
        q["q6b_finisher_sum" + suffix] = _on_mart(
            R.finisher_sum, ["event_name", "event_year", "number_finishers"], "distance", k)
        q["rpt_distance_by_country" + suffix] = _on_mart(
            R.average_by, ["country_name", "performance_hours"], "distance", k,
            key="country_name", value="performance_hours",
            name="avg_hours")
        q["rpt_distance_by_age" + suffix] = _on_mart(
            R.average_by, ["age_category", "performance_hours"], "distance", k,
            key="age_category", value="performance_hours",
            name="avg_hours")
        q["rpt_time_by_country" + suffix] = _on_mart(
            R.average_by, ["country_name", "performance_km"], "time", k,
            key="country_name", value="performance_km", name="avg_km")
        q["rpt_time_by_age" + suffix] = _on_mart(
            R.average_by, ["age_category", "performance_km"], "time", k,
            key="age_category", value="performance_km", name="avg_km")
    q["q4_max_finishers"] = _on_overview(R.max_finishers, ["event_name", "number_finishers"])
    q["q6_popular_events"] = _on_overview(R.popular_events, ["event_name", "event_type", "athlete_id"])
    q["rpt_kpis"] = _on_overview(R.kpis, ["event_name", "country_name", "athlete_id"])
    q["rpt_growth"] = _on_overview(R.growth, ["event_year"])
    q["rpt_gender_distribution"] = _on_overview(R.gender_distribution, ["gender", "athlete_id"])
    q["rpt_top_countries"] = _on_overview(R.top_countries, ["country_name", "athlete_id"])

    # Sanity checks
    q["check_layer_row_counts"] = lambda s, d: R.layer_row_counts(_gold(s, d))
    q["check_metric_coverage"] = lambda s, d: R.metric_coverage(_gold(s, d).fact)
    q["check_min_max_by_type"] = _with_gold(lambda g: R.min_max_by_type(g.fact, g.dim_event))
    q["check_speed_by_country"] = _with_gold(lambda g: R.speed_by_country(g.fact, g.dim_athlete))
    q["check_results_by_year_type"] = _with_gold(lambda g: R.results_by_year_type(
        g.fact, g.dim_event))
    q["check_gender_by_type"] = _with_gold(lambda g: R.gender_by_type(
        g.fact, g.dim_athlete, g.dim_event))
    q["gold_country_year_slice"] = _with_gold(lambda g: R.country_year_slice(
        g.fact, g.dim_athlete, g.dim_event, SLICE_COUNTRY, *SLICE_YEARS))
    q["check_hours_by_age_category"] = _with_gold(lambda g: R.hours_by_age_category(
        g.fact, g.dim_athlete))
    q["filter_like_distinct"] = lambda s, d: R.event_names_like(Layers(s, d).silver, PROBE_TEXT)
    q["check_event_dim_row"] = lambda s, d: R.event_row(_gold(s, d).dim_event, PROBE_EVENT)
    q["check_event_in_gold"] = _with_gold(lambda g: R.event_results_sample(
        g.fact, g.dim_event, PROBE_EVENT))
    q["check_duplicate_keys"] = lambda s, d: R.duplicate_keys(_gold(s, d).dim_athlete, "athlete_id")
    q["check_duplicate_results"] = lambda s, d: R.duplicate_results(
        fct_results(Layers(s, d).silver, natural_keys=True))
    q["check_distinct_clubs"] = lambda s, d: R.distinct_clubs(_gold(s, d).fact)

    # Profiling of the raw feed
    q["profile_shape"] = lambda s, d: P.shape(_raw_main(s, d))
    q["profile_null_counts"] = lambda s, d: P.null_counts(_raw_main(s, d))
    q["profile_distinct_counts"] = lambda s, d: P.distinct_counts(_raw_main(s, d))
    q["profile_distinct_values"] = lambda s, d: P.distinct_values(_raw_main(s, d), "Event name")
    q["profile_numeric_summary"] = lambda s, d: P.numeric_summary(_raw_main(s, d))
    q["profile_quartiles"] = lambda s, d: P.numeric_quartiles(
        write_layer(_raw_main(s, d), scratch_path(s, "bronze")))
    q["profile_preview"] = lambda s, d: P.preview(
        _raw_main(s, d), 10, ["Athlete ID", "Event name", "Event dates", "Athlete performance",
                              "Athlete average speed", "Athlete age category",
                              "Event number of finishers"])
    q["agg_count_by_key"] = lambda s, d: P.count_by_key(_raw_main(s, d), "Athlete age category")
    q["topk_countries"] = lambda s, d: P.top_keys(_raw_main(s, d), "Athlete country", 20)
    return q


QUERIES: dict[str, Query] = _queries()
