"""Layers written for a query are read by the layers after them."""

import pytest

from racelake.plans import context, registry
from racelake.plans.colocated import BUCKETS
from support import SF0001


class Stop(Exception):
    pass


def test_silver_table_reads_the_bronze_tables(spark, monkeypatch):
    plans = []
    write = registry.write_layer

    def watched(df, path, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        if kw.get("table") == "results":
            raise Stop
        return write(df, path, **kw)

    for module in (registry, context):
        monkeypatch.setattr(module, "write_layer", watched)
    with pytest.raises(Stop):
        registry.meta_list_schemas(spark, SF0001)
    assert len([p for p in plans if "l_extendedprice" in p]) == 1  # the feed is mapped once


def test_colocated_star_has_the_library_buckets(spark, monkeypatch):
    seen = []

    def watched(fact, events, athletes, database, buckets=BUCKETS):
        seen.append(buckets)
        raise Stop

    monkeypatch.setattr(registry, "write_colocated", watched)
    with pytest.raises(Stop):
        registry.mart_distance_colocated(spark, SF0001)
    assert seen == [BUCKETS]


def test_a_report_writes_only_what_it_reads(spark, monkeypatch):
    """No copy of the fact, no star with every column of every result."""
    written = {}
    write = context.write_layer

    def watched(df, path, **kw):
        written[path.rsplit("/", 1)[-1].split("-")[0]] = df.columns
        return write(df, path, **kw)

    monkeypatch.setattr(context, "write_layer", watched)
    registry.QUERIES["q3_events_by_year"](spark, SF0001)
    assert not {"fct_results", "star_results"} & set(written)
    assert written["mart_distance_event_year_event_name"] == ["event_year", "event_name"]
    assert not [c for cols in written.values() for c in cols if c in context.PARSED_TEXTS]


def test_marts_for_reports_hold_the_marts_rows(spark):
    gold = context.Layers(spark, SF0001).gold
    for kind, mart, reads in (("distance", gold.mart_distance(2, natural_keys=True), ["country_name", "performance_hours"]),
                              ("time", gold.mart_time(2, natural_keys=True), ["age_category", "performance_km"]),
                              ("overview", gold.mart_overview(natural_keys=True), ["event_name", "athlete_id"])):
        want = sorted(map(str, mart.select(*reads).collect()))
        assert want and sorted(map(str, gold.mart_for(kind, reads, 2).collect())) == want


def test_a_report_cleans_only_what_its_mart_is_made_from(spark, monkeypatch):
    """Silver, dimensions and mart hold the report's columns and those the
    mart is joined and filtered by; the dates' end is never parsed."""
    written, plans = {}, {}
    write = context.write_layer

    def watched(df, path, **kw):
        name = path.rsplit("/", 1)[-1].split("-")
        name = name[1] if name[0] == "racelake" else name[0]
        written[name] = set(df.columns)
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, path, **kw)

    monkeypatch.setattr(context, "write_layer", watched)
    registry.QUERIES["q1_athletes_by_country"](spark, SF0001)
    assert written["silver"] == {"athlete_id", "event_id", "event_type", "country_name"}
    assert written["dim_event"] == {"event_id", "event_type"}
    assert written["dim_athlete"] == {"athlete_id", "country_name"}
    assert "event_end_date" not in plans["silver"] and "event_start_date" in plans["silver"]


def test_reports_over_narrow_layers_hold_the_marts_rows(spark):
    full = context.Layers(spark, SF0001).gold
    for kind, mart, reads in (
            ("distance", full.mart_distance(2, natural_keys=True), ["end_date", "performance_hours", "gender"]),
            ("time", full.mart_time(2, natural_keys=True), ["birth_year", "performance_km", "start_date", "distance"]),
            ("overview", full.mart_overview(natural_keys=True), ["event_name", "athlete_id", "day_name"])):
        want = sorted(map(str, mart.select(*reads).collect()))
        got = context.Layers(spark, SF0001).gold_for(kind, reads).mart_for(kind, reads, 2)
        assert want and got.columns == reads and sorted(map(str, got.collect())) == want
