"""Layer driver: bronze -> silver -> gold, each layer written before the next
one reads it (the batch equivalent of the streaming / materialized-view
tables). Writing every layer cuts the lineage, so a lost executor costs at
most the recomputation of one layer, and every later query reads column-
pruned parquet instead of re-parsing text.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from racelake.plans import silver as S
from racelake.plans.gold import MIN_ATHLETES_PER_COUNTRY, Gold
from racelake.plans.merge import DIM_ATHLETE, DIM_EVENT
from racelake.sinks import write_layer
from racelake.sources import fixtures as fx

LAYER_TABLES = ["bronze/raw_results", "bronze/second_feed", "bronze/country_codes",
                "silver/results", "gold/fct_results", "gold/dim_event", "gold/dim_athlete",
                "gold/dim_date", "gold/mart_distance_events", "gold/mart_time_events",
                "gold/mart_overview"]


def _timed(timings: dict | None, name: str, fn: Callable[[], DataFrame]) -> DataFrame:
    t0 = time.time()
    out = fn()
    if timings is not None:
        timings[name] = round(time.time() - t0, 3)
    return out


def build_layers(spark: SparkSession, sf_dir: str, out_root: str,
                 min_athletes: int = MIN_ATHLETES_PER_COUNTRY,
                 timings: dict | None = None,
                 waterfall: dict | None = None) -> dict[str, DataFrame]:
    """Write all layers under ``out_root`` and return readers for them.

    ``timings`` receives seconds per written table; ``waterfall`` receives
    the silver row count after each cleaning step (observed while silver is
    written, no extra job).

    Bronze comes from the driver tables (``fixtures``); in production the
    bronze folders are filled by ``racelake.streaming.ingest_landing_root``.
    """
    root = out_root.rstrip("/")
    w = lambda df, name: write_layer(df, f"{root}/{name}")
    t: dict[str, DataFrame] = {}
    t["bronze/raw_results"] = _timed(timings, "bronze_raw_results",
                                     lambda: w(fx.main_feed(spark, sf_dir), "bronze/raw_results"))
    t["bronze/second_feed"] = _timed(timings, "bronze_second_feed",
                                     lambda: w(fx.second_feed(spark, sf_dir), "bronze/second_feed"))
    t["bronze/country_codes"] = _timed(timings, "bronze_country_codes",
                                       lambda: w(fx.country_lookup(spark, sf_dir), "bronze/country_codes"))
    combined = S.combine_feeds(t["bronze/raw_results"], t["bronze/second_feed"])
    observed: dict = {} if waterfall is not None else None
    t["silver/results"] = _timed(timings, "silver_results", lambda: w(
        S.clean_results(combined, t["bronze/country_codes"], observations=observed), "silver/results"))
    if waterfall is not None:
        waterfall.update({k: v.get["rows"] for k, v in observed.items()})

    t.update(build_gold(t["silver/results"], root, min_athletes, timings))
    return t


def build_gold(silver: DataFrame, out_root: str,
               min_athletes: int = MIN_ATHLETES_PER_COUNTRY,
               timings: dict | None = None,
               kept: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Recompute the gold tables and marts from a silver table and write
    them under ``out_root/gold``; returns readers keyed ``gold/<table>``.
    Tables in ``kept`` (``fact``, ``dim_event``, ``dim_athlete``), which a
    refresh maintains, are used as they are instead of being recomputed."""
    root = out_root.rstrip("/")
    w = lambda df, name: write_layer(df, f"{root}/{name}")
    t: dict[str, DataFrame] = {}

    def persist(df: DataFrame, name: str) -> DataFrame:
        t[f"gold/{name}"] = _timed(timings, f"gold_{name}", lambda: w(df, f"gold/{name}"))
        return t[f"gold/{name}"]

    g = Gold(silver, persist=persist, kept=kept)
    for name, df in (kept or {}).items():
        t[f"gold/{'fct_results' if name == 'fact' else name}"] = df
    for name in ("fact", "dim_event", "dim_athlete", "dim_date", "star"):
        getattr(g, name)  # write each table once, in order, timed by ``persist``
    t["gold/mart_distance_events"] = _timed(timings, "gold_mart_distance_events", lambda: w(
        g.mart_distance(min_athletes), "gold/mart_distance_events"))
    t["gold/mart_time_events"] = _timed(timings, "gold_mart_time_events", lambda: w(
        g.mart_time(min_athletes), "gold/mart_time_events"))
    t["gold/mart_overview"] = _timed(timings, "gold_mart_overview", lambda: w(
        g.mart_overview(), "gold/mart_overview"))
    return t


def refresh_layers(spark: SparkSession, landing_root: str, out_root: str,
                   min_athletes: int = MIN_ATHLETES_PER_COUNTRY,
                   timeout_s: float | None = None) -> dict[str, DataFrame]:
    """One refresh from a CSV landing root (main feed in the root, the other
    two feeds in sub-folders), as the reference's layered tables do:

    1. bronze: new CSV files are appended by three file streams;
    2. silver: only the new bronze rows are cleaned (stream); those whose
       country code is known are appended, the others wait, and come in with
       the refresh that brings their code;
    3. gold: the fact is appended to and the dimensions are merged with those
       rows only; the date dimension and the marts are recomputed.

    ``silver/results`` and ``gold/fct_results`` are folders of loads,
    ``gold/dim_event`` and ``gold/dim_athlete`` folders of buckets, so
    ``out_root`` should not be one that ``build_layers`` wrote. Checkpoints
    live in ``out_root/_checkpoints``; a second call with no new files adds
    nothing. Returns readers of all tables.
    """
    from racelake.streaming import ingest_landing_root, stream_cleaned_results
    from racelake.streaming.refresh import GoldRefresh

    root = out_root.rstrip("/")
    ckpt = f"{root}/_checkpoints"
    bronze = ingest_landing_root(spark, landing_root, f"{root}/bronze", f"{ckpt}/bronze", timeout_s)
    stream_cleaned_results(spark, [bronze["raw_results"], bronze["second_feed"]],
                           f"{root}/silver/cleaned", f"{ckpt}/silver", timeout_s=timeout_s)
    t = {f"bronze/{k}": spark.read.parquet(v) for k, v in bronze.items()}
    gold = GoldRefresh(spark, f"{root}/silver", bronze["country_codes"], folders={
        "silver": f"{root}/silver/results", "fact": f"{root}/gold/fct_results",
        **{d.name: f"{root}/gold/{d.name}" for d in (DIM_ATHLETE, DIM_EVENT)}})
    gold.run(f"{root}/silver/cleaned", f"{ckpt}/gold", timeout_s=timeout_s)
    t["silver/results"] = gold.silver()
    kept = {"fact": gold.fact(), "dim_event": gold.dimension(DIM_EVENT), "dim_athlete": gold.dimension(DIM_ATHLETE)}
    t.update(build_gold(t["silver/results"], root, min_athletes, kept=kept))
    return t
