"""Parsing of free-text feed columns into typed columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions import race as R


FIRST_TIME = "_first_time"  # dropped again: the matched time while it is read


def checkpoint_rows(df: DataFrame, step: str) -> DataFrame:
    """Count the rows that reach ``step`` as an observed metric.

    Besides giving the cleaning waterfall for free (no extra job), the
    observation marks the point where parsed columns are settled: Catalyst
    does not push later filters below it, so each parser runs once per row
    instead of being inlined into every predicate that reads its result.
    """
    return df.observe(f"rows_{step}_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"))


def _col(name: str):
    return F.col(f"`{name}`")


def parse_event_type(df: DataFrame, length: str = "event_distance/length",
                     out: str = "event_type") -> DataFrame:
    """Add ``distance`` / ``time`` / NULL from the event length unit."""
    return df.withColumn(out, R.event_type(_col(length)))


def parse_event_dates(df: DataFrame, dates: str = "event_dates",
                      start: str = "event_start_date",
                      end: str = "event_end_date", cross_month: bool = False) -> DataFrame:
    """Add (or complete) start and end dates from the date text, keeping a
    value the row already carries when the text gives none; drop rows
    without a start date. ``cross_month`` reads ranges over a month's end
    as what they say (off by default)."""
    existing = set(df.columns)
    old_start, old_end = (_col(c) if c in existing else None for c in (start, end))
    if cross_month:
        s, e = R.range_dates(_col(dates), old_start, old_end)
    else:
        s, e = R.event_start_date(_col(dates), old_start), R.event_end_date(_col(dates), old_end)
    parsed = checkpoint_rows(df.withColumns({start: s, end: e}), "event_dates")
    return parsed.filter(_col(start).isNotNull())


def parse_performance(df: DataFrame, performance: str = "athlete_performance",
                      seconds: str = "performance_seconds",
                      km: str = "performance_km", count_days: bool = False) -> DataFrame:
    """Add seconds (from ``H:M:S``; with ``count_days`` also from the days
    before it, off by default) and km (from ``<n> km``).

    Keeps rows with more than one hour, or a km text; then rows with more
    than one hour or a positive km value.
    """
    p = _col(performance)
    over_hour = _col(seconds) > R.MIN_SECONDS_EXCLUSIVE
    if count_days:
        parsed = df.withColumns({seconds: R.performance_seconds_with_days(p), km: R.performance_km(p)})
    else:
        parsed = (df.withColumn(FIRST_TIME, R.first_time(p))
                    .withColumns({seconds: R.seconds_of(F.col(FIRST_TIME)), km: R.performance_km(p)})
                    .drop(FIRST_TIME))
    # km is non-NULL exactly for km texts, so the first rule reads the
    # parsed value instead of matching the text again.
    return (checkpoint_rows(parsed, "performance")
              .filter(over_hour | _col(km).isNotNull())
              .filter(over_hour | (_col(km) > 0)))
