"""Filters and null handling for result rows.

Each filter is one predicate of built-in expressions, so Catalyst can
combine adjacent filters, push plain null / comparison checks into the
parquet scan when they sit directly above it, and compile them with the
surrounding projections.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions import race as R

LENGTH = "event_distance/length"
PERFORMANCE = "athlete_performance"


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def drop_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows in which every listed column is non-NULL."""
    preds = [_col(c).isNotNull() for c in columns]
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


def fill_unknown(df: DataFrame, columns: Iterable[str], value: str = "Unknown") -> DataFrame:
    """Cast the columns to string and replace NULL with ``value``."""
    return df.withColumns(
        {c: F.coalesce(_col(c).cast("string"), F.lit(value)) for c in columns})


def require_any_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows in which at least one listed column is non-NULL."""
    preds = [_col(c).isNotNull() for c in columns]
    return df.filter(reduce(lambda a, b: a | b, preds))


def validate_performance_units(df: DataFrame, length: str = LENGTH,
                               performance: str = PERFORMANCE) -> DataFrame:
    """Drop rows whose performance unit does not fit the event length unit
    (see ``unit_verdict``); a NULL verdict is dropped as well."""
    return df.filter(R.unit_verdict(_col(length), _col(performance)))


def unit_validity_audit(df: DataFrame, length: str = LENGTH,
                        performance: str = PERFORMANCE) -> DataFrame:
    """Row count per unit verdict (true / false / NULL)."""
    return (df.groupBy(R.unit_verdict(_col(length), _col(performance)).alias("is_valid"))
              .agg(F.count(F.lit(1)).alias("count")))


def rejected_unit_rows(df: DataFrame, n: int = 20, length: str = LENGTH,
                       performance: str = PERFORMANCE) -> DataFrame:
    """A stable sample of ``n`` rejected (length, performance) rows: the
    first ``n`` in text order, so it is a top-k, not a full sort."""
    verdict = R.unit_verdict(_col(length), _col(performance))
    return (df.filter(~F.coalesce(verdict, F.lit(False)))
              .select(_col(length).alias(length), _col(performance).alias(performance))
              .orderBy(_col(length).asc_nulls_first(), _col(performance).asc_nulls_first())
              .limit(n))


def filter_realistic_performance(df: DataFrame, event_type: str = "event_type",
                                 seconds: str = "performance_seconds",
                                 km: str = "performance_km",
                                 seconds_range=R.DISTANCE_SECONDS_RANGE,
                                 km_range=R.TIME_KM_RANGE) -> DataFrame:
    """Distance results need 1-60 h, time results 1-500 km (inclusive)."""
    return df.filter(R.is_realistic_performance(
        _col(event_type), _col(seconds), _col(km), seconds_range, km_range))


def filter_athlete_speed(df: DataFrame, speed: str = "athlete_average_speed",
                         speed_range=R.SPEED_RANGE, fill: float = 0.0) -> DataFrame:
    """Cast speed leniently to double; keep NULL or values in range; then
    NULL becomes ``fill`` (0.0)."""
    s = R.speed_as_double(_col(speed))
    lo, hi = speed_range
    return (df.withColumn(speed, s)
              .filter(_col(speed).isNull() | _col(speed).between(lo, hi))
              .withColumn(speed, F.coalesce(_col(speed), F.lit(fill))))


def filter_athlete_age(df: DataFrame, birth_year: str = "athlete_year_of_birth",
                       start_date: str = "event_start_date",
                       age_range=R.AGE_RANGE) -> DataFrame:
    """Birth year becomes int; keep athletes aged 18-100 (inclusive) in the
    year the event started."""
    lo, hi = age_range
    out = df.withColumn(birth_year, R.year_as_int(_col(birth_year)))
    return out.filter(R.age_at_event(_col(start_date), _col(birth_year)).between(lo, hi))
