"""Enrichment: normalized categories, surrogate keys, club names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions import race as R


def normalize_age_category(df: DataFrame, column: str = "athlete_age_category") -> DataFrame:
    return df.withColumn(column, R.normalized_age_category(F.col(column)))


def clean_club_names(df: DataFrame, column: str = "athlete_club") -> DataFrame:
    return df.withColumn(column, R.club_without_marker(F.col(column)))


def generate_ids(df: DataFrame, event_name: str = "event_name",
                 athlete_id: str = "athlete_id") -> DataFrame:
    """Add hash surrogate keys computed from row content only, so they do not
    depend on row order, partitioning or re-execution after a lost task.

    ``event_id`` is per event name (all editions share it); ``result_id`` is
    per (event name, athlete) and therefore not unique across years. The
    athlete id is hashed as bigint so int and bigint feeds agree.
    """
    name = F.col(event_name)
    return df.withColumns({
        "event_id": R.positive_hash(name),
        "result_id": R.positive_hash(name, F.col(athlete_id).cast("bigint")),
    })
