"""Explicit schemas of the feeds (declared, never inferred at run time)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

CSV_OPTIONS = {"header": "true", "encoding": "UTF-8"}


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


MAIN_FEED = _s(
    ("Year of event", IntegerType()),
    ("Event dates", StringType()),
    ("Event name", StringType()),
    ("Event distance/length", StringType()),
    ("Event number of finishers", IntegerType()),
    ("Athlete performance", StringType()),
    ("Athlete club", StringType()),
    ("Athlete country", StringType()),
    ("Athlete year of birth", DoubleType()),
    ("Athlete gender", StringType()),
    ("Athlete age category", StringType()),
    ("Athlete average speed", StringType()),
    ("Athlete ID", LongType()),
)

SECOND_FEED = _s(
    ("Year of event", IntegerType()),
    ("Event name", StringType()),
    ("Event distance/length", StringType()),
    ("Event number of finishers", IntegerType()),
    ("Athlete performance", StringType()),
    ("Athlete country", StringType()),
    ("Athlete year of birth", DoubleType()),
    ("Athlete gender", StringType()),
    ("Athlete age category", StringType()),
    ("Athlete average speed", StringType()),
    ("Athlete ID", LongType()),
    ("Event start date", DateType()),
    ("Event end date", DateType()),
)

COUNTRY_LOOKUP = _s(("athlete_country", StringType()), ("country_name", StringType()))
