"""Co-located star join: results and athletes in tables bucketed alike.

Both tables are dealt into the same number of buckets of the athlete's id
when they are written, so that every later join by athlete (the marts, the
checks by country, gender or age) reads bucket against bucket and neither
side is shuffled again. The event's columns are attached before the write:
results are moved by event once, by athlete once, and then stay.

A bucket is read by one task, so one athlete with a large share of all
results is better served by ``star_results``, whose join AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from racelake.plans.gold import with_athletes, with_country_athletes, with_events

RESULTS, ATHLETES = "results_by_athlete", "athletes_by_id"
KEY = "athlete_id"
# About 200 MB of results a bucket at 10 billion results; one file each.
BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, key: str = KEY, buckets: int = BUCKETS) -> None:
    """``table`` (``database.name``) bucketed and sorted by ``key``, one file
    a bucket, replacing what was there."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def write_colocated(fact: DataFrame, events: DataFrame, athletes: DataFrame, database: str,
                    buckets: int = BUCKETS) -> None:
    write_bucketed(with_events(fact, events), f"{database}.{RESULTS}", buckets=buckets)
    write_bucketed(with_country_athletes(athletes), f"{database}.{ATHLETES}", buckets=buckets)


def colocated_star(spark: SparkSession, database: str) -> DataFrame:
    """The rows of ``star_results`` from the bucketed tables."""
    return with_athletes(spark.table(f"{database}.{RESULTS}"), spark.table(f"{database}.{ATHLETES}"))
