"""Dimensions kept as mergeable state.

MIN and MAX of a union are the MIN and MAX of the parts', so a dimension
needs only its own rows to take in new results. State is dealt into buckets
by a hash of the key; a refresh reads and rewrites the buckets whose keys it
brings, through dynamic partition overwrite, and leaves the files of all
others alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.plans.gold import dim_athlete, dim_event
from racelake.sinks import folder_exists

BUCKET = "bucket"
# A refresh of few keys rewrites at most that many buckets; at dim_athlete's
# 3 million rows a bucket has 12,000, at 3 billion 12 million (about 200 MB).
BUCKETS = 256


@dataclass(frozen=True)
class Dimension:
    """Name, key, and how new results and old state become state."""
    name: str
    key: str
    build: Callable          # results -> dimension rows
    smallest: tuple          # columns merged by MIN
    largest: tuple = ()      # columns merged by MAX


DIM_ATHLETE = Dimension("dim_athlete", "athlete_id", dim_athlete,
                        ("country_code", "country_name", "birth_year", "gender"))
DIM_EVENT = Dimension("dim_event", "event_id", dim_event,
                      ("event_name", "event_type", "event_year", "start_date", "end_date", "distance"),
                      ("number_finishers",))


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_dimension(dim: Dimension, results: DataFrame, state_dir: str, buckets: int = BUCKETS) -> None:
    """Take new results into the state at ``state_dir``. Repeating the same
    results changes no value. The new rows are aggregated before anything is
    read, so a hot key costs one row; the buckets they touch are at most
    ``buckets`` numbers."""
    spark = results.sparkSession
    new = dim.build(results).withColumn(BUCKET, bucket_of(F.col(dim.key), buckets))
    columns = [dim.key, *dim.smallest, *dim.largest, BUCKET]
    new = new.select(*columns)
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
    if not touched:
        return
    if folder_exists(spark, state_dir):
        old = spark.read.parquet(state_dir).filter(F.col(BUCKET).isin(touched)).select(*columns)
        new = (old.unionByName(new).groupBy(BUCKET, dim.key)
               .agg(*[F.min(c).alias(c) for c in dim.smallest], *[F.max(c).alias(c) for c in dim.largest]))
    (new.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(state_dir))


def read_dimension(spark: SparkSession, dim: Dimension, state_dir: str) -> DataFrame:
    return spark.read.parquet(state_dir).select(dim.key, *dim.smallest, *dim.largest)
