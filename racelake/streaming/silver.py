"""Cleaning as a stream: only new bronze files are parsed on each run.

The cleaning steps are per row (filters, parsers, casts, hash keys), so a run
with ``trigger(availableNow=True)`` cleans exactly the bronze files that
arrived since the last checkpoint and appends them. The lookup is not part of
the stream: a country code may arrive after the results that use it, and a
row dropped by a streamed join would never come back. Silver is the join of
all cleaned rows with the lookup as it is now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from racelake.plans import silver as S
from racelake.sinks import write_stream_append
from racelake.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER


def _stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(folder).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def stream_cleaned_results(spark: SparkSession, bronze_dirs: list[str],
                           sink_dir: str, checkpoint_dir: str,
                           max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                           timeout_s: float | None = None):
    """Clean the new rows of the bronze folders (main feed first) and append
    them to ``sink_dir``, before the lookup join."""
    feeds = [_stream(spark, d, max_files_per_trigger) for d in bronze_dirs]
    cleaned = S.clean_until(S.combine_feeds(*feeds))
    return write_stream_append(cleaned, sink_dir, checkpoint_dir, timeout_s)


def silver_results(spark: SparkSession, cleaned_dir: str, lookup: DataFrame) -> DataFrame:
    """Silver from all cleaned rows and the lookup as it is now."""
    return S.attach_lookup(spark.read.parquet(cleaned_dir), lookup)
