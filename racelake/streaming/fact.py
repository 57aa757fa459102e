"""Gold fact as a stream: new silver rows are projected into the fact."""

from __future__ import annotations

from pyspark.sql import SparkSession

from racelake.plans.gold import fct_results
from racelake.sinks import write_stream_append
from racelake.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER


def stream_fact_results(spark: SparkSession, silver_dir: str, sink_dir: str,
                        checkpoint_dir: str, natural_keys: bool = False,
                        max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                        timeout_s: float | None = None):
    """Read the append-only silver folder as a stream and append the fact
    projection of each new batch to ``sink_dir``."""
    schema = spark.read.parquet(silver_dir).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    silver = reader.parquet(silver_dir)
    return write_stream_append(fct_results(silver, natural_keys=natural_keys),
                               sink_dir, checkpoint_dir, timeout_s)
