"""The cleaning waterfall of a stream: rows after each step, per micro-batch.

Each step's row count is an observed metric of the stream itself, so the
counts cost no job; a listener takes them from the progress events and they
are kept as a table of (batch, step, rows).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from racelake.plans import silver as S
from racelake.sinks import folder_exists, read_batches, write_batch, write_stream_append
from racelake.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER

PREFIX = "after_"
SCHEMA = "batch bigint, step string, num_rows bigint"


class StepCounts(StreamingQueryListener):
    """Row counts per batch of the query called ``name``."""

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[int, dict[str, int]] = {}
        self.ids: set = set()
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.ids.add(event.runId)

    def onQueryProgress(self, event):
        p = event.progress
        if p.name == self.name:
            counts = {k[len(PREFIX):]: row["rows"] for k, row in p.observedMetrics.items() if k.startswith(PREFIX)}
            if counts:
                self.batches[p.batchId] = counts

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId in self.ids:
            self.ended.set()  # events come in order: no progress follows


def observed_chain(df: DataFrame) -> DataFrame:
    """The cleaning chain with each step's rows observed by its name."""
    for name, step in S.silver_steps:
        df = df.transform(step).observe(PREFIX + name, F.count(F.lit(1)).alias("rows"))
    return df


def stream_cleaned_with_counts(spark: SparkSession, bronze_dirs: list[str], sink_dir: str, counts_dir: str,
                               checkpoint_dir: str, query_name: str,
                               max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                               timeout_s: float | None = None, wait_s: float = 60) -> None:
    """As ``stream_cleaned_results``, and the counts of each batch written to
    ``counts_dir`` under the batch's number (a repeated batch replaces its
    counts). ``query_name`` must be no other running query's."""
    feeds = []
    for d in bronze_dirs:
        reader = spark.readStream.schema(spark.read.parquet(d).schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        feeds.append(reader.parquet(d))
    listener = StepCounts(query_name)
    spark.streams.addListener(listener)
    try:
        write_stream_append(observed_chain(S.combine_feeds(*feeds)), sink_dir, checkpoint_dir, timeout_s, query_name)
        if not listener.ended.wait(wait_s):
            raise TimeoutError(f"no end of query {query_name} was reported in {wait_s}s")
    finally:
        spark.streams.removeListener(listener)
    for batch, counts in sorted(listener.batches.items()):
        rows = [(batch, step, n) for step, n in counts.items()]
        write_batch(spark.createDataFrame(rows, SCHEMA).coalesce(1), counts_dir, f"b{batch}")


def read_waterfall(spark: SparkSession, counts_dir: str) -> DataFrame:
    """``step``, ``num_rows`` over all batches."""
    rows = read_batches(spark, counts_dir) if folder_exists(spark, counts_dir) else spark.createDataFrame([], SCHEMA)
    return rows.groupBy("step").agg(F.sum("num_rows").alias("num_rows"))
