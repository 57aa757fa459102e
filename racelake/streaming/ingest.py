"""Bronze: incremental ingest of CSV landing folders into parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake import schemas
from racelake.sinks import write_batch, write_stream_append, write_stream_batches
from racelake.sources.csv import header_report, read_csv_stream, read_rows_checked, split_told
from racelake.sources.tables import stream_files

# Files per micro-batch. A first run over a large existing folder then
# commits progress every batch instead of reading everything as one batch
# that a failure would have to redo in full.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000

# Sub-folders of the landing root that hold the other two feeds; the main
# feed's files sit directly in the root.
SECOND_FEED_DIR = "second_feed"
LOOKUP_DIR = "country_codes"


def ingest_csv_stream(spark: SparkSession, src_dir: str, schema: StructType,
                      sink_dir: str, checkpoint_dir: str,
                      max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                      timeout_s: float | None = None, archive_dir: str | None = None):
    """Append every new CSV file of ``src_dir`` to the parquet folder
    ``sink_dir``; returns the finished StreamingQuery. ``archive_dir`` moves
    ingested files out of the landing folder (off by default)."""
    stream = read_csv_stream(spark, src_dir, schema, max_files_per_trigger, archive_dir)
    return write_stream_append(stream, sink_dir, checkpoint_dir, timeout_s)


def ingest_csv_checked(spark: SparkSession, src_dir: str, schema: StructType, sink_dir: str,
                       quarantine_dir: str, checkpoint_dir: str,
                       max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                       timeout_s: float | None = None):
    """As ``ingest_csv_stream``, but files with another header and records
    that do not fit the schema go to ``quarantine_dir`` (``file``,
    ``reason``, ``record``). Both folders are written per micro-batch and a
    repeated batch replaces itself (read them with ``sinks.read_batches``).
    The stream is one of files: at most ``max_files_per_trigger`` names pass
    through the driver, and a batch's files are read by the verdict on their
    headers, so that no row is joined with it and accepted rows are sought
    in conforming files only. (Rows of a CSV stream reach a batch as an RDD of
    unknown size, parsed in full for each use and shuffled by their files.)"""
    stream = stream_files(spark, src_dir, max_files_per_trigger)

    def write(arrived, batch_id):
        session = arrived.sparkSession
        paths = {r.file: r.path for r in arrived.collect()}
        if not paths or read_rows_checked(session, [*paths.values()], schema).isEmpty():
            return
        headers = header_report(session, [*paths.values()], schema).filter("conforms").collect()
        conforming = {r.file for r in headers}
        split = [split_told(read_rows_checked(session, some, schema), F.lit(verdict), schema)
                 for verdict in (True, False) if (some := [p for f, p in paths.items() if (f in conforming) == verdict])]
        good, bad = (reduce(DataFrame.unionAll, parts) for parts in zip(*split))
        write_batch(good, sink_dir, f"b{batch_id}")
        write_batch(bad, quarantine_dir, f"b{batch_id}")

    return write_stream_batches(stream, write, checkpoint_dir, timeout_s)


def ingest_landing_root(spark: SparkSession, landing_root: str, bronze_root: str,
                        checkpoint_root: str, timeout_s: float | None = None) -> dict[str, str]:
    """Ingest the three feeds of a landing root into three bronze folders.

    Returns ``{table: sink folder}``."""
    root = landing_root.rstrip("/")
    jobs = {
        "raw_results": (root, schemas.MAIN_FEED),
        "second_feed": (f"{root}/{SECOND_FEED_DIR}", schemas.SECOND_FEED),
        "country_codes": (f"{root}/{LOOKUP_DIR}", schemas.COUNTRY_LOOKUP),
    }
    out = {}
    for name, (src, schema) in jobs.items():
        sink = f"{bronze_root.rstrip('/')}/{name}"
        ingest_csv_stream(spark, src, schema, sink, f"{checkpoint_root.rstrip('/')}/{name}",
                          timeout_s=timeout_s)
        out[name] = sink
    return out
