"""Sinks: layer tables (full recompute) and append streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                table: str | None = None, comment: str | None = None) -> DataFrame:
    """Full recompute of a layer: overwrite the folder (optionally register
    it as ``table`` with a comment) and return a DataFrame reading it back.

    Writing a layer cuts the lineage: later layers read files, so a lost
    executor only recomputes work from the last written layer."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if table:
        writer.option("path", path).saveAsTable(table)
        if comment:
            set_comment(spark, table, comment)
        return spark.table(table)
    writer.save(path)
    return spark.read.parquet(path)


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def write_stream_append(stream_df: DataFrame, sink_dir: str, checkpoint_dir: str,
                        timeout_s: float | None = None, query_name: str | None = None):
    """Append a stream to a parquet folder, processing everything available
    now (in bounded micro-batches) and then stopping. The checkpoint makes a
    re-run pick up only new input; a failed run resumes where it stopped."""
    w = (stream_df.writeStream.format("parquet").outputMode("append")
                  .option("checkpointLocation", checkpoint_dir)
                  .trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    q = w.start(sink_dir)
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream into {sink_dir} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q


def write_stream_batches(stream_df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint_dir: str,
                         timeout_s: float | None = None):
    """Hand every micro-batch available now to ``write(rows, batch_id)``. A
    batch that failed, or whose commit was lost, comes again with the same
    id, so ``write`` must replace what it wrote under that id
    (``write_batch``)."""
    q = (stream_df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
                  .trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream with checkpoint {checkpoint_dir} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q


BATCH = "load"  # the partition column that names what wrote a folder


def write_batch(df: DataFrame, table_dir: str, load: str) -> None:
    """Write the rows of one load, in place of whatever that load wrote
    before: repeating it adds nothing."""
    df.write.mode("overwrite").parquet(f"{table_dir.rstrip('/')}/{BATCH}={load}")


def read_batches(spark: SparkSession, table_dir: str) -> DataFrame:
    """All loads of a table written by ``write_batch``."""
    return spark.read.parquet(table_dir).drop(BATCH)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
