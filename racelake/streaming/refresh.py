"""Gold by refresh: the fact is appended to, dimensions are merged.

Each micro-batch of cleaned rows is joined with the lookup as it is then.
Rows whose country code is known go into the fact and are merged into the
dimensions; the others wait in a pending table. Once the stream is through,
waiting rows whose code has arrived since are replayed the same way.

Everything is written under the name of what wrote it (``b<batch>`` or
``r<replay>``) and replaces what that name wrote before, and merging MIN and
MAX a second time changes nothing; so a batch or replay that is repeated
after a failure adds nothing. Batches are repeated before any replay, so a
row is never both waiting and in the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake.plans import silver as S
from racelake.plans.gold import fct_results
from racelake.plans.merge import BUCKETS, DIM_ATHLETE, DIM_EVENT, merge_dimension, read_dimension
from racelake.sinks import BATCH, folder_exists, read_batches, write_batch, write_stream_batches
from racelake.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER

DIMENSIONS = (DIM_ATHLETE, DIM_EVENT)


class GoldRefresh:
    """Incremental gold below ``root``: ``fact``, ``pending``, ``released``
    (codes whose waiting rows have been replayed) and one state per
    dimension. ``lookup`` gives the lookup as it is now; its codes are
    unique and are only ever added to. ``folders`` places single tables
    elsewhere."""

    def __init__(self, spark: SparkSession, root: str, lookup_dir: str, buckets: int = BUCKETS,
                 folders: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.lookup_dir = lookup_dir
        self.buckets = buckets
        self.folders = folders or {}

    def _dir(self, name: str) -> str:
        return self.folders.get(name, f"{self.root}/{name}")

    def _read(self, name: str, schema: str | StructType) -> DataFrame:
        """A table's loads; no rows before its first one."""
        if not folder_exists(self.spark, self._dir(name)):
            return self.spark.createDataFrame([], schema)
        return read_batches(self.spark, self._dir(name))

    def lookup(self) -> DataFrame:
        return self.spark.read.parquet(self.lookup_dir)

    def run(self, cleaned_dir: str, checkpoint_dir: str,
            max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
            timeout_s: float | None = None) -> None:
        """One refresh: the cleaned rows that arrived since the last one,
        then the waiting rows whose code has arrived."""
        schema = self.spark.read.parquet(cleaned_dir).schema
        reader = self.spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        write_stream_batches(reader.parquet(cleaned_dir), self.batch, checkpoint_dir, timeout_s)
        self.replay(schema)

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of one micro-batch."""
        known = self.lookup()
        write_batch(rows.join(known, S.LOOKUP_KEY, "left_anti"), self._dir("pending"), f"b{batch_id}")
        self._gold(S.attach_lookup(rows, known), f"b{batch_id}")

    def replay(self, schema: StructType) -> None:
        """Waiting rows whose code is in the lookup now and was not released
        by an earlier replay."""
        key = S.LOOKUP_KEY
        released = self._read("released", f"{key} string, replay int")
        last = released.agg(F.max("replay")).first()[0]
        number = 0 if last is None else last + 1
        pending = self._read("pending", schema)
        codes = (self.lookup().select(key).join(released, key, "left_anti")
                 .join(pending.select(key).distinct(), key, "left_semi"))
        arrived = S.attach_lookup(pending.join(codes, key, "left_semi"), self.lookup())
        if arrived.isEmpty():
            return
        self._gold(arrived, f"r{number}")
        # The replay counts once this is written; until then it is repeated.
        write_batch(codes.select(key, F.lit(number).alias("replay")), self._dir("released"), f"r{number}")

    def _gold(self, silver: DataFrame, load: str) -> None:
        # The load is written first, with the columns the dimensions need,
        # and the dimensions are merged from it: one pass over the batch.
        write_batch(silver, self._dir("silver"), load)
        rows = self.spark.read.parquet(f"{self._dir('silver')}/{BATCH}={load}")
        write_batch(fct_results(rows), self._dir("fact"), load)
        for dim in DIMENSIONS:
            merge_dimension(dim, rows, self._dir(dim.name), self.buckets)

    def waiting(self) -> DataFrame:
        """Pending rows that have not been replayed."""
        pending = read_batches(self.spark, self._dir("pending"))
        return pending.join(self._read("released", f"{S.LOOKUP_KEY} string, replay int"), S.LOOKUP_KEY, "left_anti")

    def silver(self) -> DataFrame:
        """All results with a known country, as appended so far."""
        return read_batches(self.spark, self._dir("silver"))

    def fact(self) -> DataFrame:
        return read_batches(self.spark, self._dir("fact"))

    def dimension(self, dim) -> DataFrame:
        return read_dimension(self.spark, dim, self._dir(dim.name))
