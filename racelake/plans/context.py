"""Lazy bundle of the layers for one input folder.

``Layers(spark, sf_dir)`` wires the test-table feeds through bronze, silver
and gold without running anything; each attribute is a DataFrame plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from racelake.operators.parse import checkpoint_rows
from racelake.plans import silver as S
from racelake.plans.gold import Gold, fct_results, silver_for
from racelake.session import scratch_path
from racelake.sinks import write_layer
from racelake.sources import fixtures as fx


# Raw texts of silver that were parsed into other columns; gold reads only those.
PARSED_TEXTS = ["event_dates", "athlete_performance"]


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read_from(self, **written: DataFrame) -> None:
        """Later layers read these tables in place of what they were written
        from (``main_raw``, ``second_raw``, ``lookup``)."""
        self.__dict__.update(written)

    @cached_property
    def main_raw(self) -> DataFrame:
        return fx.main_feed(self.spark, self.sf_dir)

    @cached_property
    def second_raw(self) -> DataFrame:
        return fx.second_feed(self.spark, self.sf_dir)

    @cached_property
    def lookup(self) -> DataFrame:
        return fx.country_lookup(self.spark, self.sf_dir)

    @cached_property
    def combined(self) -> DataFrame:
        """The feeds' rows, settled before they are cleaned: the first
        filter would otherwise be pushed below the mapping that makes the
        feeds, which then makes its texts twice."""
        return checkpoint_rows(S.combine_feeds(self.main_raw, self.second_raw), "combined")

    @cached_property
    def silver(self) -> DataFrame:
        return S.clean_results(self.combined, self.lookup)

    @cached_property
    def silver_table(self) -> DataFrame:
        """Silver written once to the shared scratch folder and read back,
        without the two texts that no gold table reads.

        The gold tables read silver three times (fact, two dimensions);
        reading a written layer (column-pruned parquet) replaces three
        recomputations of the parsing chain, and cuts the lineage so a lost
        executor only redoes gold work."""
        return write_layer(self.silver.drop(*PARSED_TEXTS), scratch_path(self.spark, "silver"))

    @cached_property
    def gold(self) -> Gold:
        """Gold over the written silver, with the dimensions written too
        (marts join written tables, see ``Gold``). The fact is a choice of
        silver's columns, so reading it from the written silver is a plain
        scan already and another copy is not made."""
        return self._gold_over(self.silver_table)

    def gold_for(self, kind: str, reads: list[str]) -> Gold:
        """As ``gold``, for one report over the mart of a kind: silver is
        written with the columns that mart is made from (``silver_for``), so
        that no other text is made, parsed or aggregated for it."""
        return self._gold_over(write_layer(silver_for(self.silver, kind, reads), scratch_path(self.spark, "silver")))

    def _gold_over(self, silver: DataFrame) -> Gold:
        root = scratch_path(self.spark, "gold")
        return Gold(silver, persist=lambda df, name: write_layer(df, f"{root}/{name}"),
                    kept={"fact": fct_results(silver)})
