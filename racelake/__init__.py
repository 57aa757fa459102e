"""racelake: race-results analytics on Spark.

Turns growing CSV feeds of race results into a clean one-big-table (silver),
a star schema with marts (gold), report queries and data profiles. Every
operator is a ``DataFrame -> DataFrame`` function made of built-in Spark
expressions, so Catalyst sees and optimizes the whole plan.

Sub-packages:

* ``functions``  column-expression builders (no DataFrames)
* ``operators``  DataFrame -> DataFrame steps (shape, clean, parse, enrich, join)
* ``sources``    batch / stream readers, catalog listing, test-table fixtures
* ``sinks``      layer writers (overwrite tables, append streams)
* ``plans``      silver chain, gold tables, reports, profiling, layer driver
* ``streaming``  incremental file ingest and the streamed fact table
"""

from racelake.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
