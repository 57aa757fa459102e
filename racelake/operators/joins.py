"""Joins. No strategy is forced: Spark broadcasts a side by its real bytes,
from file sizes before the job or from shuffle sizes while it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_lookup(df: DataFrame, lookup: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join ``df`` with a lookup table. A duplicated lookup key
    multiplies rows, as a plain join does."""
    return df.join(lookup, on=on, how=how)


def semi_join_on_group_count(df: DataFrame, groups: DataFrame, key: str,
                             min_count: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` has at least ``min_count`` rows in
    ``groups`` (``key IN (SELECT key FROM groups GROUP BY key HAVING
    COUNT(*) >= min_count)``).

    The group count is a partial + final aggregate, so a hot key costs one
    row per map task; its result has one row per qualifying key, and AQE
    broadcasts it when the measured size is small.
    """
    keys = (groups.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                  .filter(F.col("_n") >= min_count).select(key))
    return df.join(keys, on=key, how="left_semi")
