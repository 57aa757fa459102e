"""Exact distinct counts of integer ids as mergeable bitmaps.

An id is a bit in a bucket of 32,768 ids, so a set of ids is a few bitmaps of
4 KB instead of its values; bitmaps of parts are combined by OR. Several
distinct counts fit in one pass, where COUNT(DISTINCT) would multiply the
rows. For dense ids (keys handed out in order); sparse ones such as hashes
would take a bucket each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def id_bitmaps(df: DataFrame, key: str, by: list[str] | None = None, *extra: Column) -> DataFrame:
    """State: one row per group and bucket, with the bitmap of the ids seen
    (and any ``extra`` aggregates of the same pass). A NULL id sets no bit,
    but its rows count in ``extra``. The aggregate is partial before the
    shuffle, so a hot bucket costs a row per task."""
    k = F.col(key).cast("bigint")
    bit = F.bitmap_construct_agg(F.bitmap_bit_position(k))
    return df.groupBy(*(by or []), F.bitmap_bucket_number(k).alias(BUCKET)).agg(bit.alias(BITS), *extra)


def merge_bitmaps(*states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """States of parts combined into the state of the whole."""
    out = states[0].select(*(by or []), BUCKET, BITS)
    for s in states[1:]:
        out = out.unionByName(s.select(*(by or []), BUCKET, BITS))
    return out.groupBy(*(by or []), BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_ids() -> Column:
    """Aggregate over a state: the number of distinct ids."""
    return F.coalesce(F.sum(F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(BITS))), F.lit(0))
