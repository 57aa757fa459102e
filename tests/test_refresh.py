"""Incremental gold: the appended fact and the merged dimensions equal the
batch tables after any split of feeds and lookup, and repeats add nothing."""

import os

import pytest
from pyspark.sql import functions as F

from racelake.plans import silver as S
from racelake.plans.context import Layers
from racelake.plans.gold import dim_athlete, dim_event, fct_results
from racelake.plans.merge import BUCKET, DIM_ATHLETE, DIM_EVENT, bucket_of, merge_dimension, read_dimension
from racelake.session import scratch_path
from racelake.streaming.refresh import GoldRefresh
from support import SF0001


@pytest.fixture(scope="module")
def layers(spark):
    lay = Layers(spark, SF0001)
    cleaned, lookup = scratch_path(spark, "t-cleaned"), scratch_path(spark, "t-lookup")
    S.clean_until(lay.combined).write.parquet(cleaned)
    lay.lookup.write.parquet(lookup)
    return spark.read.parquet(cleaned), spark.read.parquet(lookup)


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _equals_batch(gold, cleaned, lookup):
    silver = S.attach_lookup(cleaned, lookup)
    assert _same(gold.fact(), fct_results(silver))
    assert _same(gold.dimension(DIM_ATHLETE), dim_athlete(silver))
    assert _same(gold.dimension(DIM_EVENT), dim_event(silver))
    assert gold.waiting().count() == cleaned.join(lookup, S.LOOKUP_KEY, "left_anti").count()


def test_any_split_gives_the_batch_tables(spark, layers):
    cleaned, lookup = layers
    rows, codes = scratch_path(spark, "t-rows"), scratch_path(spark, "t-codes")
    ckpt = scratch_path(spark, "t-ckpt")
    gold = GoldRefresh(spark, scratch_path(spark, "t-gold"), codes, buckets=4)
    part = F.pmod(F.xxhash64("athlete_id", "event_name"), F.lit(3))
    code = F.pmod(F.xxhash64("athlete_country"), F.lit(3))
    for k in range(3):
        cleaned.filter(part == k).repartition(2).write.mode("append").parquet(rows)
        if k != 1:  # one refresh brings no code, and one code set comes in last
            lookup.filter(code == k).write.mode("append").parquet(codes)
        gold.run(rows, ckpt, max_files_per_trigger=1, timeout_s=300)
    lookup.filter(code == 1).write.mode("append").parquet(codes)
    gold.run(rows, ckpt, timeout_s=300)
    _equals_batch(gold, cleaned, lookup)
    gold.run(rows, ckpt, timeout_s=300)  # nothing new
    _equals_batch(gold, cleaned, lookup)


def test_repeated_batches_and_replays_add_nothing(spark, layers):
    cleaned, lookup = layers
    codes = scratch_path(spark, "t-codes")
    gold = GoldRefresh(spark, scratch_path(spark, "t-gold"), codes, buckets=4)
    half = F.pmod(F.xxhash64("athlete_country"), F.lit(2)) == 0
    lookup.filter(half).write.parquet(codes)
    gold.batch(cleaned, 0)
    lookup.filter(~half).write.mode("append").parquet(codes)
    gold.batch(cleaned, 0)  # its commit was lost, and the codes came meanwhile
    _equals_batch(gold, cleaned, lookup)
    gold.replay(cleaned.schema)
    _equals_batch(gold, cleaned, lookup)

    # A replay that failed before it was noted is repeated as a whole.
    codes2 = scratch_path(spark, "t-codes")
    again = GoldRefresh(spark, scratch_path(spark, "t-gold"), codes2, buckets=4)
    lookup.filter(half).write.parquet(codes2)
    again.batch(cleaned, 0)
    lookup.filter(~half).write.mode("append").parquet(codes2)
    pending = again._read("pending", cleaned.schema)
    again._gold(S.attach_lookup(pending, lookup).limit(50), "r0")
    again.replay(cleaned.schema)
    again.replay(cleaned.schema)
    _equals_batch(again, cleaned, lookup)


def test_untouched_buckets_keep_their_files(spark, layers):
    cleaned, lookup = layers
    silver = S.attach_lookup(cleaned, lookup)
    state = scratch_path(spark, "t-state")
    merge_dimension(DIM_ATHLETE, silver, state, buckets=8)

    def files():
        return {b: sorted(os.listdir(f"{state}/{b}")) for b in os.listdir(state) if b.startswith(BUCKET)}

    before = files()
    assert len(before) == 8
    new = silver.filter(bucket_of(F.col("athlete_id"), 8).isin(2, 5)).withColumn("athlete_gender", F.lit("A"))
    for _ in range(2):
        merge_dimension(DIM_ATHLETE, new, state, buckets=8)
        after = files()
        assert {b for b in before if before[b] != after[b]} == {f"{BUCKET}=2", f"{BUCKET}=5"}
        assert _same(read_dimension(spark, DIM_ATHLETE, state), dim_athlete(silver.unionByName(new)))


def test_dimension_of_nothing_yet(spark, layers):
    cleaned, lookup = layers
    silver = S.attach_lookup(cleaned, lookup)
    state = scratch_path(spark, "t-state")
    merge_dimension(DIM_EVENT, silver.limit(0), state)
    merge_dimension(DIM_EVENT, silver, state)
    assert _same(read_dimension(spark, DIM_EVENT, state), dim_event(silver))
