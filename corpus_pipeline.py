"""A corpus pipeline of five stages, each over all its predecessor kept.

Quality rules drop documents, SimHash keeps one document of each group of
near duplicates, decontamination drops documents with benchmark passages,
personal data is replaced by its kind, and the rest is encoded and decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import bpe, decontam, pii, rules, simhash
from racelake.llm.common import stored
from racelake.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps, columns unchanged."""
    name, = _free_names(docs, 1)
    rows = rules.with_ledger(docs, name=name)
    return rows.filter(rules.keeps(F.col(name)["failed"])).drop(name)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest doc_id (NULL last),
    then of smallest text hash; of rows that repeat it, one."""
    groups = simhash.near_duplicates(docs)
    first = groups.groupBy("group_fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("text_hash").alias("t"))).alias("m"))
    keys = first.select(F.col("m.i").alias("doc_id"), F.col("m.t").alias("text_hash"))
    names = _free_names(docs, 2)
    return (_with_key(docs, names).join(_key(keys, names), names, "left_semi")
            .dropDuplicates(names).drop(*names))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(docs, bench).filter("contaminated")
    names = _free_names(docs, 2)
    return _with_key(docs, names).join(_key(found, names).distinct(), names, "left_anti").drop(*names)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows
    the new text where there is such a column."""
    out = pii.redact(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of ids and the digests of ids and decoded text."""
    return bpe.digest(docs, tokenizer_path())


def _free_names(docs: DataFrame, n: int) -> list[str]:
    """Column names that ``docs`` does not have, in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    free = (f"stage_column_{i}" for i in range(n + len(taken)))
    return [c for c in free if c not in taken][:n]


def _with_key(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with two columns that name a document: rows that share both
    are equal in id and text."""
    return docs.withColumns({
        names[0]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        names[1]: F.xxhash64(F.coalesce("text", F.lit("")))})


def _key(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(names[0]),
                       F.col("text_hash").alias(names[1]))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii_redaction),
    ("bpe", bpe_round_trip),
]

# SimHash's linked groups, the network and the merges are beyond SQL; the
# stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    checkpoint folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
