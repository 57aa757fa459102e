"""Data profiling: shape, null counts, distinct counts, numeric summaries.

All profiles are single aggregations that return DataFrames; nothing is
collected to the driver except the column list (schema metadata). Results
are "long" (one row per column), produced with ``stack`` over the one-row
aggregate, so they stay distributed and need no join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelake.operators.shape import NUMERIC_TYPE_PREFIXES, select_by_type


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit_sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unpivot(one_row: DataFrame, names: list[str], value_cols: list[str],
             value_type: str = "bigint") -> DataFrame:
    """Turn a one-row aggregate ``<col>__<stat>`` into one row per column."""
    args = []
    for i, n in enumerate(names):
        args.append(_lit_sql(n))
        args.append(str(i + 1))
        args.extend(f"CAST({_q(n + '__' + v)} AS {value_type})" for v in value_cols)
    cols = ", ".join(["column_name", "ordinal", *value_cols])
    return one_row.selectExpr(f"stack({len(names)}, {', '.join(args)}) AS ({cols})")


def shape(df: DataFrame) -> DataFrame:
    """Row count and, per column, position, name and type."""
    names = df.columns
    types = [t for _, t in df.dtypes]
    agg = df.agg(F.count(F.lit(1)).alias("num_rows"))
    args = []
    for i, (n, t) in enumerate(zip(names, types)):
        args += [_lit_sql(n), str(i + 1), _lit_sql(t)]
    return agg.selectExpr(
        "num_rows", f"{len(names)} AS num_columns",
        f"stack({len(names)}, {', '.join(args)}) AS (column_name, ordinal, data_type)")


def null_counts(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """NULL count per column in one pass; by default only the
    columns that have NULLs."""
    names = df.columns
    one = df.agg(*[F.count_if(F.col(_q(n)).isNull()).alias(f"{n}__nulls") for n in names])
    out = _unpivot(one, names, ["nulls"])
    return out.filter(F.col("nulls") > 0) if only_with_nulls else out


def distinct_counts(df: DataFrame) -> DataFrame:
    """D3: exact distinct values per column, without NULL (``num_distinct``)
    and with NULL as a value (``num_distinct_with_null``). Every column has a
    row, also if it is all NULL or the table is empty (both counts 0 there).

    Written as an unpivot to (column, value) followed by two aggregations,
    so every column's distinct set is deduplicated map-side and spread over
    the shuffle by (column, value); a hot value costs one row per task."""
    names = df.columns
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(1).alias("seen"),
                 F.col(_q(n)).cast("string").alias("value"))
        for i, n in enumerate(names)])).alias("p")).select("p.*").distinct()
    # One row per column that is no value of the table, so no column vanishes.
    every = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(0).alias("seen"),
                 F.lit(None).cast("string").alias("value"))
        for i, n in enumerate(names)])).alias("p")).select("p.*")
    return (pairs.unionAll(every).groupBy("ordinal", "column_name")
                 .agg(F.count("value").alias("num_distinct"),
                      F.sum("seen").alias("num_distinct_with_null")))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(F.col(_q(column))).distinct()


def numeric_summary(df: DataFrame, type_prefixes=NUMERIC_TYPE_PREFIXES,
                    digits: int = 6) -> DataFrame:
    """Count / mean / stddev / min / max of every numeric column, one
    row per column (exact aggregates; mean and stddev rounded)."""
    num = select_by_type(df, type_prefixes)
    names = num.columns
    stats = []
    for n in names:
        c = F.col(_q(n)).cast("double")
        stats += [F.count(c).alias(f"{n}__count"),
                  F.round(F.avg(c), digits).alias(f"{n}__mean"),
                  F.round(F.stddev_samp(c), digits).alias(f"{n}__stddev"),
                  F.min(c).alias(f"{n}__min"), F.max(c).alias(f"{n}__max")]
    one = num.agg(*stats)
    out = _unpivot(one, names, ["count", "mean", "stddev", "min", "max"], "double")
    return out.withColumn("count", F.col("count").cast("bigint"))


# Ranges that a round of exact rank selection counts per wanted rank.
SLICES = 1024


def numeric_quartiles(df: DataFrame, type_prefixes=NUMERIC_TYPE_PREFIXES,
                      quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """The quartiles of ``summary()`` for every numeric column, exactly: the
    value at rank ceil(q * n) of the n values that are neither NULL nor NaN
    (NULL if there are none), one row per column.

    Ranks are selected by counting, not by sorting: each round cuts the range
    a wanted rank lies in into SLICES equal parts, counts the values in each
    part (partial sums per task, at most SLICES rows per rank are shuffled)
    and goes on with the part that holds the rank, shrunk to its smallest and
    largest value, until these are one. All columns and ranks share a round,
    which is one pass over ``df`` (pass a written table); a range shrinks a
    thousandfold a round, so ordinary data takes three or four."""
    num = select_by_type(df, type_prefixes)
    names = num.columns
    spark = df.sparkSession
    labels = [f"p{round(100 * q):d}" for q in quantiles]
    rows = num.select(*[F.col(_q(n)).cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    rows = rows.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in rows.columns])
    first = rows.agg(*[f(c).alias(f"{c}_{k}") for c in rows.columns
                       for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first() if names else None
    # Wanted rank -> (smallest, largest value it can be, values below these).
    open_, done = {}, {}
    for i in range(len(names)):
        n, lo, hi = (first[f"c{i}_{k}"] for k in ("n", "lo", "hi"))
        for label, q in zip(labels, quantiles):
            if n and lo < hi:
                open_[i, label] = (lo, hi, max(math.ceil(q * n), 1))
            else:
                done[i, label] = lo
    while open_:
        found = _count_slices(rows, open_)
        for (i, label), (lo, hi, rank) in found.items():
            if lo == hi:
                done[i, label] = lo
        open_ = {k: v for k, v in found.items() if k not in done}
    data = [(n, i + 1, *[done[i, x] for x in labels]) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "column_name string, ordinal int, " + ", ".join(f"{x} double" for x in labels))


def _count_slices(rows: DataFrame, wanted: dict) -> dict:
    """One round: per wanted rank the range of the slice that holds it and
    its rank there."""
    def entry(i, label, lo, hi):
        c = F.col(f"c{i}")
        # Halved first, so that the width of no range overflows.
        part = F.least(F.floor((c / 2 - lo / 2) / (hi / 2 - lo / 2) * SLICES), F.lit(SLICES - 1))
        return F.when(c.between(lo, hi), F.struct(
            F.lit(i).alias("i"), F.lit(label).alias("label"), part.alias("part"), c.alias("v")))
    entries = [entry(i, label, lo, hi) for (i, label), (lo, hi, _) in wanted.items()]
    counts = (rows.select(F.explode(F.array(*entries)).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
              .groupBy("i", "label", "part").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    before = Window.partitionBy("i", "label").orderBy("part")
    ranks = F.create_map(*[x for (i, label), (_, _, r) in wanted.items()
                           for x in (F.lit(f"{i}/{label}"), F.lit(r))])
    counts = counts.withColumn("upto", F.sum("n").over(before)).withColumn(
        "rank", ranks[F.concat_ws("/", F.col("i").cast("string"), "label")])
    hit = counts.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    return {(r.i, r.label): (r.lo, r.hi, r["rank"] - (r.upto - r.n)) for r in hit.collect()}


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in the given order (all columns by default,
    so the preview is the same on every run). Planned as a top-k: each task
    keeps its best ``n`` rows and only those are merged."""
    cols = order_by or df.columns
    return df.orderBy(*[F.col(_q(c)).asc_nulls_first() for c in cols]).limit(n)


def count_by_key(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """A3: rows per key value (NULL is a key of its own)."""
    return df.groupBy(F.col(_q(key)).alias(key)).agg(F.count(F.lit(1)).alias(name))


def top_keys(df: DataFrame, key: str, k: int = 20, name: str = "count") -> DataFrame:
    """The ``k`` most frequent key values (ties by key)."""
    return (count_by_key(df, key, name)
            .orderBy(F.desc(name), F.col(_q(key)).asc_nulls_first()).limit(k))
