"""Column shaping: renaming, type-based selection, union by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions.names import to_snake_case

NUMERIC_TYPE_PREFIXES = ("tinyint", "smallint", "int", "bigint", "float",
                         "double", "decimal")


def rename_to_snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case, by position (metadata only)."""
    return df.toDF(*[to_snake_case(c) for c in df.columns])


def select_by_type(df: DataFrame, type_prefixes: Iterable[str] = NUMERIC_TYPE_PREFIXES) -> DataFrame:
    """Keep the columns whose simple type name starts with one of the
    prefixes (``decimal`` matches every ``decimal(p,s)``)."""
    prefixes = tuple(type_prefixes)
    keep = [c for c, t in df.dtypes
            if t in prefixes or ("decimal" in prefixes and t.startswith("decimal("))]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def union_by_name(left: DataFrame, right: DataFrame,
                  allow_missing: bool = True,
                  text_columns: Iterable[str] | None = None) -> DataFrame:
    """UNION ALL matched by column name; columns missing on one side are NULL.

    Under ANSI rules Spark widens string+double to double and string+date to
    date, which fails on text such as ``18:00:00``. Columns whose types
    differ and where one side is a string are therefore cast to string on
    both sides first (plus any listed in ``text_columns``).
    """
    ltypes, rtypes = dict(left.dtypes), dict(right.dtypes)
    text = set(text_columns or ())
    for c in set(ltypes) & set(rtypes):
        if ltypes[c] != rtypes[c] and "string" in (ltypes[c], rtypes[c]):
            text.add(c)
    if text:
        left = _cast_columns(left, text & set(ltypes), "string")
        right = _cast_columns(right, text & set(rtypes), "string")
    return left.unionByName(right, allowMissingColumns=allow_missing)


def _cast_columns(df: DataFrame, names: set[str], to: str) -> DataFrame:
    if not names:
        return df
    return df.withColumns({c: F.col(f"`{c}`").cast(to) for c in names})
