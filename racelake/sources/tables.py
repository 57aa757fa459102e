"""Table and catalog sources: named-table scans, file listings, catalog
listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """``FROM <name>``: a table or view by name (Spark SQL accepts the bare
    FROM form)."""
    return spark.sql(f"FROM {name}")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files directly inside ``folder`` with their size (the file contents
    are not read: only path and length are selected)."""
    return (spark.read.format("binaryFile").load(folder)
                 .select("path", "length", "modificationTime"))


def stream_files(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming listing of the files that arrive in a growing folder: the
    ``path`` to read one by (a path pattern, so signs of patterns in names
    are escaped) and ``file``, as ``_metadata.file_path`` of its rows has
    it. Contents are not read; an empty file is not listed."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    literal = F.regexp_replace("path", r"([\\{}\[\]*?])", r"\\$1")
    return reader.load(folder).select(literal.alias("path"), F.col("_metadata.file_path").alias("file"))


def ensure_databases(spark: SparkSession, names, location_root: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for each name (under a given root
    folder when one is passed)."""
    for n in names:
        loc = f" LOCATION '{location_root.rstrip('/')}/{n}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}{loc}")


def use_database(spark: SparkSession, name: str) -> str:
    """``USE name``; returns the previous current database so callers can
    switch back."""
    previous = spark.catalog.currentDatabase()
    spark.sql(f"USE {name}")
    return previous


def list_catalogs(spark: SparkSession) -> DataFrame:
    """``SHOW CATALOGS``: the catalogs of this session (``catalog``)."""
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession, catalog: str, pattern: str = "*") -> DataFrame:
    """``SHOW SCHEMAS IN catalog LIKE pattern`` (``namespace``)."""
    text = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return spark.sql(f"SHOW SCHEMAS IN {quoted(catalog)} LIKE '{text}'")


def quoted(name: str) -> str:
    """An identifier in back quotes."""
    return "`" + name.replace("`", "``") + "`"


def schema_inventory(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """One row per schema of every catalog whose name fits ``pattern``:
    ``catalog``, ``schema``, ``num_tables`` and ``num_rows`` of its tables.

    Names are catalog metadata and pass through the driver; the rows are
    counted by Spark, one aggregate per table in one job."""
    out = None
    for c in list_catalogs(spark).collect():
        for row in list_schemas(spark, c.catalog, pattern).collect():
            schema = f"{quoted(c.catalog)}.{quoted(row.namespace)}"
            one = (table_inventory(spark, schema)
                   .agg(F.count("table_name").alias("num_tables"),
                        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_rows"))
                   .select(F.lit(c.catalog).alias("catalog"), F.lit(row.namespace).alias("schema"),
                           "num_tables", "num_rows"))
            out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "catalog string, schema string, num_tables bigint, num_rows bigint")
    return out


def table_inventory(spark: SparkSession, database: str) -> DataFrame:
    """One row per table of ``database``: name, comment and row count.

    The table list is catalog metadata (a handful of names); the row counts
    are aggregations run in one job over the union of the tables."""
    out = None
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        one = (spark.table(f"{database}.{t.name}").agg(F.count(F.lit(1)).alias("num_rows"))
                    .select(F.lit(database).alias("database"), F.lit(t.name).alias("table_name"),
                            F.lit(t.description).cast("string").alias("comment"), "num_rows"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame(
            [], "database string, table_name string, comment string, num_rows bigint")
    return out
