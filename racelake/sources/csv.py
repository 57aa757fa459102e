"""CSV sources: schema probe, batch scan, streaming directory scan.

Only the files directly inside a folder are read (no recursive lookup), so
feeds kept in sub-folders of a landing root stay separate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from racelake.schemas import CSV_OPTIONS


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Batch probe: the schema Spark infers from a CSV file or folder."""
    return (spark.read.options(**CSV_OPTIONS).option("inferSchema", True)
                 .option("samplingRatio", sampling_ratio).csv(path).schema)


def schema_as_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """A schema as a DataFrame (column_name, ordinal, data_type)."""
    rows = [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "column_name string, ordinal int, data_type string")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch scan with an explicit schema (no inference pass)."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_csv_stream(spark: SparkSession, folder: str, schema: StructType,
                    max_files_per_trigger: int | None = None,
                    archive_dir: str | None = None) -> DataFrame:
    """Streaming scan of a growing folder of CSV files.

    ``max_files_per_trigger`` bounds each micro-batch. With ``archive_dir``
    processed files are moved there after their batch commits
    (``cleanSource=archive``), so the folder listing done on every trigger
    stays proportional to the new files rather than to the whole history."""
    reader = spark.readStream.options(**CSV_OPTIONS).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(folder)


CORRUPT, FILE = "_corrupt_record", "_source_file"
# Why rows are in quarantine.
WRONG_HEADER, BAD_RECORD = "header", "record"


def read_csv_strict(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Batch scan that fails if a file's header differs from the schema or a
    record does not fit it (no extra pass; the choice where a stray file
    should stop the job)."""
    return (spark.read.options(**CSV_OPTIONS).option("enforceSchema", False).option("mode", "FAILFAST")
                 .schema(schema).csv(path))


def header_report(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """One row per file: ``file`` and ``conforms``, whether the file begins
    with the header that ``schema`` asks for.

    Lines are compared as text (byte order mark, quotes and spaces beside
    commas aside) and only in the split that begins a file; a file without
    that line there does not conform. An empty file has no line and no row:
    it has no records either."""
    wanted = ",".join(schema.fieldNames())
    line = F.regexp_replace(F.regexp_replace("value", "^\\uFEFF|\"", ""), " *, *", ",")
    # Tidying only takes characters away: a shorter line is no header.
    long_enough = F.octet_length("value") >= len(wanted.encode())
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    ((F.col("_metadata.file_block_start") == 0) & long_enough & (F.trim(line) == wanted))
                    .alias("is_header"))
            .groupBy("file").agg(F.max("is_header").alias("conforms")))


def _with_bad_records(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def checked_options(reader, schema: StructType):
    """A reader that keeps records which do not fit (a wrong number of
    fields, text that is no number or date) as text beside NULL fields."""
    return (reader.options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(_with_bad_records(schema)))


def read_rows_checked(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Batch scan with ``checked_options``; FILE is each row's file."""
    return checked_options(spark.read, schema).csv(path).withColumn(FILE, F.col("_metadata.file_path"))


def split_checked(rows: DataFrame, headers: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine) of rows read with ``checked_options`` that
    carry their file in FILE; ``headers`` as ``header_report`` gives them."""
    told = rows.join(headers.select(F.col("file").alias(FILE), "conforms"), FILE, "left")
    return split_told(told, F.col("conforms"), schema)


def split_told(rows: DataFrame, conforms: Column, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``split_checked`` by the verdict ``conforms`` on the header of a row's
    file. Quarantine: ``file``, ``reason``, ``record`` (the line as it was if
    Spark kept it, else the fields as JSON)."""
    fields = [F.col(f"`{n}`") for n in schema.fieldNames()]
    stray = ~F.coalesce(conforms, F.lit(False))
    reason = F.when(stray, WRONG_HEADER).when(F.col(CORRUPT).isNotNull(), BAD_RECORD)
    told = rows.withColumn("reason", reason)
    bad = told.filter(F.col("reason").isNotNull()).select(
        F.col(FILE).alias("file"), "reason", F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*fields))).alias("record"))
    return told.filter(F.col("reason").isNull()).select(*fields), bad


def read_csv_checked(spark: SparkSession, path, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine) of a batch scan. A file with another
    header goes to quarantine whole, also if its records happen to fit the
    schema's types; nothing is dropped: every record is in one of the two."""
    rows = read_rows_checked(spark, path, schema)
    # Spark converts, and so checks, only the columns a query reads: the
    # metric reads all of them, whatever is selected later.
    fields = [F.col(f"`{n}`") for n in schema.fieldNames()]
    rows = rows.observe(f"checked_csv_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"),
                        F.count(CORRUPT).alias("bad_records"), F.max(F.xxhash64(*fields)).alias("fields"))
    return split_checked(rows, header_report(spark, path, schema), schema)


def quarantine_counts(bad: DataFrame) -> DataFrame:
    """Rows in quarantine per file and reason."""
    return bad.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("num_rows"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as header CSV files (a landing folder for tests and
    demos), one per input partition."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
