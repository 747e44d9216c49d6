"""File readers with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.functions import stripped
from tradeloom.schemas import DATA_DICTIONARY_RAW, KAFKA_RECORD, TRANSACTION


def json_array_scan(spark: SparkSession, path: str, schema: StructType = TRANSACTION) -> DataFrame:
    """Records of JSON array documents; an empty result is an error.

    One document is read by one task, so a large set should be landed as many documents.
    """
    rows = spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True)
    if rows.isEmpty():
        raise ValueError(f"no records in {path}")
    return rows


def jsonl_scan(spark: SparkSession, path: str, schema: StructType = TRANSACTION) -> DataFrame:
    """Records of newline-delimited JSON."""
    return spark.read.schema(schema).json(path)


def json_to_jsonl(
    spark: SparkSession, source: str, target: str, schema: StructType = TRANSACTION
) -> int:
    """Rewrite JSON array documents as JSON lines; returns the number of records."""
    json_array_scan(spark, source, schema).write.mode("overwrite").json(target)
    return spark.read.text(target).count()


def csv_staging_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed CSV with a header, every column a string."""
    return spark.read.csv(
        path, schema=schema, header=True, quote='"', escape='"', encoding="UTF-8", lineSep="\n"
    )


def data_dictionary(staged: DataFrame) -> DataFrame:
    """Field metadata without carriage returns and outer spaces."""
    return staged.select(*[stripped(c).alias(c) for c in DATA_DICTIONARY_RAW.fieldNames()])


def data_dictionary_load(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Replace the stored dictionary by the landed one and return it."""
    staged = csv_staging_scan(spark, source, DATA_DICTIONARY_RAW)
    data_dictionary(staged).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def file_event_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of Kafka-shaped records from Parquet files, ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(KAFKA_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def limited_event_source(spark: SparkSession, log: DataFrame, path: str, limit: int) -> DataFrame:
    """Stream of a stored log in micro-batches of at most ``limit`` records.

    The log is landed under ``path`` in files of at most so many records, and a micro-batch takes one of them; a
    topic's own reader has ``maxOffsetsPerTrigger`` instead.
    """
    log.write.mode("overwrite").option("maxRecordsPerFile", limit).parquet(path)
    return file_event_source(spark, path, max_files=1)


def landing_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with their sizes; the content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )
