"""Helpers shared by the corpus operators: table reads, staged tables, words, row selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back.

    Cuts the lineage without tying the result to the executors that computed it: a lost executor
    costs a re-read, not a recomputation. The folder's owner removes old stages.
    """
    path = scratch(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8. ``bytes.split`` splits at exactly these six bytes."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes.lower`` changes no other character."""
    return text.encode().lower().split() if text else []


def text_digest(text: str = "text"):
    """SHA-256 of a text column in UTF-8, null as the empty text, 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def select_documents(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose (id, text digest) is in ``kept`` (columns ``id``, ``digest``, ``n``).

    ``n`` is the number of rows of ``docs`` with that id and text. Rows that repeat both are one
    document and come out once; only they are shuffled whole. Columns and their order stay.
    """
    keys = kept.select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("n").alias("__n")
    )
    found = (
        docs.withColumn("__own", text_digest(text_col))
        .join(keys, (F.col(id_col).eqNullSafe(F.col("__id"))) & (F.col("__own") == F.col("__digest")))
        .drop("__id", "__digest")
    )
    once = found.where("__n = 1").select(docs.columns)
    again = found.where("__n > 1").dropDuplicates([id_col, "__own"]).select(docs.columns)
    return once.unionByName(again)
