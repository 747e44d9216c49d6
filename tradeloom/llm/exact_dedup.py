"""Exact dedup against a persistent digest index (DataFrame and SQL functions only).

The index is a table bucketed and sorted by the SHA-256 digest of a text. A batch of new documents
is first folded to one row per digest (partial aggregation, so a text that makes up a third of the
batch costs one row per task), then sort-merge anti-joined with the index: the index side is read
bucket by bucket, without a shuffle. Digests that the index lacks are appended. An append that is
repeated after a failure adds nothing, because the anti-join sees what is already there.

Defined results
    null text        counts as the empty text, and equals it
    null id          sorts below every id; a group of null ids only has a null ``keep_id``
    repeated rows    rows with the same id and text are one document: each is marked kept if that id
                     stays, and ``filter`` returns it once
    ties             of equal texts the row with the largest id stays
    earlier batches  a digest found in the index keeps the row of the earlier batch
    empty table      no rows
    extra columns    are never read; clashing names are not a problem
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import select_documents, staged, text_digest
from tradeloom.session import shared_dir

LAYOUT = "digest BINARY, keep_id BIGINT"


class DigestIndex:
    """A bucketed, sorted table of digests at ``path``, with the id of the document that stays.

    ``buckets`` is fixed when the index is made; size it so that a bucket's digests of one append
    (about 45 bytes each) sort in an executor's memory: 16,384 buckets hold 1e11 digests.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16_384) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({LAYOUT}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (one per ``digest``) that the index lacks."""
        return batch.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Add the digests that are new. One sorted file per bucket and append: rows are dealt by
        the bucket function first."""
        (
            self.missing(batch)
            .select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def decide(
    docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id``, ``digest``, ``keep_id``, ``group_size`` (rows of this batch with
    the text), ``kept``. New digests are in the index afterwards; without ``index`` a fresh one is
    made in the shared folder."""
    spark = docs.sparkSession
    if index is None:
        path = f"{shared_dir(spark)}/digests-{uuid.uuid4().hex[:12]}"
        index = DigestIndex(spark, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = staged(
        docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest")),
        "digests",
    )
    batch = rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    fresh = staged(
        index.missing(batch).select("digest", "keep_id", "group_size", F.lit(True).alias("is_new")), "fresh"
    )
    index.append(fresh)
    known = (
        batch.drop("keep_id")
        .join(fresh.select("digest"), "digest", "left_anti")
        .join(index.read(), "digest")
        .select("digest", "keep_id", "group_size", F.lit(False).alias("is_new"))
    )
    # Written first, so that both sides of this join are plain shuffles: adaptive execution can then
    # split a hot digest among several tasks.
    keepers = staged(fresh.unionByName(known), "keepers")
    return rows.join(keepers, "digest").select(
        "id",
        "digest",
        "keep_id",
        "group_size",
        (F.col("is_new") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
    )


def dedup(
    docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without rows whose text is in the index or belongs to a row with a larger id."""
    kept = (
        decide(docs, index, id_col, text_col).where("kept").groupBy("id", "digest").agg(F.count("*").alias("n"))
    )
    return select_documents(docs, kept, id_col, text_col)
