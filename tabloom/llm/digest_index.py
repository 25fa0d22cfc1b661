"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. New documents are reduced to one row per
digest, the ones the index lacks are found by a sort-merge anti-join on the shared bucketing, and
those are appended.

Defined results: a null text is empty; empty texts equal one another. A document without doc_id
is equal to others by its text, but yields to any that has one; where none has, keep_id is null.
Rows that repeat a doc_id and a text: exactly one of them is kept. An empty table adds nothing.
Keys are whole numbers, texts or anything else with an order. Other columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.durable import new_folder, written, written_with
from tabloom.llm.common import ascii_lower, fresh, text_of

_LEAST = -(1 << 63)
_WHOLE = ("tinyint", "smallint", "int", "bigint")

#: Digests a bucket is made for, and how many buckets there may be (the catalog takes 100,000 at most).
_BUCKET_ROWS, _FEWEST, _MOST = 1_000_000, 32, 65_536


def text_digest(text: str | Column) -> Column:
    """SHA-256 of a text with A-Z lower-cased, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(text_of(text)), 256))


class DigestIndex:
    """``(digest, keep_id, batch)`` for every distinct text seen, bucketed and sorted by digest.

    ``path`` holds the files; the table is registered under ``name`` for its bucketing. It is made with the first
    batch: keep_id has the type of that batch's key, and there is a bucket for each million of its digests
    (32 to 65,536), or as many as ``buckets`` says. An index that is to grow far beyond its first batch
    should be given the number. One writer at a time.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        if spark.catalog.tableExists(name):
            described = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'").collect()
            self.buckets = int(described[0]["data_type"])

    def make(self, digests: int, key_type: str) -> None:
        """Make the table for a first batch of so many digests, if there is none."""
        if self.spark.catalog.tableExists(self.name):
            return
        self.buckets = self.buckets or min(max(-(-digests // _BUCKET_ROWS), _FEWEST), _MOST)
        self.spark.sql(
            f"create table {self.name} (digest binary, keep_id {key_type}, batch string) using parquet "
            f"clustered by (digest) sorted by (digest) into {self.buckets} buckets location '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id", "batch")
            .write.format("parquet")
            .mode("append")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )

    def forget(self) -> None:
        """Drop the table's name; the files stay at ``path``."""
        self.spark.sql(f"drop table if exists {self.name}")


def _digests(documents: DataFrame, row: Column, text: str, key: str) -> DataFrame:
    return documents.select(F.col(key).alias("id"), text_digest(text).alias("digest"), row.alias("row"))


def _verdicts(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """(digest, keep_id, group_size, kept_row) of every text, and the new ones into the index.

    kept_row is the row that stays, or null where the document that stays is in the index alone.
    """
    batch = uuid.uuid4().hex
    kind = digests.schema["id"].dataType.simpleString()
    if kind in _WHOLE:
        order = F.coalesce(F.col("id").cast("bigint"), F.lit(_LEAST))
        kind = "bigint"
    else:
        order = F.struct(F.col("id").isNotNull(), "id")
    # one row per digest, reduced before the shuffle: copies do not meet in one task
    groups, seen = written_with(
        digests.groupBy("digest").agg(
            F.max("id").cast(kind).alias("top_id"),
            F.max_by("row", order).alias("top_row"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "digest-groups",
        rows=F.count(F.lit(1)),
    )
    index.make(seen["rows"], kind)
    dealt = groups.repartition(index.buckets, "digest")
    new = dealt.join(index.table().hint("merge"), "digest", "left_anti")
    index.append(new.select("digest", F.col("top_id").alias("keep_id"), F.lit(batch).alias("batch")))
    own = (F.col("batch") == batch) | (F.col("keep_id") == F.col("top_id"))
    found = dealt.join(index.table().hint("merge"), "digest")
    return written(
        found.select("digest", "keep_id", "group_size", F.when(own, F.col("top_row")).alias("kept_row")),
        "digest-verdicts",
    )


def deduplicate(documents: DataFrame, index: DigestIndex, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, keep_id, group_size, kept, digest. Adds new texts to ``index``.

    keep_id is the document that stays for this text: the one the index had, or else the largest
    ``key`` among the new ones. group_size counts the equal texts of ``documents``. A document the
    index has under the same ``key`` and text is that document and stays: a batch may be run again.
    """
    digests = written(_digests(documents, F.monotonically_increasing_id(), text, key), "digests")
    verdicts = _verdicts(digests, index)
    # both sides are plain shuffles of stored tables, so that adaptive execution can split a hot digest
    return digests.join(verdicts, "digest").select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
        "digest",
    )


def temporary_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, for one table deduplicated within itself."""
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", new_folder(spark, "digest-index"))


def distinct_documents(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of the documents that stay, all columns as they were.

    Rows are numbered once, in a stored copy, and those that stay are joined by their number: of a
    text that very many rows have, no two rows meet in a task for that.
    """
    index = temporary_index(documents.sparkSession)
    row = fresh(documents, "row")[0]
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    verdicts = _verdicts(_digests(numbered, F.col(row), text, key), index)
    index.forget()
    stays = verdicts.select(F.col("kept_row").alias(row)).hint("merge")  # the same plan at every size
    return numbered.join(stays, row, "left_semi").select(*documents.columns)
