"""Exact duplicates against a persistent digest index.

The index is a Parquet table of digests, bucketed and sorted by digest. A batch is
reduced to one row per digest, moved to the buckets of the index, compared with a
sort-merge anti-join that reads the index where it lies, and the new digests are
appended. Only digests and ids are shuffled, never texts. ``drop_duplicates`` drops rows
by their place in the files of a stored table; other input is first written with numbers.

Every digest carries the batch that brought it. Digests of the same batch count as new, so
a job that died after its batch was appended can be started again under the same name and
keeps the same rows. Calls without a batch name are batches of their own.

Edge cases: a null text counts as empty, so all null and empty texts are copies of
each other. Of equal texts the row with the largest id stays (a null id is the
smallest; of rows that agree in the id too, the first of the table). Repeated rows
are copies like any other. An empty table gives an empty result. Other columns of
the input are not looked at, and whatever their names are, they are kept by
``drop_duplicates``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm.common import ascii_lower, placed_rows, text_of
from flowsift.storage import materialize, new_path, remove

DIGEST = "text_sha256"


class DigestIndex:
    """Digests seen so far, with the id of the row that stands for each and their batch.

    ``path`` names a folder of an earlier session to go on with; ``buckets`` must be
    the number it was made with. Without a path the index is new.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or new_path(spark, "digests")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({DIGEST} STRING, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY ({DIGEST}) SORTED BY ({DIGEST}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def forget(self) -> None:
        """Remove the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        remove(self.spark, [self.path])

    def add(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the digests that are new; give every group its keeper and whether it is new.

        ``groups`` has one row per digest, with ``keep_id``. New is what no other batch has.
        """
        batch = batch or uuid.uuid4().hex
        groups = groups.repartition(self.buckets, DIGEST)
        index = self.rows().withColumn("own", F.col("batch").eqNullSafe(F.lit(batch))).hint("merge")
        others = index.where(~F.col("own")).drop("batch", "own")
        fresh = groups.join(others, DIGEST, "left_anti").withColumn("is_new", F.lit(True))
        known = groups.drop("keep_id").join(others, DIGEST).withColumn("is_new", F.lit(False))
        marked = materialize(fresh.unionByName(known), "marked")
        (
            marked.where("is_new")
            .select(DIGEST, "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, DIGEST)
            .join(index.where("own").select(DIGEST), DIGEST, "left_anti")
            .write.bucketBy(self.buckets, DIGEST)
            .sortBy(DIGEST)
            .format("parquet")
            .mode("append")
            .saveAsTable(self.table)
        )
        return marked


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_cols: list[str] | None = None) -> DataFrame:
    """``row``, ``doc_id`` and the SHA-256 of the text with A-Z lower-cased.

    ``row_cols`` tell rows apart. Without them rows are numbered in this scan, for it only.
    """
    row = [F.col(c) for c in row_cols] if row_cols else [F.monotonically_increasing_id().alias("n")]
    return docs.select(
        F.struct(*row).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.sha2(ascii_lower(text_of(f"`{text_col}`")), 256).alias(DIGEST),
    )


def find_duplicates(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text",
                    row_cols: list[str] | None = None, batch: str | None = None) -> DataFrame:
    """One row per document: its digest, the id that stays, the group's size and whether it stays.

    With an index of other batches, a digest known before keeps no row of this batch.
    """
    held = index or DigestIndex(docs.sparkSession)
    rows = materialize(digests(docs, id_col, text_col, row_cols), "row_digests")
    # Of equal ids the first row: the largest of the numbers' complements.
    back = F.struct(*[F.bitwise_not(f"row.`{f.name}`").alias(f.name) for f in rows.schema["row"].dataType.fields])
    groups = rows.groupBy(DIGEST).agg(F.max(F.struct("doc_id", back.alias("back"))).alias("top"), F.count("*").alias("group_size"))
    groups = groups.select(DIGEST, "group_size", F.col("top.doc_id").alias("keep_id"), F.col("top.back").alias("keep_back"))
    marked = held.add(groups, batch)
    if index is None:
        held.forget()
    # Adaptive execution splits the digest of a large group of copies in this join.
    return rows.join(marked, DIGEST).select(
        "row", "doc_id", "keep_id", "group_size", (F.col("is_new") & (back == F.col("keep_back"))).alias("kept"), DIGEST
    )


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text",
                    batch: str | None = None, stored: bool = False) -> DataFrame:
    """The rows that stay, with all their columns. ``stored``: see ``placed_rows``."""
    rows, place = placed_rows(docs, "dedup_rows", stored)
    found = find_duplicates(rows, index, id_col, text_col, place, batch)
    dropped = materialize(found.where(~F.col("kept")).select("row.*"), "dropped_rows")
    return rows.join(dropped, place, "left_anti").drop(*place)
