"""Unique, repeatable row identities.

Repeated rows are found by their digests: 12 bytes a row are counted, nothing else is
shuffled. Only rows with a repeated digest get a number, and they are told apart by their
place in the files that are read, so no row moves to get its id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.running import with_rank
from flowsift.storage import materialize

# Bits that tell which keys may occur, at least and at most: 8 kB and 16 MB.
KEY_BITS = (1 << 16, 1 << 27)
# Copies of one row that a single task writes out.
COPIES_PER_TASK = 100_000


def number_copies(df: DataFrame, name: str = "copy_no", per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Number the copies of each distinct row from 0.

    Rows are counted per distinct value (combined before the shuffle, so a row
    that makes up a third of the table travels as one row per map task) and
    written out again ``count`` times. Counts above ``per_task`` are cut into
    ranges that are spread over tasks before they are written out.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    few = counted.where(F.col("__n") <= per_task).withColumn("__from", F.lit(0).cast("bigint"))
    many = (
        counted.where(F.col("__n") > per_task)
        .withColumn("__from", F.explode(F.expr(f"sequence(0L, __n - 1L, {per_task}L)")))
        .repartition(F.col("__from"), *cols)
    )
    last = F.least(F.col("__n"), F.col("__from") + F.lit(per_task)) - 1
    return few.unionByName(many).select(*cols, F.explode(F.sequence(F.col("__from"), last)).alias(name))


def content_hash(cols: list[str]) -> Column:
    """24 hex digits of SHA-256 over the columns; null and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("\u001f", *parts), 256), 1, 24)


_NARROW = re.compile(r"^[\s:+|-]*(Project|Filter|SubqueryAlias|Relation|View)\b")


def _reads_files(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of a file: nothing but filters and projections over a scan."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return False
    lines = plan.queryExecution().analyzed().toString().strip().splitlines()
    return all(map(_NARROW.match, lines)) and "Relation" in lines[-1] and bool(df.inputFiles())


def located(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that tell its rows apart in every scan, and their names.

    Over files that is a hash of the file's path and the row's number in the file, which do
    not depend on file splits. Other tables are written once with a number.
    """
    if _reads_files(df):
        place = df.metadataColumn("_metadata")
        rows = df.select("*", F.xxhash64(place["file_path"]).alias("__file"), place["row_index"].alias("__row"))
        return rows, ["__file", "__row"]
    return materialize(df.withColumn("__row", F.monotonically_increasing_id()), "located-rows"), ["__row"]


def _digest(cols: list[str]) -> Column:
    return F.unhex(content_hash(cols))


def _numbered(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """``rows`` (``keys`` and ``place``) with ``copy_no`` from 0 in each group of equal keys, in place order."""
    order = [*(F.col(k).asc_nulls_first() for k in keys), *(F.col(c).asc() for c in place)]
    ranked = with_rank(materialize(rows, "repeated-rows"), order)
    first = ranked.groupBy(*keys).agg(F.min("rank").alias("__first"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    met = ranked.alias("r").join(first.alias("f"), same)
    return met.select(*[F.col(f"r.{c}").alias(c) for c in (*keys, *place)], (F.col("rank") - F.col("__first")).alias("copy_no"))


def with_flow_id(df: DataFrame, prefix: str) -> DataFrame:
    """Add ``flow_id`` = prefix, content hash and copy number.

    The id depends on the row alone: re-running a job, or re-running a lost task, gives the
    same ids. Copies beyond the first of a row are joined to their numbers by place; Spark
    broadcasts these where they are few, and nothing is joined where there are none.
    """
    cols = df.columns
    rows, place = located(df)
    digests = rows.select(*place, _digest(cols).alias("__digest"))
    repeated = digests.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__digest")
    repeated = materialize(repeated, "repeated-digests")
    copy_no = F.lit(0)
    if not repeated.isEmpty():
        numbers = _numbered(digests.join(repeated, "__digest"), ["__digest"], place).where("copy_no > 0")
        rows = rows.join(materialize(numbers.select(*place, "copy_no"), "copy-numbers"), place, "left")
        copy_no = F.coalesce("copy_no", F.lit(0))
    flow_id = F.concat_ws("-", F.lit(prefix), content_hash(cols), copy_no.cast("string"))
    return rows.select(flow_id.alias("flow_id"), *cols)


def with_position_id(df: DataFrame, prefix: str) -> DataFrame:
    """Add ``flow_id`` = prefix and row position: unique within ``df``, no shuffle.

    For a scan of files the position is the same when a task runs again. It
    depends on the file splits, so another layout of the files gives other ids;
    use :func:`with_flow_id` where ids must survive that.
    """
    position = F.lower(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    return df.select(F.concat_ws("-", F.lit(prefix), position).alias("flow_id"), *df.columns)


def has_repeated_key(df: DataFrame, key: str) -> bool:
    """Whether any value of ``key`` occurs twice or is null (one combined shuffle of the key)."""
    repeated = (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull()).limit(1)
    )
    return not repeated.isEmpty()


def may_be_among(keys: DataFrame, key: str, n_rows: int) -> Callable[[Column], Column] | None:
    """A test for rows of another table: false only for keys that ``keys`` does not hold.

    One bit per slot of a hash, in bounded room whatever ``n_rows``, the rows to expect at most.
    Equal keys, null ones too, share a slot, so all rows of a key pass or none does. None where
    most slots are taken, as the test would keep most rows.
    """
    least, most = KEY_BITS
    bits = min(max(1 << (2 * n_rows).bit_length(), least), most)

    def slot(k: Column) -> Column:
        return F.xxhash64(k).bitwiseAND(bits - 1)

    words = keys.select(slot(F.col(key)).alias("s")).groupBy(F.shiftright("s", 6).alias("at"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, CAST(s & 63 AS INT)))").alias("word")).toArrow()
    taken = np.zeros(bits >> 6, dtype=np.uint64)
    taken[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    if int(np.bitwise_count(taken).sum()) > bits // 2:
        return None
    shared = keys.sparkSession.sparkContext.broadcast(taken)

    @F.arrow_udf("boolean")
    def is_taken(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            s = batch.to_numpy(zero_copy_only=False)
            yield pa.array((shared.value[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return lambda k: is_taken(slot(k))


def with_occurrence(df: DataFrame, key: str, name: str = "occurrence") -> DataFrame:
    """Add ``name``: how many rows with the same key stand before this one in the files; 0 where keys are unique."""
    rows, place = located(df)
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("__repeated"))
    repeated = materialize(repeated, "repeated-keys")
    if repeated.isEmpty():
        return df.withColumn(name, F.lit(0).cast("bigint"))
    narrow = rows.select(*place, F.col(key).alias("__key"))
    among = narrow.join(repeated, F.col("__key").eqNullSafe(F.col("__repeated"))).drop("__repeated")
    numbers = _numbered(among, ["__key"], place).where("copy_no > 0").select(*place, "copy_no")
    numbered = rows.join(materialize(numbers, "occurrences"), place, "left")
    return numbered.select(*df.columns, F.coalesce("copy_no", F.lit(0)).cast("bigint").alias(name))


def with_row_key(df: DataFrame, key: str = "flow_id", name: str = "row_key") -> DataFrame:
    """Add a unique ``name``: the key itself, or for rows whose key is null or repeated the key made unique.

    Cleaning does not check that flow ids are unique. Keys are counted; rows whose key is
    not unique get content hash and copy number behind it, found over their keys, hashes
    and places, and no other row's key changes. No row is dropped.
    """
    cols = df.columns
    rows, place = located(df)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.where((F.col("n") > 1) | F.col(key).isNull()).select(F.col(key).alias("__repeated"))
    repeated = materialize(repeated, "repeated-keys")
    if repeated.isEmpty():
        return df.withColumn(name, F.col(key))
    narrow = rows.select(*place, F.col(key).alias("__key"), _digest(cols).alias("__digest"))
    among = narrow.join(repeated, F.col("__key").eqNullSafe(F.col("__repeated"))).drop("__repeated")
    numbered = _numbered(among, ["__key", "__digest"], place)
    more = F.concat_ws("#", F.lower(F.hex("__digest")), F.col("copy_no").cast("string"))
    endings = materialize(numbered.select(*place, more.alias("__more")), "key-endings")
    # A key that is there stands alone; the others are followed by what tells them apart.
    full = F.when(F.col("__more").isNull(), F.col(key)).otherwise(F.concat_ws("#", F.coalesce(F.col(key), F.lit("")), F.col("__more")))
    # Stored, so that later passes do not join again.
    return materialize(rows.join(endings, place, "left").select(*cols, full.alias(name)), "keyed-flows")
