"""Expressions and helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsift.storage import materialize

# White space that separates words, as a class for Java and Python.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than the six ASCII spaces."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII only take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored_rows(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once with a row number, and the name of the number's column.

    Numbers are unique. They follow the file splits of the one scan that makes them, and
    splits depend on the executors at hand, so another scan may number rows otherwise:
    later steps read the written column.
    """
    taken, column = {c.lower() for c in df.columns}, "_row_no"
    while column in taken:
        column = f"_{column}"
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name), column


def placed_rows(df: DataFrame, name: str, stored: bool = False) -> tuple[DataFrame, list[str]]:
    """``df`` with a number that tells its rows apart in every scan, and the column's name in a list.

    ``stored=True`` states that ``df`` reads Parquet files, maybe through filters and
    projections: a row's number is made of that of its file, in the order of their paths, and
    its place in the file. That does not depend on file splits, and no row is written. The
    numbers of files are one row per file, as many as the driver lists to plan the scan, so
    they are broadcast. Otherwise rows are stored with a number.
    """
    if not stored:
        rows, column = stored_rows(df, name)
        return rows, [column]
    taken, column = {c.lower() for c in df.columns}, "_row_no"
    while column in taken:
        column = f"_{column}"
    path = df.metadataColumn("_metadata")["file_path"]
    order = Window.partitionBy(F.lit(0)).orderBy(f"{column}_file")
    files = df.select(path.alias(f"{column}_file")).distinct()
    files = materialize(files.withColumn(f"{column}_of", F.row_number().over(order).cast("long")), "files")
    rows = df.select("*", path.alias(f"{column}_file"), df.metadataColumn("_metadata")["row_index"].alias(f"{column}_at"))
    rows = rows.join(F.broadcast(files), f"{column}_file", "left")
    number = F.shiftleft(F.col(f"{column}_of"), 33) + F.col(f"{column}_at")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(column)), [column]
