"""Places, ranks and running totals in the order of a table, without one giant partition.

The table is written in order, as many range partitions as the session shuffles with.
A row's place is the number of its partition and its number inside; what earlier
partitions hold in front of it is one row per partition, so it can be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.storage import materialize

# Fixed value: bits that monotonically_increasing_id leaves to the rows of a partition.
_ROW_BITS = 33
PLACE, _PART = "_place", "_part"


def in_order(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` stored in the given order with its place in ``_place``, ascending in that order.

    Rows that agree in every key of ``order`` share a partition, so ``order`` should end
    with a key that tells them apart. Range partitions are found by a pass of their own:
    pass a stored table. The result is stored, so places stay as they are.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(placed.withColumn(PLACE, F.monotonically_increasing_id()), "in-order")


def _part() -> Column:
    return F.shiftright(PLACE, _ROW_BITS)


def _with_earlier(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """``placed`` with ``_part`` and, per name, the total over earlier partitions."""
    before = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    per_part = placed.groupBy(_part().alias(_PART)).agg(*[total.alias(name) for name, total in totals.items()])
    earlier = per_part.select(_PART, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in totals])
    # One row per partition, whatever the table holds.
    return placed.withColumn(_PART, _part()).join(F.broadcast(earlier), _PART)


def with_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add ``name``: the number of rows before this one in the given order, from 0."""
    ranked = _with_earlier(in_order(df, order), {"_before": F.count(F.lit(1))})
    inside = F.col(PLACE).bitwiseAND((1 << _ROW_BITS) - 1)
    return ranked.select(*df.columns, (F.col("_before") + inside).alias(name))


def running_totals(
    df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = True, buckets: int | None = None, stored: bool = False
) -> DataFrame:
    """Add ``cum_<column>``: inclusive running sums in the order of ``order_col``.

    ``df`` holds one row per distinct ``order_col`` (aggregate first), so no partition can
    be hot. ``buckets`` is the number of range partitions, by default that of the session;
    ``stored=True`` states that ``df`` reads a stored table.
    """
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    values = df if stored else materialize(df, "per-value")
    summed = _with_earlier(in_order(values, [order], buckets), {f"_b_{c}": F.sum(c) for c in sum_cols})
    inside = Window.partitionBy(_PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    return summed.select(*df.columns, *[(F.sum(c).over(inside) + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in sum_cols])
