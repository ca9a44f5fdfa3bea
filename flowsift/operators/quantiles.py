"""Exact quantiles by radix selection, in one way at every size.

Each value has a 64-bit image that sorts as the doubles do. A pass counts, per group and
column, how many values fall on each digit of ``DIGIT_BITS`` bits; the running count tells
which digit holds a wanted rank, and the next pass looks only at values with that digit.
Four passes read all bits; most columns are done earlier, once the values left for every
rank are equal. Counts are combined before they are shuffled, and a digit's histogram has
at most ``2 ** DIGIT_BITS`` rows. What is wanted and what is known of it are tables, joined
by group and column, so neither the number of groups nor that of rows is limited.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.ordering import from_image, image_value, order_image
from flowsift.storage import materialize

DIGIT_BITS = 16
_PASSES = 64 // DIGIT_BITS
_KEY = ["g", "c"]
# Bounds that a value is compared with; a column with more open digits gets the range from the first to the last.
_BOUNDS = 16
# Open digits of all groups that the driver looks at.
_OPEN_DIGITS = 10_000
Bounds = dict[int, list[tuple[float, float]]]


def _bounds(open_ranks: DataFrame, level: int) -> Bounds | None:
    """Per column the ranges of doubles, ends included, with the digits of its open ranks; None if there are too many."""
    digits = open_ranks.select("c", "digit").distinct().limit(_OPEN_DIGITS + 1).collect()
    if len(digits) > _OPEN_DIGITS:
        return None
    width, found = 1 << (64 - DIGIT_BITS * level), {}
    for r in sorted(digits):
        low, high, ranges = r["digit"] * width, (r["digit"] + 1) * width - 1, found.setdefault(r["c"], [])
        if ranges and ranges[-1][1] + 1 == low:
            low = ranges.pop()[0]
        ranges.append((low, high))
    kept = {c: ranges if len(ranges) <= _BOUNDS else [(ranges[0][0], ranges[-1][1])] for c, ranges in found.items()}
    return {c: [(image_value(low), image_value(high)) for low, high in ranges] for c, ranges in kept.items()}


def _values(df: DataFrame, names: list[str], group: str | None, bounds: Bounds | None = None) -> DataFrame:
    """``g, c, v``: group as text that tells null apart, number of the column, image of the value.

    With ``bounds`` only values inside those of their column.
    """
    key = F.lit("") if group is None else F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    doubles = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(names)]
    narrow, places = df.select(key.alias("g"), *doubles), range(len(names))
    if bounds is not None:
        places = sorted(bounds)

        def inside(i: int) -> Column:
            return reduce(or_, [F.col(f"v{i}").between(low, high) for low, high in bounds[i]])

        narrow = narrow.select("g", *[F.when(inside(i), F.col(f"v{i}")).alias(f"v{i}") for i in places])
        narrow = narrow.where(F.coalesce(*[f"v{i}" for i in places]).isNotNull())
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in places])
    # The image is made behind the cells, so its expression is compiled once and not per column.
    long = narrow.select("g", F.inline(cells).alias("c", "v"))
    if bounds is not None:
        long = long.where("v IS NOT NULL")
    return long.select("g", "c", order_image(F.col("v")).alias("v"))


def _histogram(values: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Rows per digit of the given level, and whether they are all equal."""
    digit = F.shiftright("v", 64 - DIGIT_BITS * (level + 1))
    return values.groupBy(*keys, digit.alias("next")).agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))


def _select(wanted: DataFrame, digits: DataFrame, keys: list[str]) -> DataFrame:
    """The digit of every wanted rank, with what lies below it: ``rank`` counts from its start."""
    below = Window.partitionBy(*keys).orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
    placed = digits.where("n > 0").withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
    inside = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n"))
    found = wanted.join(placed, keys).where(inside)
    return found.select(*_KEY, "place", (F.col("rank") - F.col("below")).alias("rank"), F.col("next").alias("digit"), "least", "most")


def quantile_table(df: DataFrame, columns: dict[str, list[float]], group: str | None = None) -> DataFrame:
    """``grp, column, p, n, value``: quantiles with linear interpolation; nulls and NaN are skipped.

    ``grp`` is the group as text (null without ``group``). A group without values has null
    quantiles, an empty table no rows. ``df`` is read up to four times: pass a stored table
    if it is dear to compute.
    """
    names = list(columns)
    values = _values(df, names, group)
    digits = materialize(_histogram(values, _KEY, 0), "digits")
    sizes = materialize(digits.groupBy(*_KEY).agg(F.sum("n").alias("n")), "quantile-sizes")
    ps = [F.struct(F.lit(i).alias("c"), F.array(*map(F.lit, map(float, columns[c]))).alias("ps")) for i, c in enumerate(names)]
    of_column = F.element_at(F.transform(F.array(*ps), lambda x: x["ps"]), F.col("c") + 1)
    asked = sizes.select("*", F.explode(of_column).alias("p"))
    position = (F.col("n") - 1) * F.col("p")
    lower = F.floor(position)
    asked = asked.withColumns({"lower": lower, "upper": F.least(lower + 1, F.col("n") - 1), "weight": position - lower})
    ranks = asked.where("n > 0").select(*_KEY, F.explode(F.array("lower", "upper")).alias("place")).distinct()
    wanted = ranks.withColumn("rank", F.col("place"))
    state, done = materialize(_select(wanted, digits, _KEY), "ranks"), []
    for level in range(1, _PASSES):
        done.append(state.where("least = most"))
        open_ranks = state.where("least <> most")
        if open_ranks.isEmpty():
            break
        # Values that share the digits found so far with an open rank of their group and column.
        heads = open_ranks.select(*_KEY, "digit").distinct()
        near = _values(df, names, group, _bounds(open_ranks, level))
        kept = near.withColumn("digit", F.shiftright("v", 64 - DIGIT_BITS * level)).join(heads, [*_KEY, "digit"])
        keys = [*_KEY, "digit"]
        digits = _histogram(kept, keys, level)
        state = materialize(_select(open_ranks.drop("least", "most"), digits, keys), "ranks")
    else:
        done.append(state)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = found.select(*_KEY, "place", from_image(F.col("least")).alias("value"))
    ends = [found.select(*_KEY, F.col("place").alias(end), F.col("value").alias(f"{end}_value")) for end in ("lower", "upper")]
    out = asked.join(ends[0], [*_KEY, "lower"], "left").join(ends[1], [*_KEY, "upper"], "left")
    low, high = F.col("lower_value"), F.col("upper_value")
    value = F.when(low == high, low).otherwise(low + (high - low) * F.col("weight"))
    column = F.element_at(F.array(*map(F.lit, names)), F.col("c") + 1)
    grp = F.when(F.col("g") != "", F.substring("g", 2, 2**31 - 1))
    return out.select(grp.alias("grp"), column.alias("column"), "p", "n", value.alias("value"))


def exact_quantiles(
    df: DataFrame, columns: dict[str, list[float]], group: str | None = None, exact_rows: int | None = None
) -> dict:
    """:func:`quantile_table` on the driver: ``{group value: {column: [value per probability]}}``.

    ``None`` is the only group when ``group`` is not given. For a few groups; a table of many
    stays a table. ``exact_rows`` chose between two ways once and has no effect.
    """
    rows = quantile_table(df, columns, group).collect()
    known = {(r["grp"], r["column"], r["p"]): r["value"] for r in rows}
    groups = dict.fromkeys(r["grp"] for r in rows)
    return {g: {c: [known.get((g, c, float(p))) for p in ps] for c, ps in columns.items()} for g in groups}
