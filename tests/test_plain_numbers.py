"""Whole numbers are read without a pattern; every text keeps the value that the pattern gives."""

import math
import random

from pyspark.sql import functions as F

from flowsift.functions.parsing import _NUMBER, strip, to_number


def by_pattern(text):
    clean = strip(text)
    return F.when(clean.rlike(_NUMBER), clean.try_cast("double"))


def test_every_text_keeps_its_value(spark):
    random.seed(2)
    texts = [None, "", " ", "0", "-0", "+5", "5", "-5", " 5", "5\t", "007", "1.0", ".5", "5.", "1e3", "1E-3", "1.0f", "0x1p3", "5d", "5L", "NaN",
             "Infinity", "n/a", "\x015", "5\x00", "\u00a05", "\u0665", "1 000", "--5", "9223372036854775807", "9223372036854775808",
             "-9223372036854775808", "9007199254740993", "123456789012345678901", "5\x0b"]
    texts += [str(random.randint(-(10**k), 10**k)) for k in range(1, 20) for _ in range(50)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_number(F.col("t")).alias("a"), by_pattern(F.col("t")).alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"] and (r["a"] is None or math.copysign(1, r["a"]) == math.copysign(1, r["b"])), r


def test_numbers_of_other_types(spark):
    df = spark.createDataFrame([(5, 2.5, True)], "i int, d double, b boolean")
    assert tuple(df.select(to_number(F.col("i")), to_number(F.col("d")), to_number(F.col("b"))).first()) == (5.0, 2.5, None)


def test_whole_numbers_come_before_the_pattern(spark):
    plan = spark.range(3).select(to_number(F.col("id").cast("string")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(" in plan and plan.index("coalesce(") < plan.index("RLIKE")
