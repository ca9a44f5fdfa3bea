"""Later passes of the quantiles look only at values inside the open digits of their column."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.functions.ordering import image_value, order_image
from flowsift.operators import quantiles
from flowsift.operators.quantiles import exact_quantiles
from flowsift.storage import materialize


def test_later_passes_make_few_images(spark, monkeypatch):
    df = materialize(spark.range(20_000).select(*[(F.sin(F.col("id") * (i + 1)) * 1000).alias(f"x{i}") for i in range(3)]), "sines")
    seen, histogram = [], quantiles._histogram

    def watched(values, keys, level):
        seen.append((level, values.count()))
        return histogram(values, keys, level)

    monkeypatch.setattr(quantiles, "_values", lambda *a, f=quantiles._values: seen.append(("values", f(*a).count())) or f(*a))
    monkeypatch.setattr(quantiles, "_histogram", watched)
    exact_quantiles(df, {f"x{i}": [0.25, 0.5, 0.75] for i in range(3)})
    read = [n for what, n in seen if what == "values"]
    assert read[0] == 60_000 and len(read) >= 2
    assert read[1] < 12_000 and all(n < 100 for n in read[2:])


def test_odd_values_and_groups(spark):
    random.seed(5)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1e308, -1e308, float("inf"), float("-inf"), float("nan"), None]
    pool = [*odd, *[random.uniform(-1, 1) * 10.0 ** random.randint(-300, 300) for _ in range(300)], *[1 + i * 2.0**-52 for i in range(300)]]
    rows = [(f"g{i % 40}" if i % 41 else None, random.choice(pool), random.choice(pool)) for i in range(6000)]
    df = materialize(spark.createDataFrame(rows, "grp string, a double, b double"), "odd")
    ps = [0.0, 0.1, 0.5, 0.75, 1.0]
    for group in (None, "grp"):
        found = exact_quantiles(df, {"a": ps, "b": ps}, group)
        for key, by_column in found.items():
            for place, column in enumerate("ab", 1):
                known = [r[place] for r in rows if r[place] is not None and not math.isnan(r[place]) and (group is None or r[0] == key)]
                for p, value in zip(ps, by_column[column]):
                    at, ordered = (len(known) - 1) * p, sorted(known)
                    low, high = ordered[math.floor(at)], ordered[min(math.floor(at) + 1, len(known) - 1)]
                    want = low if low == high else low + (high - low) * (at - math.floor(at))
                    assert value == pytest.approx(want, nan_ok=True), (group, key, column, p)


def test_many_open_digits_are_not_listed(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_OPEN_DIGITS", 5)
    df = materialize(spark.range(4000).select((F.col("id") % 20).alias("g"), F.sin("id").alias("x")), "groups")
    found = exact_quantiles(df, {"x": [0.5]}, "g")
    for g in range(20):
        assert found[str(g)]["x"][0] == pytest.approx(np.median(np.sin(np.arange(g, 4000, 20))))


def test_image_values(spark):
    values = [0.0, 1.5, -1.5, 5e-324, -5e-324, 1e308, float("inf"), float("-inf"), 2.0**-1022, 0.1]
    for v, image in spark.createDataFrame([(v,) for v in values], "v double").select("v", order_image(F.col("v"))).collect():
        assert image_value(image) == v
    assert (image_value(2**63 - 1), image_value(-(2**63))) == (float("inf"), float("-inf"))
