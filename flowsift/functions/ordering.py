"""A 64-bit image of doubles that sorts as they do."""

from __future__ import annotations

import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANTISSA = 52
_LEAST_NORMAL = 2.0**-1022
_INFINITE = 2047 << _MANTISSA


def order_image(value: Column) -> Column:
    """A bigint for each double: smaller doubles have smaller ones, equal doubles equal ones.

    Sign and magnitude of the IEEE bits, found by arithmetic that is exact for powers of
    two, so that it stays inside generated code. Null for null and NaN.
    """
    size = F.abs(value)
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)).cast("double")
    power = F.pow(F.lit(2.0), guess)
    # The logarithm is rounded, so its whole part may be off by one.
    step = F.when(size < power, -1).when(size >= power * 2, 1).otherwise(0)
    scaled = size / power / F.when(step == -1, 0.5).when(step == 1, 2.0).otherwise(1.0)
    normal = (guess + step + 1022).cast("bigint") * F.lit(1 << _MANTISSA) + (scaled * float(1 << _MANTISSA)).cast("bigint")
    tiny = (size * 2.0**1000 * 2.0**74).cast("bigint")
    image = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(size < _LEAST_NORMAL, tiny)
        .when(size == float("inf"), F.lit(_INFINITE))
        .otherwise(normal)
    )
    return F.when(F.isnan(value), None).otherwise(F.when(value < 0, -image).otherwise(image))


def from_image(image: Column) -> Column:
    """The double of an :func:`order_image`."""
    size = F.abs(image)
    exponent, fraction = F.shiftright(size, _MANTISSA), size.bitwiseAND((1 << _MANTISSA) - 1).cast("double")
    power = F.pow(F.lit(2.0), (F.greatest(exponent, F.lit(1)) - 1075).cast("double"))
    value = F.when(size == _INFINITE, float("inf")).otherwise(
        F.when(exponent == 0, fraction).otherwise(fraction + float(1 << _MANTISSA)) * power
    )
    return F.when(image < 0, -value).otherwise(value)


def image_value(image: int) -> float:
    """The double of an image as a number; images beyond those of doubles give the infinite ones."""
    size = struct.unpack("<d", struct.pack("<q", min(abs(image), _INFINITE)))[0]
    return -size if image < 0 else size
