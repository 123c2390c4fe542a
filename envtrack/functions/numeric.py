"""Rounding and an order-preserving integer form of doubles.

Reports round half-to-even on the decimal text of the value: the double is first cast to a decimal with
6 places and then rounded, so ``2.345`` becomes ``2.34`` whatever binary value stands behind the text.
The same recipe is used in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on doubles have no decimal places, and decimals of 38 digits end.
LARGE = 1e31


def round_even(c: Column, places: int) -> Column:
    """Half-even rounding on the 6-place decimal form, as a double; infinities and huge values as they are."""
    rounded = F.bround(c.cast("decimal(38,6)"), places).cast("double")
    return F.when(F.abs(c) < LARGE, rounded).otherwise(c.cast("double"))


def order_image(v: Column) -> Column:
    """A bigint that orders like the double ``v`` (infinities included, NaN last; null for null).

    The image grows by one from each non-negative double to the next; that of -v is its negative. It is
    put together from the exponent and the fraction, as there is no built-in access to the bits.
    """
    size = F.abs(v)
    usual = F.when((size > 0) & (size < float("inf")), size).otherwise(1.0)
    guess = F.greatest(F.floor(F.log2(usual)), F.lit(-1022)).cast("int")
    part = usual / F.pow(F.lit(2.0), guess)  # in [1, 2), below 1 for subnormal values
    low = (part < 1) & (guess > -1022)  # the logarithm may be one off next to a power of two
    high = part >= 2
    exponent = F.when(low, guess - 1).when(high, guess + 1).otherwise(guess)
    part = F.when(low, part * 2).when(high, part / 2).otherwise(part)
    unit = 1 << 52
    finite = (exponent + 1022).cast("bigint") * unit + (part * float(unit)).cast("bigint")
    image = F.when(F.isnan(v), F.lit(2**63 - 1)).when(size == float("inf"), F.lit(2047 * unit)).when(
        size == 0, F.lit(0).cast("bigint")).otherwise(finite)
    return F.when(v.isNull(), None).when(v < 0, -image).otherwise(image)
