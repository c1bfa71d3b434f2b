"""Column expressions for numbers and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
# From 2^52 on a double has no fraction; whole parts are cut into limbs of 62 bits.
EXACT, LIMB, LARGEST = 2.0**52, 2.0**62, 1e31


def finite_or_null(c: Column) -> Column:
    """NaN and the infinities become NULL, so that they cannot poison max, avg or comparisons."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(INF)), c)


def rounded(c: Column, digits: int) -> Column:
    """Rounded double without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def _product_error(a: Column, b: Column, product: Column) -> Column:
    """What the rounded product ``a * b`` lacks (Dekker's exact product by splitting at 27 bits)."""

    def split(x: Column) -> tuple[Column, Column]:
        scaled = x * F.lit(134_217_729.0)
        high = scaled - (scaled - x)
        return high, x - high

    (ah, al), (bh, bl) = split(a), split(b)
    return al * bl - (((product - ah * bh) - al * bh) - ah * bl)


def _scaled_integer(c: Column, digits: int) -> Column:
    """``c * 10^digits`` rounded to an integer on the exact binary value, ties to even.

    Only a product that looks like a tie needs care: there the lost part of the product decides.
    """
    scale = F.lit(float(10**digits))
    product = c * scale
    nearest = F.rint(product)
    lost = _product_error(c, scale, product)
    return (
        F.when((product - nearest == 0.5) & (lost > 0), nearest + 1)
        .when((product - nearest == -0.5) & (lost < 0), nearest - 1)
        .otherwise(nearest)
    )


def exact_round(c: Column, digits: int) -> Column:
    """Rounds the exact binary value, ties to even; ``c * 10^digits`` has to stay below 2^53."""
    return _scaled_integer(c, digits) / F.lit(float(10**digits))


def fixed_text(c: Column, digits: int) -> Column:
    """Fixed-point text rounded on the exact binary value (what C and Python formatting print), for values below 1e31.

    Whole part and fraction are exact doubles of their own; the whole part becomes a decimal in two limbs. Larger values print
    their shortest digits, filled up with zeros. At most six digits.
    """
    size = F.abs(c)
    whole = F.when(size < EXACT, F.floor(size).cast("double")).otherwise(size)
    high = F.floor(whole / F.lit(LIMB))
    low = whole - high.cast("double") * F.lit(LIMB)

    def number(value: int | str, kind: str) -> Column:
        return F.lit(str(value)).cast(f"decimal({kind})")

    units = high.cast("decimal(13,0)") * number(int(LIMB), "19,0") + low.cast("bigint").cast("decimal(19,0)")
    scaled = units * number(10**digits, f"{digits + 1},0") + _scaled_integer(size - whole, digits).cast("decimal(8,0)")
    text = (scaled * number(f"{10**-digits:.{digits}f}", f"{digits + 1},{digits}")).cast("string")
    return (
        F.when(F.isnan(c), F.lit("nan"))
        .when(c == INF, F.lit("inf"))
        .when(c == -INF, F.lit("-inf"))
        .when(size < LARGEST, F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), text))
        .otherwise(F.replace(F.format_number(c, digits), F.lit(","), F.lit("")))
    )


def percent_text(c: Column, digits: int) -> Column:
    return F.concat(fixed_text(c * 100, digits), F.lit("%"))
