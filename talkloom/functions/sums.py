"""Sums of doubles as of real numbers, rounded once, whatever the order of the rows.

Every finite double is a multiple of a power of two. It is split without error into three
whole numbers on a grid of powers of 2^32: high, middle and low limb, at a place and the
two below. Limbs of one place are summed as decimals, which is exact and needs no order;
:func:`total` carries the sums from place to place and makes one double of them, the
nearest to the exact sum, ties to even. Doubles have 67 places, so a group has at most as
many partial sums, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDTH = 32
_LIMB = 1 << _WIDTH
# Numbers below 2^-448 are moved up by 19 places first, as 2^-1088 is no double.
_TINY, _MOVED = -448, 19
_WHOLE = "decimal(38,0)"


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def is_special(number: Column) -> Column:
    """Whether a number is NaN or infinite."""
    return F.isnan(number) | (F.abs(number) == float("inf"))


def with_limbs(rows: DataFrame, number: str) -> DataFrame:
    """``rows`` with place, high, middle and low of ``number``; null where it is null or special."""
    x = F.when(~is_special(F.col(number)), F.col(number))
    tiny = F.abs(x) < 2.0**_TINY
    rows = rows.withColumn("_x", F.when(tiny, x * 2.0 ** (_MOVED * _WIDTH)).otherwise(x))
    rows = rows.withColumn("_moved", F.when(tiny & (x != 0), F.lit(_MOVED)).otherwise(F.lit(0)))
    # the logarithm may be off by its last digits, for which the limbs have room
    place = F.least(F.floor(F.log2(F.abs("_x")) / _WIDTH), F.lit(31)).cast("int")
    rows = rows.withColumn("_place", F.when(F.col("_x").isNotNull(), F.coalesce(place, F.lit(0))))
    grids = [_power((F.col("_place") - i) * _WIDTH) for i in range(3)]
    left = F.col("_x")
    for name, grid in zip(("high", "middle", "low"), grids):
        rows = rows.withColumn(name, (left / grid).cast("bigint"))
        left = left - F.col(name) * grid
    rows = rows.withColumn("place", F.col("_place") - F.col("_moved"))
    return rows.drop("_x", "_moved", "_place")


def limb_sums() -> list[Column]:
    """Sums of high, middle and low, for groups by place and what else is asked for."""
    return [F.sum(F.col(c).cast("decimal(20,0)")).cast(_WHOLE).alias(c) for c in ("high", "middle", "low")]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed, and written into the plan, once."""
    return F.transform(F.array(value), body)[0]


def _carried(values: Column, sign: Column) -> Column:
    """digits (from 0 to 2^32 - 1, lowest first) and carry of place and value pairs, times ``sign``."""
    places = F.transform(values, lambda v: v["place"])
    # a sum of decimals is below 2^126, so it is carried four places up at the most
    steps = F.sequence(F.array_min(places), F.array_max(places) + 4)
    limb = F.lit(_LIMB).cast(_WHOLE)

    def step(done: Column, place: Column) -> Column:
        def add(s: Column, v: Column) -> Column:
            here = F.when(v["place"] == place, v["value"] * sign).otherwise(F.lit(0))
            return (s + here).cast(_WHOLE)

        def cut(s: Column) -> Column:
            digit = F.pmod(s, limb).cast(_WHOLE)
            carry = ((s - digit) / F.lit(_LIMB).cast("decimal(10,0)")).cast(_WHOLE)
            return F.struct(carry.alias("carry"), F.array_append(done["digits"], digit).alias("digits"))

        return _let(F.aggregate(values, done["carry"], add), cut)

    start = F.struct(
        F.lit(0).cast(_WHOLE).alias("carry"), F.array().cast(f"array<{_WHOLE}>").alias("digits")
    )
    return F.aggregate(steps, start, step)


def _magnitude(digits: Column, lowest: Column) -> Column:
    """The double nearest to the number with these digits."""
    limb = F.lit(_LIMB).cast(_WHOLE)
    sizes = F.transform(digits, lambda d, i: F.when(d > 0, i).otherwise(F.lit(-1)))

    def scaled(top: Column) -> Column:
        # 65 bits at least, and one more that tells whether anything follows
        first = F.transform(
            F.sequence(top, top - 2), lambda i: F.when(i >= 0, F.get(digits, i)).otherwise(F.lit(0))
        )
        head = F.aggregate(
            first, F.lit(0).cast(_WHOLE), lambda s, d: ((s * limb).cast(_WHOLE) + d).cast(_WHOLE)
        )
        rest = F.exists(sizes, lambda i: (i >= 0) & (i < top - 2))
        head = (head * 2 + F.when(rest, F.lit(1)).otherwise(F.lit(0))).cast(_WHOLE).cast("double")
        exponent = (lowest + top - 2) * _WIDTH - 1
        half = F.floor(exponent / 2).cast("int")
        return F.when(top < 0, F.lit(0.0)).otherwise(head * _power(half) * _power(exponent - half))

    return _let(F.array_max(sizes), scaled)


def total(parts: Column) -> Column:
    """The double nearest to the sum of an array of place, high, middle, low; 0 if empty or null."""
    each = F.transform(
        parts,
        lambda p: F.array(
            *[
                F.struct((p["place"] - i).alias("place"), p[c].cast(_WHOLE).alias("value"))
                for i, c in enumerate(("high", "middle", "low"))
            ]
        ),
    )

    def signed(values: Column) -> Column:
        def with_sign(sign: Column) -> Column:
            lowest = F.array_min(F.transform(values, lambda v: v["place"]))
            digits = _let(_carried(values, sign)["digits"], lambda d: _magnitude(d, lowest))
            return digits * sign

        below_zero = _carried(values, F.lit(1))["carry"] < 0
        return _let(F.when(below_zero, F.lit(-1)).otherwise(F.lit(1)), with_sign)

    return F.when(F.size(parts) > 0, _let(F.flatten(each), signed)).otherwise(F.lit(0.0))
