"""Keep texts that are not needed out of a shuffle.

The keys that are needed are noted in a bitmap of fixed size, which is all that
is broadcast. Rows whose key is not in the bitmap are surely not needed; the
others go on to an exact join. With more keys than the bitmap can hold it lets
more rows through, and results stay the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
_PIECE = 1 << 15


def _slot(column: str):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BITS))


def bitmap(keys: DataFrame, column: str) -> DataFrame:
    """The bitmap of a column in pieces of 4 KB, at most BITS / 32,768 rows."""
    slot = _slot(column)
    return keys.groupBy(F.shiftright(slot, 15).alias("_piece")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit(_PIECE - 1))).alias("_bits")
    )


def among(df: DataFrame, column: str, bits: DataFrame, wanted: bool = True) -> DataFrame:
    """The rows whose key may be noted in ``bits`` (``wanted``) or surely is not."""
    slot = _slot(column)
    joined = df.withColumn("_slot", slot).join(
        F.broadcast(bits), F.shiftright("_slot", 15) == F.col("_piece"), "left"
    )
    place = F.col("_slot").bitwiseAND(F.lit(_PIECE - 1)).cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bits, (_slot & 32767) div 8 + 1, 1)")), 16, 10)
    power = F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("int")
    noted = F.coalesce(byte.cast("int").bitwiseAND(power) != 0, F.lit(False))
    return joined.where(noted if wanted else ~noted).select(df.columns)
