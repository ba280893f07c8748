"""Lenient number parsing and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.text import strip

# The text forms that count as a number.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_NAN = "(?i)^[+-]?nan$"
_INF = r"(?i)^\+?inf(?:inity)?$"
_NEG_INF = "(?i)^-inf(?:inity)?$"


def lenient_double(value: Column, dtype: T.DataType) -> Column:
    """``value`` as a double, or null where it is not a number.

    ``dtype`` is the column's type: text is parsed, other types are cast.
    """
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast("double")
    if not isinstance(dtype, T.StringType):
        return value.cast("double")
    text = strip(value)
    return (
        F.when(text.rlike(_DECIMAL), F.regexp_replace(text, "_", "").try_cast("double"))
        .when(text.rlike(_NAN), F.lit(float("nan")))
        .when(text.rlike(_INF), F.lit(float("inf")))
        .when(text.rlike(_NEG_INF), F.lit(float("-inf")))
    )


def round_1(value: Column) -> Column:
    """One decimal, from the exact binary value, ties to even: 0.15 gives 0.1.

    ``round`` would work on the shortest decimal form and give 0.2.
    """
    special = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(special, value).otherwise(
        F.call_function("format_number", value, F.lit("0.0")).cast("double")
    )
