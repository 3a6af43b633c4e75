"""Numbers that a spreadsheet export has turned into locale-formatted text."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.strict import or_raise, strict_cast

# The thousands separator, the text taken as a number at all, and
# what the export writes for a share too small to show.
NARROW_NO_BREAK_SPACE = "\u202f"
NUMBER_LIKE = r"^[0-9.,<%]+\z"
TINY_SHARE = "<0.01%"
TINY_SHARE_VALUE = "0.0001"

# The JVM reads a type suffix ("12f") as part of a number; nobody else does.
JVM_SUFFIX = r"[0-9.][dDfF]\s*\z"


def strip_separator(value: Column) -> Column:
    """The value as text, without thousands separators."""
    return F.replace(
        value.cast("string"), F.lit(NARROW_NO_BREAK_SPACE), F.lit("")
    )


def clean_int(value: Column, dtype: T.DataType = T.StringType()) -> Column:
    """A count to BIGINT. Other spaces, fractions and empty text raise."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    if isinstance(dtype, T.NumericType):
        whole = F.when(value == F.floor(value), value.try_cast("bigint"))
        return or_raise(whole, value.cast("string"), "whole number")
    return strict_cast(strip_separator(value), "bigint")


def clean_double(value: Column, dtype: T.DataType = T.StringType()) -> Column:
    """An amount to DOUBLE; text that is no number raises."""
    if isinstance(dtype, T.NumericType):
        return value.cast("double")
    text = strip_separator(value)
    number = F.when(~text.rlike(JVM_SUFFIX), text.try_cast("double"))
    return or_raise(number, text, "number")


def parse_bounce(
    value: Column,
    times: int = 100,
    over: int = 1,
    dtype: T.DataType = T.StringType(),
) -> Column:
    """A bounce share to DOUBLE, scaled by ``times / over``.

    Text outside ``NUMBER_LIKE`` (NULL, empty, placeholders, signs, exponents,
    spaces) counts as 0. Text inside it that is still no number, such as
    ``45%`` or ``1,234.5``, raises.
    """
    if isinstance(dtype, T.NumericType):
        number = value.cast("double")
        usable = (number >= 0) & (number < F.lit(float("inf")))
        share = F.when(usable, number).otherwise(F.lit(0.0))
    else:
        text = value.cast("string")
        dotted = F.replace(
            F.replace(text, F.lit(TINY_SHARE), F.lit(TINY_SHARE_VALUE)),
            F.lit(","),
            F.lit("."),
        )
        share = strict_cast(
            F.when(text.rlike(NUMBER_LIKE), dotted).otherwise(F.lit("0")),
            "double",
        )
    # Multiplying and dividing by whole numbers, never by a rounded 0.01.
    if times != 1:
        share = share * F.lit(times)
    if over != 1:
        share = share / F.lit(over)
    return share
