"""Casts that fail the job on bad text, whatever the session's ANSI setting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_raise(value: Column, text: Column, what: str) -> Column:
    """``value``, but an error where it is NULL although ``text`` is not."""
    message = F.concat(F.lit(f"not a valid {what}: '"), text, F.lit("'"))
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message)))


def strict_cast(text: Column, dtype: str) -> Column:
    """Cast text to ``dtype``; NULL stays NULL, anything unreadable raises."""
    return or_raise(text.try_cast(dtype), text, dtype)
