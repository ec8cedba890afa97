"""Casts of loosely typed attributes.

Absent, undefined and erroneous values are all NULL. ANSI mode is on by default in
Spark 4, so every conversion of outside data goes through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_bool(value: Column, dtype: T.DataType) -> Column:
    """Truthiness: zero and the empty string are false, every other value is true."""
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.NumericType):
        return value != F.lit(0)
    return F.length(value) > 0


def to_long(value: Column, dtype: T.DataType) -> Column:
    """Integer; fractions of numbers are cut, text must be an integer, other text is NULL."""
    if isinstance(dtype, T.LongType):
        return value
    return text_to_long(value) if isinstance(dtype, T.StringType) else value.try_cast("bigint")


def to_text(value: Column, dtype: T.DataType) -> Column:
    """Text form; booleans are capitalised."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")


def to_epoch(value: Column, dtype: T.DataType) -> Column:
    """Epoch seconds; zero, "unknown" and bad text are NULL."""
    return F.nullif(to_long(value, dtype), F.lit(0))


def is_unconvertible(value: Column, dtype: T.DataType) -> Column | None:
    """Condition under which an integer conversion is a failure (infinite numbers), if any."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.abs(value) == F.lit(float("inf"))
    return None


CASTS = {"bool": to_bool, "long": to_long, "string": to_text, "date": to_epoch}


def cast_attribute(value: Column, dtype: T.DataType, kind: str | None) -> Column:
    """Cast to the declared kind of an attribute; undeclared attributes pass through."""
    return value if kind is None else CASTS[kind](value, dtype)


def text_to_list(value: Column) -> Column:
    """Split a list in text form on commas and blanks; a missing list is ``["UNKNOWN"]``."""
    # one-character separators are split without a regular expression per row
    plain = F.split(F.regexp_replace(value, r"[\s,]+\s*", ","), ",")
    return F.coalesce(plain, F.array(F.lit("UNKNOWN")))


def text_to_long(value: Column) -> Column:
    """Integer in text form, else NULL. The shape is tested first: failing casts are slow in bulk."""
    return F.when(value.rlike(r"^\s*[-+]?\d+\s*$"), value.try_cast("bigint"))


def text_to_double(value: Column) -> Column:
    """Number in text form, else NULL."""
    return F.when(value.rlike(r"^\s*[-+]?[0-9.]+([eE][-+]?[0-9]+)?\s*$"), value.try_cast("double"))


def decode(code: Column, table: dict, default: str | None = "Unknown") -> Column:
    """Translate a code by a small fixed table."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    decoded = F.try_element_at(entries, code)
    return decoded if default is None else F.coalesce(decoded, F.lit(default))
