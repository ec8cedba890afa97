"""Values that an expression needs several times, made once a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once a row.

    Inside higher-order functions Spark evaluates each mention of an expression anew, in a lambda for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
