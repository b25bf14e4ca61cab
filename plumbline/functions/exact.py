"""Sums and means of doubles that do not depend on the order of the rows, and so not on how they are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed point of the terms: 18 decimals, and room for sums of 10^20.
TERM = "decimal(38,18)"


def exact_sum(x: Column | str) -> Column:
    """The sum of the values rounded to 18 decimals, added without rounding; null of no value. A sum of 10^20 or more is an error."""
    return F.sum((F.col(x) if isinstance(x, str) else x).cast(TERM)).cast("double")


def exact_avg(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return exact_sum(x) / F.count(x)
