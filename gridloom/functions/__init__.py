"""Column functions shared by sources and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yyyymmdd(text: str | Column) -> Column:
    """The date; null or blank text is null, any other text an error."""
    c = F.col(text) if isinstance(text, str) else text
    day = F.try_to_timestamp(c, F.lit("yyyyMMdd")).cast("date")
    return F.when(day.isNull() & (F.trim(c) != ""), F.raise_error(F.concat(F.lit("not a YYYYMMDD date: "), c)).cast("date")).otherwise(day)
