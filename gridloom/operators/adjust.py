"""Back-adjusted close and measures passed through the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_adj(cells: DataFrame) -> DataFrame:
    """Per code the latest known adjustment factor."""
    return cells.groupBy("ts_code").agg(F.max_by("adj_factor", F.when(F.col("adj_factor").isNotNull(), F.col("trade_date"))).alias("last_adj"))


def adj_close(cells: DataFrame) -> DataFrame:
    """trade_date, ts_code, close: rounded to cents in single precision; gaps stay null."""
    ratio = F.try_divide(F.col("adj_factor").cast("double"), F.col("last_adj").cast("double")).cast("float")
    return cells.join(last_adj(cells), "ts_code").select("trade_date", "ts_code", "pos", F.round(F.col("close") * ratio, 2).cast("float").alias("close"))


def passthrough(cells: DataFrame, *measures: str) -> DataFrame:
    return cells.select("trade_date", "ts_code", *(measures or ("amount", "circ_mv", "turnover_rate_f")))
