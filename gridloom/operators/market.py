"""Discrete returns, boards and index series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .grid import codes


def discrete(change: str | Column) -> Column:
    """Whole per cent, half away from zero, clipped; null stays null."""
    r = F.round(change)
    return F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(S.CLIP).cast("float")), F.lit(-S.CLIP).cast("float"))).cast("tinyint")


def roc_disc(cells: DataFrame) -> DataFrame:
    return cells.select("trade_date", "ts_code", discrete("pct_chg").alias("roc_1_disc"))


def index_roc(index_daily: DataFrame, *wanted: str) -> DataFrame:
    return index_daily.where(F.col("ts_code").isin(*(wanted or S.MARKET_INDEXES))).select("ts_code", "trade_date", "pct_chg", discrete("pct_chg").alias("roc_1_disc"))


def board_of(code: str = "ts_code") -> Column:
    c = F.col(code)
    return F.when(c.like("30%.SZ"), "创业板").when(c.like("688%.SH") | c.like("689%.SH"), "科创板").otherwise("主板")


def index_of(code: str = "ts_code") -> Column:
    return F.when(board_of(code) == "主板", S.MARKET_INDEXES[0]).otherwise(S.MARKET_INDEXES[1])


def board(daily: DataFrame) -> DataFrame:
    return codes(daily).select("ts_code", board_of().alias("board"), index_of().alias("mkt_index"))
