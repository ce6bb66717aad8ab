"""The dense trade-date by security grid that every derivation starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_PRICES = ("open", "high", "low", "close", "pct_chg", "amount")


def along() -> WindowSpec:
    """Rows of a code in the order of the calendar."""
    return Window.partitionBy("ts_code").orderBy("trade_date")


def on_main_exchanges(code: str = "ts_code") -> Column:
    return ~F.col(code).endswith(".BJ")


def codes(daily: DataFrame) -> DataFrame:
    return daily.where(on_main_exchanges()).select("ts_code").distinct()


def skeleton(daily: DataFrame) -> DataFrame:
    """ts_code, trade_date, pos (row of the date in the calendar, from 0). Dates come from all rows,
    codes from the main exchanges. The calendar is one row (an array of at most some ten thousand
    days), so each code expands its own dates and nothing but the codes is shuffled."""
    calendar = daily.agg(F.sort_array(F.collect_set("trade_date")).alias("days"))
    return codes(daily).crossJoin(F.broadcast(calendar)).select("ts_code", F.posexplode("days").alias("pos", "trade_date"))


def grid(daily: DataFrame, **auxiliary: tuple[DataFrame, tuple[str, ...]]) -> DataFrame:
    """Skeleton with the measures of ``daily`` and of the auxiliary tables (name=(table, columns)),
    whose values count only where ``daily`` has the row. Join no table that the output does not need.

    The auxiliary tables meet the sparse rows first, all keyed alike, so one exchange per table is
    enough and the dense side is joined once."""
    rows = daily.where(on_main_exchanges()).select("ts_code", "trade_date", *_PRICES)
    for table, columns in auxiliary.values():
        rows = rows.join(table.select("ts_code", "trade_date", *columns), ["ts_code", "trade_date"], "left")
    return skeleton(daily).join(rows, ["ts_code", "trade_date"], "left")
