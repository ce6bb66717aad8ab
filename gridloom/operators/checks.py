"""Data-quality checks: each returns the offending rows; ``require_empty`` raises on any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .grid import on_main_exchanges
from .status import limit_flags, trimmed


class CheckFailed(ValueError):
    pass


def require_empty(violations: DataFrame, what: str) -> None:
    if rows := violations.take(5):
        raise CheckFailed(f"{what}: {[r.asDict() for r in rows]}")


def require_rows(df: DataFrame, what: str) -> None:
    if not df.take(1):
        raise CheckFailed(f"{what}: missing or empty")


def null_counts(panel: DataFrame, *values: str) -> DataFrame:
    """Per value of a panel how many cells have none, and how many cells there are."""
    stacked = F.explode(F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).isNull().alias("none")) for v in values]))
    return panel.select(stacked.alias("x")).groupBy("x.measure").agg(F.count_if("x.none").alias("n_null"), F.count("*").alias("n_all"))


def blank_names(namechange: DataFrame) -> DataFrame:
    return namechange.where(on_main_exchanges() & (F.col("name").isNull() | (trimmed("name") == ""))).select("ts_code", "ann_date")


def duplicate_codes(stock_list: DataFrame) -> DataFrame:
    """Codes listed twice; every null code counts."""
    n = stock_list.where(F.coalesce(on_main_exchanges(), F.lit(True))).groupBy("ts_code").agg(F.count("*").alias("n"))
    return n.where("n > 1 or ts_code is null")


def limit_conflicts(cells: DataFrame) -> DataFrame:
    return limit_flags(cells).where("up > 0 and down > 0").select("trade_date", "ts_code")


def roc_out_of_range(roc: DataFrame) -> DataFrame:
    return roc.where(F.abs(F.col("roc_1_disc").cast("int")) > S.CLIP)


def index_calendar(daily: DataFrame, index_daily: DataFrame, *indexes: str) -> DataFrame:
    """Indexes whose number of days is not that of the calendar."""
    wanted = daily.sparkSession.createDataFrame([(i,) for i in indexes or S.MARKET_INDEXES], "ts_code string")
    have = index_daily.groupBy("ts_code").agg(F.count("*").alias("n_index"))
    days = daily.agg(F.countDistinct("trade_date").alias("n_days"))
    return wanted.join(have, "ts_code", "left").crossJoin(days).select("ts_code", F.coalesce("n_index", F.lit(0)).alias("n_index"), "n_days").where("n_index <> n_days")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*(key or S.KEY)).agg(F.count("*").alias("n")).where("n > 1")


def unequal_grids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys that one panel has and the other lacks."""
    left, right = a.select(*S.KEY).withColumn("l", F.lit(1)), b.select(*S.KEY).withColumn("r", F.lit(1))
    return left.join(right, list(S.KEY), "full").where("l is null or r is null").select(*S.KEY)


def prefix_violations(old: DataFrame, close: DataFrame) -> DataFrame:
    """Why ``old`` is not a prefix of the panel: repeated keys, dates that the calendar lacks or that
    were skipped, codes that vanished."""
    dates, have = close.select("trade_date").distinct(), old.select("trade_date").distinct()
    until = old.agg(F.max("trade_date").alias("until"))
    unknown = have.join(dates, "trade_date", "left_anti").select(F.lit("unknown date").alias("problem"), F.col("trade_date").cast("string").alias("what"))
    skipped = dates.join(F.broadcast(until), F.col("trade_date") <= F.col("until")).join(have, "trade_date", "left_anti").select(F.lit("skipped date"), F.col("trade_date").cast("string"))
    gone = old.select("ts_code").distinct().join(close.select("ts_code").distinct(), "ts_code", "left_anti").select(F.lit("vanished code"), "ts_code")
    twice = duplicate_keys(old).select(F.lit("repeated key"), F.concat_ws(" ", "ts_code", F.col("trade_date").cast("string")))
    return unknown.union(skipped).union(gone).union(twice)
