"""Market breadth, pressure days, panic days and three-day slumps."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .market import index_of

def breadth(cells: DataFrame) -> DataFrame:
    """Per date and index: n, mean and median change, share at or below -5 and share falling."""
    c = F.col("pct_chg").cast("double")
    return cells.where("pct_chg is not null").groupBy("trade_date", index_of().alias("mkt_index")).agg(
        F.count("*").alias("n"), F.avg(c).alias("mean_chg"), F.expr("percentile(cast(pct_chg as double), 0.5)").alias("median_chg"),
        F.avg((c <= -5).cast("double")).alias("share_crash"), F.avg((c < 0).cast("double")).alias("share_fall"),
    )


def among_worst(value: str, window: int = 252, worst: int = 10, highest: bool = False) -> Column:
    """Whether fewer than ``worst`` rows of the trailing window are more extreme than this one."""
    seen = F.collect_list(value).over(Window.partitionBy("mkt_index").orderBy("trade_date").rowsBetween(1 - window, 0))
    return F.size(F.filter(seen, lambda v: v > F.col(value) if highest else v < F.col(value))) < worst


def pressure_days(breadths: DataFrame, index_daily: DataFrame) -> DataFrame:
    """Days on which the index is among its worst and the cross-section confirms it."""
    index = index_daily.select("trade_date", F.col("ts_code").alias("mkt_index"), F.col("pct_chg").cast("double").alias("index_chg"))
    rows = breadths.join(index, ["trade_date", "mkt_index"]).withColumns({"index_worst": among_worst("index_chg"), "crash_worst": among_worst("share_crash", highest=True)})
    return rows.where(F.col("index_chg").isNotNull() & F.col("index_worst") & ((F.col("mean_chg") <= -2) | (F.col("share_fall") >= 0.7) | F.col("crash_worst"))).select("trade_date", "mkt_index", "index_chg", "share_fall", "share_crash")


def panic_days(breadths: DataFrame) -> DataFrame:
    return breadths.where("share_crash >= 0.4").select("trade_date", "mkt_index", "n", "share_crash")


def slumps(index_daily: DataFrame, days: int = 3, worst: int = 10) -> DataFrame:
    """The worst compounded returns over ``days`` rows, taken greedily without overlap, per index.
    One index is one calendar of bounded length, which a single task reads."""
    w = Window.partitionBy("ts_code").orderBy("trade_date")
    full = w.rowsBetween(1 - days, 0)
    rows = index_daily.select("ts_code", "trade_date", F.row_number().over(w).alias("pos"), F.count("pct_chg").over(full).alias("k"), F.expm1(F.sum(F.log1p(F.greatest(F.col("pct_chg").cast("double") / 100, F.lit(-0.999999)))).over(full)).alias("ret"))
    rows = rows.where(F.col("k") == days).select("ts_code", "trade_date", "pos", "ret")

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        taken: list[int] = []
        keep = []
        for i, p in frame.assign(near=frame["ret"].round(12)).sort_values(["near", "trade_date"])["pos"].items():
            if len(taken) < worst and all(abs(p - q) >= days for q in taken):
                taken.append(p)
                keep.append(i)
        out = frame.loc[keep, ["ts_code", "trade_date", "ret"]]
        return out.assign(rank=range(1, len(out) + 1))

    return rows.groupBy("ts_code").applyInPandas(pick, "ts_code string, trade_date date, ret double, rank int")


def day_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Jaccard similarity of two sets of dates."""
    both = a.select("trade_date").distinct().withColumn("a", F.lit(1)).join(b.select("trade_date").distinct().withColumn("b", F.lit(1)), "trade_date", "full")
    return both.agg(F.count("*").alias("either"), F.sum(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)).alias("both")).withColumn("jaccard", F.try_divide("both", "either"))


def correlation(breadths: DataFrame, value: str, left: str, right: str) -> DataFrame:
    """Pearson correlation of one measure between two indexes over common dates."""
    x = breadths.where(F.col("mkt_index") == left).select("trade_date", F.col(value).alias("x"))
    return x.join(breadths.where(F.col("mkt_index") == right).select("trade_date", F.col(value).alias("y")), "trade_date").agg(F.corr("x", "y").alias("corr"))


