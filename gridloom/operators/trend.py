"""Point and log-linear trends over grid rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .grid import along


def point_trend(px: Column, h: int) -> Column:
    """Return over h rows in single precision."""
    return ((px.cast("double") / F.lag(px, h).over(along())).cast("float") - F.lit(1.0).cast("float")).cast("float")


def ols_trend(px: Column, w: int) -> Column:
    """Return over the window by the least-squares line of the logarithm. Gaps keep their place;
    null without the day's price, with under 80 % known or before the window is full."""
    if w < 2:
        raise ValueError("a line needs a window of 2 rows or more")
    frame = along().rowsBetween(1 - w, 0)
    enough = px.isNotNull() & (F.count(px).over(frame) >= ceil(S.MIN_VALID * w)) & (F.row_number().over(along()) >= w)
    span = F.expm1(F.regr_slope(F.ln(px.cast("double")), F.when(px.isNotNull(), F.col("pos").cast("double"))).over(frame) * (w - 1))
    return F.when(enough & (F.abs(span) < float("inf")), span).cast("float")


def trends(close: DataFrame, specs: dict[int, str] | None = None) -> DataFrame:
    """trade_date, ts_code and one column tr_h for each horizon, all from one sort."""
    specs = specs or S.TRENDS
    if bad := set(specs.values()) - {"point", "ols"}:
        raise ValueError(f"unknown kind of trend: {sorted(bad)}")
    rows = close.withColumn("_px", F.when(F.col("close") > 0, F.col("close")))
    px = F.col("_px")
    return rows.select("trade_date", "ts_code", *[(point_trend if k == "point" else ols_trend)(px, h).alias(f"tr_{h}") for h, k in specs.items()])


def behind(close: DataFrame, old: DataFrame) -> bool:
    """Whether ``close`` has days or codes that ``old`` lacks."""
    return any(close.select(c).distinct().join(old.select(c).distinct(), c, "left_anti").take(1) for c in ("trade_date", "ts_code"))


def append_trends(close: DataFrame, old: DataFrame, specs: dict[int, str] | None = None) -> DataFrame:
    """Rows to add to ``old``: the tail of known codes, computed with the lookback the longest
    horizon needs, and the whole history of new codes. Old rows stay as they are. ``old`` must be a
    prefix of the calendar (see checks.prefix_violations)."""
    specs = specs or S.TRENDS
    back = max(specs)
    done = old.agg(F.max("trade_date").alias("until"))
    upto = F.broadcast(close.join(F.broadcast(done), F.col("trade_date") <= F.col("until")).agg(F.max("pos").alias("done"), F.max("trade_date").alias("until")))
    known = old.select("ts_code").distinct().withColumn("known", F.lit(True))
    rows = close.join(known, "ts_code", "left").crossJoin(upto)
    # a window of w rows must look full in the tail, so w rows of history stay in
    fresh = trends(rows.where(F.col("known").isNull() | (F.col("pos") > F.coalesce("done", F.lit(-1)) - back)), specs)
    return fresh.join(known, "ts_code", "left").crossJoin(upto.select("until")).where(F.col("known").isNull() | F.col("until").isNull() | (F.col("trade_date") > F.col("until"))).select(*fresh.columns)
