"""Forward returns that know of delisting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .grid import along


def response(h: int, w: int) -> Column:
    """Return to the centred mean of w closes h rows ahead; -1 if delisted by then; null unless bought
    at a positive close. Columns _buy (0 once delisted) and _gone are the inputs."""
    if w % 2 == 0 or h < w // 2:
        raise ValueError("the window must be odd and lie ahead")
    frame = along().rowsBetween(h - w // 2, h + w // 2)
    buy = F.col("_buy").cast("double")
    ahead = F.when(F.count("_buy").over(frame) == w, F.avg(buy).over(frame))
    return F.when(F.col("_buy") > 0, F.when(F.coalesce(F.lead("_gone", h).over(along()), F.lit(False)), F.lit(-1.0)).otherwise(ahead / buy - 1)).cast("float")


def responses(close: DataFrame, st: DataFrame, specs: dict[int, int] | None = None) -> DataFrame:
    """trade_date, ts_code and one column rr_h for each horizon, all from one sort."""
    gone = F.coalesce(F.col("st") == S.ST_DELISTED, F.lit(False))
    rows = close.join(st, ["ts_code", "trade_date"]).select("ts_code", "trade_date", F.when(gone, F.lit(0.0).cast("float")).otherwise(F.col("close")).alias("_buy"), gone.alias("_gone"))
    return rows.select("trade_date", "ts_code", *[response(h, w).alias(f"rr_{h}") for h, w in (specs or S.RESPONSES).items()])
