"""The whole derivation from stored tables to published panels."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..operators import adjust, checks, market, response, status, trend
from ..operators.grid import grid
from ..sources import export, tables


log = logging.getLogger(__name__)


def full_grid(t: dict[str, DataFrame]) -> DataFrame:
    return grid(t["daily"], a=(t["adj_factor"], ("adj_factor",)), l=(t["stk_limit"], ("up_limit", "down_limit")), b=(t["daily_basic"], ("circ_mv", "turnover_rate_f")))


def publish(spark: SparkSession, root: str, out: str, wide: bool = False, measures: tuple[str, ...] = S.MEASURES) -> dict[str, str]:
    """Derive every panel of the tables below ``root`` and write it below ``out``: long Parquet, and
    wide tables on demand. Trends are appended to what ``out`` already holds; responses are always
    computed anew, since their tail fills in later. The grid is written once and read by all. Of ``measures``
    those are published that the grid has."""
    t = {n: tables.read(spark, root, n) for n in S.TABLES}
    for name in ("daily", "index_daily"):
        checks.require_rows(t[name], name)
    checks.require_empty(checks.blank_names(t["namechange"]), "blank names")
    checks.require_empty(checks.duplicate_codes(t["stock_list"]), "codes listed twice")
    checks.require_empty(checks.index_calendar(t["daily"], t["index_daily"]), "index calendars")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        written[name] = f"{out}/{name}"
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    written: dict[str, str] = {}
    cells = keep(full_grid(t).repartition("ts_code"), "grid")
    checks.require_empty(checks.limit_conflicts(cells), "both limits touched")
    panels = {
        "ST": ("st", keep(status.st_status(cells, t["daily"], t["stock_list"], t["namechange"]), "status/ST")),
        "limit": ("lim", keep(status.limit_status(cells), "status/limit")),
        "cap": ("cap", keep(status.cap_status(cells), "status/cap")),
        "close": ("close", keep(adjust.adj_close(cells), "processed/close")),
        "roc": ("roc_1_disc", keep(market.roc_disc(cells), "features/close_ROC_1_disc")),
    }
    keep(status.status_codes(spark), "status/status_codes")
    for m in (m for m in measures if m in cells.columns):
        panels[m] = (m, keep(adjust.passthrough(cells, m), f"processed/{m}"))
    keep(market.board(t["daily"]).orderBy("ts_code"), "features/market/board")
    for i in S.MARKET_INDEXES:
        keep(market.index_roc(t["index_daily"], i).drop("ts_code").orderBy("trade_date"), f"features/market/{i}")
    checks.require_empty(checks.roc_out_of_range(panels["roc"][1]), "discrete returns")

    close = panels["close"][1]
    checks.require_empty(checks.duplicate_keys(close), "repeated cells")
    path = f"{out}/features/trends"
    if tables.exists(spark, path):
        old = spark.read.parquet(path)
        checks.require_empty(checks.prefix_violations(old, close), "trends are no prefix")
        if trend.behind(close, old):
            trend.append_trends(close, old).write.mode("append").parquet(path)
        else:
            log.info("%s is up to date", path)
    else:
        trend.trends(close).write.parquet(path)
    written["features/trends"] = path
    checks.require_empty(checks.unequal_grids(close, panels["ST"][1]), "grids differ")
    rr = keep(response.responses(close, panels["ST"][1]), "response")
    if wide:
        tr = spark.read.parquet(path)
        for name, (value, df) in (panels | {f"TR_{h}": (f"tr_{h}", tr) for h in S.TRENDS} | {f"RR_{h}": (f"rr_{h}", rr) for h in S.RESPONSES}).items():
            export.write(export.wide(df, value), f"{out}/wide/{name}")
            written[f"wide/{name}"] = f"{out}/wide/{name}"
    return written
