"""Table schemas, status codes and constants of the panel."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

KEY = ("ts_code", "trade_date")


def _fact(*measures: str) -> T.StructType:
    return T.StructType([T.StructField("ts_code", T.StringType(), False), T.StructField("trade_date", T.DateType(), False), *[T.StructField(m, T.FloatType()) for m in measures]])


def _table(ddl: str) -> T.StructType:
    kinds = {"string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(n, kinds[k.rstrip("!")], not k.endswith("!")) for n, k in (c.split() for c in ddl.split(", "))])


TABLES: dict[str, T.StructType] = {
    "daily": _fact("open", "high", "low", "close", "pct_chg", "amount"),
    "index_daily": _fact("open", "high", "low", "close", "pct_chg", "amount"),
    "adj_factor": _fact("adj_factor"),
    "daily_basic": _fact("turnover_rate", "turnover_rate_f", "volume_ratio", "pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm", "total_mv", "circ_mv"),
    "stk_limit": _fact("up_limit", "down_limit"),
    "namechange": _table("ts_code string!, name string, start_date date, ann_date date!, change_reason string"),
    "stock_list": _table("ts_code string, name string, industry string, list_status string, list_date date, delist_date date"),
    "download_status": _table("dataset string!, logical_date string!, status string, row_count int, message string, updated_at timestamp"),
}
PRIMARY_KEYS = {t: KEY for t in ("daily", "index_daily", "adj_factor", "daily_basic", "stk_limit")} | {"namechange": ("ts_code", "ann_date"), "download_status": ("dataset", "logical_date"), "stock_list": ("ts_code",)}



class Dataset(NamedTuple):
    """What is fetched date by date into a table: on trading days, else on all days."""

    table: str
    on_trading_days: bool

    @property
    def fields(self) -> list[str]:
        return TABLES[self.table].names


# Fixed values.
DATASETS = {t: Dataset(t, t != "namechange") for t in ("daily", "adj_factor", "daily_basic", "stk_limit", "namechange")} | {i: Dataset("index_daily", True) for i in ("000001.SH", "399001.SZ", "399006.SZ")}
LIST_STATUS = ("L", "D", "P")
MEASURES = ("amount", "circ_mv", "turnover_rate_f")
ST_UNLISTED, ST_NORMAL, ST_ST, ST_STAR, ST_LEAVING, ST_DELISTED = "-2", "0", "2", "4", "5", "6"
NO_LIMIT_FROM = 999999.0
CAP_SMALL, CAP_LARGE = 0.20, 0.90
CLIP = 20
MARKET_INDEXES = ("000001.SH", "399006.SZ")
TRENDS = {1: "point", 3: "point", 10: "ols", 30: "ols", 90: "ols"}
RESPONSES = {3: 1, 10: 3, 30: 9}
MIN_VALID = 0.8
STATUS_CODES = [
    ("ST", "未上市", "-2", None, False),
    ("ST", "正常", "0", None, True),
    ("ST", "ST", "2", None, True),
    ("ST", "*ST", "4", None, False),
    ("ST", "退市整理", "5", "名称以退开头或结尾，尚未到实际退市日", False),
    ("ST", "退市", "6", "交易日已到实际退市日或之后", False),
    ("ST", "错误状态", "127", None, False),
    ("ST", "名称缺失", None, None, False),
    ("limit", "no_limit", "127", "无涨跌停限制", False),
    ("limit", "up_level_3", "6", "一字涨停(开盘+最低+收盘)", False),
    ("limit", "up_level_2", "4", "开盘+收盘涨停", False),
    ("limit", "up_level_1", "2", "仅收盘涨停", False),
    ("limit", "down_open_next", "1", "第二天跌停打开", True),
    ("limit", "normal", "0", "正常状态", True),
    ("limit", "up_open_next", "-1", "第二天涨停打开", True),
    ("limit", "down_level_1", "-2", "仅收盘跌停", False),
    ("limit", "down_level_2", "-4", "开盘+收盘跌停", False),
    ("limit", "down_level_3", "-6", "一字跌停(开盘+最高+收盘)", False),
    ("limit", "no_data", None, "无数据", False),
    ("cap", "large", "8", "大盘", True),
    ("cap", "mid", "6", "中盘", True),
    ("cap", "small", "4", "小盘", True),
    ("cap", "no_data", None, "无数据", False),
]
