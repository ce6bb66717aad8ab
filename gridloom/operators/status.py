"""Risk status, price-limit status and capitalisation tier of each cell of the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from .grid import along, codes, on_main_exchanges


def trimmed(name: str | Column) -> Column:
    """Trim every Unicode space separator, not only U+0020."""
    return F.regexp_replace(name, r"^\p{Zs}+|\p{Zs}+$", "")


def name_status(name: str | Column) -> Column:
    n = trimmed(name)
    return (
        F.when(n.startswith("退") | n.endswith("退"), S.ST_LEAVING).when(n.startswith("*ST"), S.ST_STAR)
        .when(n.startswith("ST"), S.ST_ST).otherwise(S.ST_NORMAL)
    )


def stock_attrs(daily: DataFrame, stock_list: DataFrame) -> DataFrame:
    """Per code: list_date, delist_date, fallback_start (first traded day of a code the list lacks)."""
    first = daily.where(on_main_exchanges()).groupBy("ts_code").agg(F.min("trade_date").alias("first_date"))
    listed = stock_list.where(on_main_exchanges()).dropDuplicates(["ts_code"]).select("ts_code", "list_date", "delist_date", F.lit(True).alias("known"))
    return first.join(listed, "ts_code", "left").select("ts_code", "list_date", "delist_date", F.when(F.col("known").isNull(), F.col("first_date")).alias("fallback_start"))


def as_of(left: DataFrame, right: DataFrame, value: str, *, key: str = "ts_code", left_time: str = "trade_date", right_time: str = "ann_date", name: str | None = None) -> DataFrame:
    """Backward inclusive as-of join by one sort: both sides are stacked and the last value at or
    before each left row is carried on. Linear in the rows of a key, whatever the overlap.
    A null value of the right side hides the one before, as a join would."""
    rows = left.select("*", F.lit(1).alias("_side"), F.col(left_time).alias("_t"), F.lit(None).cast(_box(right, value)).alias("_v"))
    events = right.select(key, F.lit(0).alias("_side"), F.col(right_time).alias("_t"), F.struct(F.col(value).alias("v")).alias("_v"))
    both = rows.unionByName(events, allowMissingColumns=True)
    seen = F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("_v", seen).where("_side = 1").select(*left.columns, F.col("_v.v").alias(name or value))


def _box(df: DataFrame, column: str) -> str:
    return f"struct<v:{df.schema[column].dataType.simpleString()}>"


def name_events(namechange: DataFrame) -> DataFrame:
    return namechange.where(on_main_exchanges()).select("ts_code", "ann_date", name_status("name").alias("status"))


def st_status(cells: DataFrame, daily: DataFrame, stock_list: DataFrame, namechange: DataFrame) -> DataFrame:
    """trade_date, ts_code, st. In order: delisted, latest name event, listed, unlisted; a close
    below 1 turns anything but the leaving period and delisting into *ST."""
    named = as_of(cells.select("ts_code", "trade_date", "close"), name_events(namechange), "status")
    day = F.col("trade_date")
    base = (
        F.when(day >= F.col("delist_date"), S.ST_DELISTED).when(F.col("status").isNotNull(), F.col("status"))
        .when(day >= F.coalesce("list_date", "fallback_start"), S.ST_NORMAL).otherwise(S.ST_UNLISTED)
    )
    return named.join(stock_attrs(daily, stock_list), "ts_code").withColumn("base", base).select(
        "trade_date", "ts_code", F.when((F.col("close") < 1) & ~F.col("base").isin(S.ST_LEAVING, S.ST_DELISTED), S.ST_STAR).otherwise(F.col("base")).alias("st")
    )


def limit_flags(cells: DataFrame) -> DataFrame:
    """Touch flags. ``up``/``down`` count the nested levels: 0 none, 1 close, 2 and open, 3 and low or high."""
    bounded = F.col("up_limit") < S.NO_LIMIT_FROM
    at_top = lambda c: F.coalesce(bounded & (F.col(c) >= F.col("up_limit")), F.lit(False))
    at_bottom = lambda c: F.coalesce(bounded & (F.col(c) <= F.col("down_limit")), F.lit(False))
    level = lambda a, b, c: F.when(~a, 0).when(~b, 1).when(~c, 2).otherwise(3)
    return cells.select(
        "ts_code", "trade_date", F.col("close").isNotNull().alias("has_data"), F.coalesce(F.col("up_limit") >= S.NO_LIMIT_FROM, F.lit(False)).alias("no_limit"),
        level(at_top("close"), at_top("open"), at_top("low")).alias("up"), level(at_bottom("close"), at_bottom("open"), at_bottom("high")).alias("down"),
    )


def limit_status(cells: DataFrame) -> DataFrame:
    """trade_date, ts_code, lim. The day before is that of the grid: a suspended one touched nothing."""
    before = lambda c: F.coalesce(F.lag(c).over(along()), F.lit(0)) > 0
    f = limit_flags(cells).withColumns({"was_up": before("up"), "was_down": before("down")})
    free = (F.col("up") == 0) & (F.col("down") == 0)
    lim = (
        F.when(~F.col("has_data"), None).when(F.col("was_down") & free, "1").when(F.col("was_up") & free, "-1")
        .when(F.col("down") > 0, (F.col("down") * -2).cast("string")).when(F.col("up") > 0, (F.col("up") * 2).cast("string"))
        .when(F.col("no_limit"), "127").otherwise("0")
    )
    return f.select("trade_date", "ts_code", lim.alias("lim"))


def cap_status(cells: DataFrame) -> DataFrame:
    """trade_date, ts_code, cap from the rank among the day's known values, without a join back."""
    known = F.col("circ_mv").isNotNull()
    rank = F.percent_rank().over(Window.partitionBy("trade_date", known).orderBy("circ_mv"))
    return cells.select("trade_date", "ts_code", "circ_mv", rank.alias("pct")).select(
        "trade_date", "ts_code", F.when(F.col("circ_mv").isNull(), None).when(F.col("pct") <= S.CAP_SMALL, "4").when(F.col("pct") >= S.CAP_LARGE, "8").otherwise("6").alias("cap")
    )


def status_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.STATUS_CODES, "status_kind string, type string, code string, description string, buyable boolean")


def attributes_of(daily: DataFrame, stock_list: DataFrame) -> DataFrame:
    """Attributes for every code of the grid."""
    return codes(daily).join(stock_attrs(daily, stock_list), "ts_code")
