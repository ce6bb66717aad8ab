"""Panel tables made from the star-schema sample tables, as SQL that two engines run alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CODE = """(CASE s % 10 WHEN 0 THEN '300' WHEN 1 THEN '688' WHEN 2 THEN '689' WHEN 3 THEN '600' WHEN 4 THEN '830' ELSE '000' END
 || lpad(CAST(s AS string), 6, '0') || CASE WHEN s % 10 IN (1, 2, 3) THEN '.SH' WHEN s % 10 = 4 THEN '.BJ' ELSE '.SZ' END)"""

#: Views in order; each may read the sample tables and the views before it.
VIEWS: dict[str, str] = {
    "weekly": """SELECT l_suppkey AS s, CAST(date_trunc('week', l_shipdate) AS date) AS trade_date, count(*) AS n,
 sum(CAST(round(l_extendedprice * 100) AS bigint)) AS sc, max(CAST(round(l_extendedprice * 100) AS bigint)) AS mx,
 min(CAST(round(l_extendedprice * 100) AS bigint)) AS mn, sum(CAST(l_quantity AS bigint)) AS q
FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('week', l_shipdate) AS date)""",
    "priced": """SELECT s, trade_date, n, CAST(sc AS bigint) AS sc, mx, mn, CAST(q AS bigint) AS q, u,
 CAST(100 * u + u * (sc % 25 - 12) AS bigint) AS cc
FROM (SELECT *, CASE WHEN s % 4 = 0 THEN 1 ELSE 10 * (1 + s % 7) END AS u FROM weekly) w""",
    "ranged": """SELECT *, cc + u * (mx % 4) AS hc, cc - u * (mn % 4) AS lc, lag(cc) OVER (PARTITION BY s ORDER BY trade_date) AS pc FROM priced""",
    "bars": f"""SELECT {_CODE} AS ts_code, s, trade_date, CAST((CASE WHEN n % 2 = 0 THEN hc ELSE lc END) / 100.0D AS float) AS open, CAST(hc / 100.0D AS float) AS high,
 CAST(lc / 100.0D AS float) AS low, CAST(cc / 100.0D AS float) AS close, CAST(100.0D * (CAST(cc AS double) / CAST(pc AS double) - 1.0D) AS float) AS pct_chg,
 CAST(sc / 100.0D AS float) AS amount, CAST(q AS float) AS turnover_rate_f, CAST(sc * (1 + s % 5) / 100.0D AS float) AS circ_mv,
 CASE WHEN sc % 11 <> 0 THEN CAST(1.0D + 0.1D * (year(trade_date) - 1995) AS float) END AS adj_factor,
 CAST(CASE WHEN pc IS NULL THEN 999999.999D ELSE pc * 110 / 10000.0D END AS float) AS up_limit, CAST(CASE WHEN pc IS NULL THEN 0.0D ELSE pc * 90 / 10000.0D END AS float) AS down_limit
FROM ranged""",
    "daily": "SELECT ts_code, trade_date, open, high, low, close, pct_chg, amount FROM bars",
    "adj_factor": "SELECT ts_code, trade_date, adj_factor FROM bars",
    "stk_limit": "SELECT ts_code, trade_date, up_limit, down_limit FROM bars",
    "daily_basic": "SELECT ts_code, trade_date, turnover_rate_f, circ_mv FROM bars",
    "stock_list": f"""SELECT {_CODE} AS ts_code, s_name AS name, CAST(NULL AS string) AS industry, CASE WHEN s % 3 = 0 THEN 'D' ELSE 'L' END AS list_status,
 CASE WHEN s % 17 <> 0 THEN CAST('1995-03-06' AS date) END AS list_date, CASE WHEN s % 7 = 0 THEN CAST('1999-06-07' AS date) END AS delist_date
FROM (SELECT s_suppkey AS s, s_name FROM supplier) x WHERE s % 13 <> 0""",
    "namechange": f"""SELECT {_CODE} AS ts_code, CASE substr(p, 1, 1) WHEN '1' THEN '*ST a' WHEN '2' THEN 'ST a' WHEN '3' THEN 'a退' WHEN '4' THEN '退a' ELSE 'a' END AS name, ann_date
FROM (SELECT o_custkey % (SELECT count(*) FROM supplier) AS s, CAST(o_orderdate AS date) AS ann_date, min(o_orderpriority) AS p FROM orders GROUP BY 1, 2) x""",
    "index_daily": """SELECT i.ts_code, trade_date, CAST(sc % i.m - i.o AS float) / CAST(2.0D AS float) AS pct0, CAST((sc % i.m - i.o) / 2.0D AS float) AS pct_chg
FROM (SELECT trade_date, CAST(sum(sc) AS bigint) AS sc FROM weekly GROUP BY trade_date) w CROSS JOIN (SELECT '000001.SH' AS ts_code, 25 AS m, 12 AS o UNION ALL SELECT '399006.SZ', 49, 24) i""",
    "download_status": """SELECT 'daily' AS dataset, logical_date, CASE st WHEN 'F' THEN 'success' WHEN 'O' THEN 'empty' ELSE 'failed' END AS status
FROM (SELECT replace(CAST(CAST(o_orderdate AS date) AS string), '-', '') AS logical_date, max(o_orderstatus) AS st FROM orders GROUP BY 1) x""",
}
VIEWS["index_daily"] = VIEWS["index_daily"].replace(" CAST(sc % i.m - i.o AS float) / CAST(2.0D AS float) AS pct0,", "")
_READS = {"weekly": ["lineitem"], "priced": ["weekly"], "ranged": ["priced"], "bars": ["ranged"], "stock_list": ["supplier"], "namechange": ["orders", "supplier"], "index_daily": ["weekly"], "download_status": ["orders"]} | {t: ["bars"] for t in ("daily", "adj_factor", "stk_limit", "daily_basic")}


def needed(*names: str) -> list[str]:
    """The views that ``names`` rest on, in order."""
    want: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n in VIEWS and n not in want:
            want.add(n)
            todo += _READS[n]
    return [n for n in VIEWS if n in want]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the sample tables of ``sf_dir``, as a frame of its own."""
    views = needed(name)
    base = {t for v in views for t in _READS[v] if t not in VIEWS}
    with_ = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views)
    text = f"WITH {with_}\nSELECT * FROM {name}"
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in base}
    for t in base:
        text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"FROM {t})", f"FROM {{{t}}})")
    return spark.sql(text, **frames)


def oracle(body: str, *names: str, more: str = "") -> str:
    """``body`` with the views it reads as common tables, for the other engine."""
    with_ = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed(*names))
    text = f"WITH {with_}{',' if more else ''}\n{more}\n{body}"
    return text.replace("CAST(s AS string)", "CAST(s AS varchar)").replace("AS string)", "AS varchar)").replace(".0D", ".0::double").replace("0.1D", "0.1::double").replace("999999.999D", "999999.999::double")
