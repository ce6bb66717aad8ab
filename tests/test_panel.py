import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom import schemas as S
from gridloom.operators import adjust, checks, market, pressure, response, status, trend
from gridloom.operators.grid import grid
from gridloom.plans import publish
from gridloom.sources import export, ingest, tables
from gridloom.streaming import upserts

DAYS = [d.date() for d in pd.bdate_range("2021-03-01", periods=80)]


def frame(spark, table, rows):
    names = S.TABLES[table].names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.TABLES[table])


def bars(spark, cells):
    return frame(spark, "daily", [{"ts_code": c, "trade_date": DAYS[i], "close": v} for c, i, v in cells])


@pytest.fixture(scope="module")
def market_of_four(spark):
    """A steady share, one that is renamed twice and leaves, one that stops trading before it leaves, and one
    that is about to leave and stays."""
    price = {"600711.SH": lambda i: 20 + 0.5 * i, "002345.SZ": lambda i: 3 - 0.02 * i, "300456.SZ": lambda i: 7 + 0.1 * i, "688999.SH": lambda i: 2 + 0.03 * i}
    traded = {"600711.SH": range(72), "002345.SZ": range(3, 44), "300456.SZ": range(57), "688999.SH": range(1, 72)}
    daily = bars(spark, [(c, i, float(price[c](i))) for c, days in traded.items() for i in days])
    ends = {"002345.SZ": 44, "300456.SZ": 60}
    listed = frame(spark, "stock_list", [{"ts_code": c, "list_date": DAYS[days[0]], "delist_date": DAYS[ends[c]] if c in ends else None} for c, days in traded.items()])
    events = {"002345.SZ": {6: "ST河马", 12: "河马退", 45: "河马"}, "300456.SZ": {10: "*ST海风"}, "688999.SH": {10: "退海风"}}
    names = frame(spark, "namechange", [{"ts_code": c, "ann_date": DAYS[i], "name": n} for c, e in events.items() for i, n in e.items()])
    cells = grid(daily)
    st = status.st_status(cells, daily, listed, names)
    day = DAYS.index
    at = {(r.ts_code, day(r.trade_date)): r.st for r in st.collect()}
    ahead = {(r.ts_code, day(r.trade_date)): r for r in response.responses(cells, st).collect()}
    return price, at, ahead


def test_a_status_follows_names_until_the_end(market_of_four):
    _, at, _ = market_of_four
    runs = {("002345.SZ", 0, 2): "-2", ("002345.SZ", 6, 11): "2", ("002345.SZ", 12, 43): "5", ("002345.SZ", 44, 71): "6", ("300456.SZ", 10, 59): "4", ("300456.SZ", 60, 71): "6", ("688999.SH", 0, 0): "-2", ("688999.SH", 10, 71): "5"}
    for (code, first, last), want in runs.items():
        assert {at[code, i] for i in range(first, last + 1)} == {want}, code


@pytest.mark.parametrize("h", list(S.RESPONSES))
def test_returns_look_ahead_and_end_in_a_loss(market_of_four, h):
    price, _, ahead = market_of_four
    get = lambda c, i: ahead[c, i][f"rr_{h}"]
    for code, i in (("600711.SH", 20), ("600711.SH", 0), ("688999.SH", 25)):
        assert get(code, i) == pytest.approx(price[code](i + h) / price[code](i) - 1, rel=1e-4)
    if h < 30:
        assert get("002345.SZ", 12) == pytest.approx(price["002345.SZ"](12 + h) / price["002345.SZ"](12) - 1, rel=1e-4)
    assert get("002345.SZ", 44 - h) == -1 and (h == 3 or get("300456.SZ", 60 - h) == -1)
    for code, i in (("002345.SZ", 1), ("002345.SZ", 50), ("300456.SZ", 58), ("600711.SH", 71)):
        assert get(code, i) is None


def test_code_table(spark):
    rows = {(r.status_kind, r.code): r.buyable for r in status.status_codes(spark).collect()}
    assert len(rows) == 23 and not rows["ST", "5"] and not rows["ST", "6"]


def test_limit_tree(spark):
    # close, open, high, low, up, down -> status, one row a branch, in calendar order
    day = [
        ((10, 10, 10, 10, 999999.999, 0), "127"), ((10, 10, 10, 10, 11, 9), "0"), ((11, 10, 11, 10, 11, 9), "2"), ((10, 10, 10, 10, 11, 9), "-1"),
        ((11, 11, 11, 10, 11, 9), "4"), ((11, 11, 11, 11, 11, 9), "6"), ((9, 10, 10, 9, 11, 9), "-2"), ((10, 10, 10, 10, 11, 9), "1"),
        ((9, 9, 10, 9, 11, 9), "-4"), ((9, 9, 9, 9, 11, 9), "-6"), (None, None), ((10, 10, 10, 10, 11, 9), "0"), ((10, 10, 10, 10, None, None), "0"),
    ]
    rows = [("a", DAYS[i], *[None if x is None else float(x) for x in (v or [None] * 6)]) for i, (v, _) in enumerate(day)]
    cells = spark.createDataFrame(rows, "ts_code string, trade_date date, close float, open float, high float, low float, up_limit float, down_limit float")
    assert [r.lim for r in status.limit_status(cells).orderBy("trade_date").collect()] == [s for _, s in day]
    both = cells.where(F.col("close") == 10).withColumns({"up_limit": F.lit(10.0), "down_limit": F.lit(10.0)})
    with pytest.raises(checks.CheckFailed):
        checks.require_empty(checks.limit_conflicts(both), "conflict")


def test_cap_bounds(spark):
    rows = [("c%02d" % i, DAYS[0], float(i)) for i in range(11)] + [("x", DAYS[0], None), ("one", DAYS[1], 5.0)]
    cap = {(r.ts_code): r.cap for r in status.cap_status(spark.createDataFrame(rows, "ts_code string, trade_date date, circ_mv float")).collect()}
    assert cap["c02"] == "4" and cap["c03"] == "6" and cap["c08"] == "6" and cap["c09"] == "8" and cap["x"] is None and cap["one"] == "4"


def test_discrete_and_boards(spark):
    got = spark.createDataFrame([(i, v) for i, v in enumerate([0.5, -0.5, -2.5, 20.5, -30.0, None])], "i int, p float").orderBy("i").select(market.discrete("p").alias("d")).collect()
    assert [r.d for r in got] == [1, -1, -3, 20, -20, None]
    codes = bars(spark, [(c, 0, 1.0) for c in ("300001.SZ", "688001.SH", "689001.SH", "600001.SH", "300001.SH", "830001.BJ")])
    assert {r.ts_code: (r.board, r.mkt_index) for r in market.board(codes).collect()} == {"300001.SZ": ("创业板", "399006.SZ"), "688001.SH": ("科创板", "399006.SZ"), "689001.SH": ("科创板", "399006.SZ"), "600001.SH": ("主板", "000001.SH"), "300001.SH": ("主板", "000001.SH")}


def test_names_trim_unicode_spaces(spark):
    got = spark.createDataFrame([("　ST a",), ("a退 ",), (" *ST",), ("aST",)], "n string").select(status.name_status("n").alias("s")).collect()
    assert [r.s for r in got] == ["2", "5", "4", "0"]


def test_adjusted_close_uses_last_known_factor(spark):
    cells = spark.createDataFrame([("a", DAYS[0], 0, 10.0, 1.0), ("a", DAYS[1], 1, 10.0, 2.0), ("a", DAYS[2], 2, None, None)], "ts_code string, trade_date date, pos int, close float, adj_factor float")
    assert [r.close for r in adjust.adj_close(cells).orderBy("pos").collect()] == [5.0, 10.0, None]


def panel(spark, rng, codes=4, days=120):
    dates = [d.date() for d in pd.bdate_range("2020-01-01", periods=days)]
    return [(f"c{c}", dates[i], i, None if rng.random() < 0.12 else float(rng.uniform(5, 15))) for c in range(codes) for i in range(days)]


def test_line_trend_against_polyfit(spark):
    rows = panel(spark, np.random.default_rng(1))
    got = {(r.ts_code, r.trade_date): r.tr_10 for r in trend.trends(spark.createDataFrame(rows, "ts_code string, trade_date date, pos int, close float"), {10: "ols"}).collect()}
    for c in range(4):
        mine = [r for r in rows if r[0] == f"c{c}"]
        for i, r in enumerate(mine):
            w = [(x[2], np.log(np.float32(x[3]))) for x in mine[max(0, i - 9) : i + 1] if x[3]]
            want = np.expm1(np.polyfit(*zip(*w), 1)[0] * 9) if i >= 9 and r[3] and len(w) >= 8 else None
            assert (got[r[0], r[1]] is None) == (want is None) and (want is None or got[r[0], r[1]] == pytest.approx(want, abs=1e-5))
    with pytest.raises(ValueError):
        trend.ols_trend(F.lit(1), 1)


def test_appended_trends_equal_full(spark, tmp_path):
    rows = panel(spark, np.random.default_rng(2))
    close = spark.createDataFrame(rows, "ts_code string, trade_date date, pos int, close float")
    full = {tuple(r) for r in trend.trends(close).collect()}
    trend.trends(close.where("pos < 100 and ts_code <> 'c3'")).write.parquet(str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    assert checks.prefix_violations(old, close).count() == 0
    fresh = trend.append_trends(close, old)
    assert fresh.count() == 3 * 20 + 120 and {tuple(r) for r in old.union(fresh).collect()} == full
    assert {r.problem for r in checks.prefix_violations(old, close.where("ts_code <> 'c0' and pos <> 5")).collect()} == {"unknown date", "vanished code"}


def test_ingest_ledger_and_replay(spark, tmp_path):
    root = str(tmp_path)

    def fetch(day):
        if day.endswith("03"):
            raise OSError("down")
        return [] if day.endswith("04") else [{"ts_code": "a", "trade_date": day, "close": 1.0}, {"ts_code": "a", "trade_date": day, "close": 2.0}]

    dates = ["20200102", "20200103", "20200104", "20200203"]
    assert list(ingest.ingest(spark, root, "daily", "daily", dates, fetch).values()) == ["success", "failed", "empty", "failed"]
    ingest.ingest(spark, root, "daily", "daily", dates[:1], fetch)
    rows = tables.read(spark, root, "daily").collect()
    assert [(r.trade_date, r.close) for r in rows] == [(dt.date(2020, 1, 2), 2.0)]
    left = ingest.missing_dates(ingest.calendar_days(spark, "20200102", "20200104"), tables.read(spark, root, "download_status"), "daily")
    assert [r[0] for r in left.collect()] == ["20200103"]
    assert ingest.resume_date(tables.read(spark, root, "download_status"), "other").first()[0] == "20140101"
    with pytest.raises(ValueError):
        ingest.ingest(spark, root, "daily", "daily", ["2020-01-02"], fetch)
    bad = spark.createDataFrame([("a", "20200230")], "ts_code string, trade_date string")
    with pytest.raises(Exception, match="not a YYYYMMDD date"):
        ingest.typed(bad, "daily").collect()


class Vendor(ingest.Source):
    def fetch(self, dataset, day, fields):
        if dataset == "stk_limit" and day == "20200103":
            raise OSError("down")
        rows = {"trade_date": day, "ann_date": day, "start_date": None, "ts_code": dataset if dataset in S.DATASETS and S.DATASETS[dataset].table == "index_daily" else "600711.SH"}
        return [{f: rows.get(f, 1.0 if f not in ("name", "change_reason") else "n") for f in fields}]

    def trading_days(self, first, last):
        return [{"cal_date": d, "is_open": int(d != "20200104")} for d in ("20200103", "20200102", "20200104") if first <= d <= last]

    def stocks(self, list_status):
        code = {"L": "600711.SH", "D": "600712.SH", "P": "830001.BJ"}[list_status]
        return [{"ts_code": code, "name": "n", "list_status": list_status.lower() if list_status == "D" else list_status, "list_date": "20000101", "delist_date": None}]


def test_all_datasets_are_brought_up_to_date(spark, tmp_path):
    root = str(tmp_path)
    got = ingest.update(spark, root, Vendor(), "20200101", "20200105")
    assert got["daily"] == {"20200102": "success", "20200103": "success"} and got["stk_limit"]["20200103"] == "failed" and len(got["namechange"]) == 5
    assert {r.ts_code for r in tables.read(spark, root, "index_daily").collect()} == {"000001.SH", "399001.SZ", "399006.SZ"}
    assert {(r.ts_code, r.list_status) for r in tables.read(spark, root, "stock_list").collect()} == {("600711.SH", "L"), ("600712.SH", "D")}
    again = ingest.update(spark, root, Vendor(), "20200101", "20200105")
    assert {d: n for d, n in again.items() if n} == {"stk_limit": {"20200103": "failed"}}

    class Broken(Vendor):
        def stocks(self, list_status):
            raise OSError("down")

    with pytest.raises(OSError):
        ingest.update(spark, root, Broken(), "20200101", "20200105")
    assert tables.read(spark, root, "stock_list").count() == 2


def test_a_swap_cut_off_is_taken_back(spark, tmp_path):
    root = str(tmp_path)
    tables.replace(spark, root, "stock_list", frame(spark, "stock_list", [{"ts_code": "600711.SH"}]))
    (tmp_path / "stock_list").rename(tmp_path / "_old-stock_list")
    assert tables.read(spark, root, "stock_list").count() == 1
    assert tables.read(spark, tables.snapshot(spark, root, f"{root}/backup"), "stock_list").count() == 1


def test_stream_of_files_is_merged(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "root")
    bars(spark, [("a", 0, 1.0), ("b", 30, 2.0)]).write.parquet(src)
    upserts.follow(spark, src, root, "daily", str(tmp_path / "ck")).awaitTermination(60)
    bars(spark, [("a", 0, 3.0)]).write.mode("append").parquet(src)
    upserts.follow(spark, src, root, "daily", str(tmp_path / "ck")).awaitTermination(60)
    assert {(r.ts_code, r.close) for r in tables.read(spark, root, "daily").collect()} == {("a", 3.0), ("b", 2.0)}


def test_wide_and_back(spark, monkeypatch):
    rows = [("a.SZ", DAYS[0], 1.0), ("b.SZ", DAYS[0], None), ("a.SZ", DAYS[1], 2.0), ("b.SZ", DAYS[1], 3.0)]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, v float")
    one = export.wide(df, "v").collect()
    monkeypatch.setattr(export, "PIVOT_UP_TO", 1)
    assert export.wide(df, "v").collect() == one
    assert {tuple(r) for r in export.long(export.wide(df, "v"), "v").select("ts_code", "trade_date", "v").collect()} == set(rows)


def test_blocks_of_columns_and_back(spark, monkeypatch):
    rows = [("a.SZ", DAYS[0], 1.0), ("c.SZ", DAYS[0], 4.0), ("a.SZ", DAYS[1], 2.0), ("b.SZ", DAYS[1], 3.0), ("e.SZ", DAYS[1], None)]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, v float")
    monkeypatch.setattr(export, "PIVOT_UP_TO", 2)
    blocks = export.blocks(df, "v")
    known = {(c, d): v for c, d, v in rows}
    codes = ["a.SZ", "b.SZ", "c.SZ", "e.SZ"]
    assert sorted((r.trade_date, r.block, r.codes) for r in blocks.collect()) == [(d, i, codes[2 * i : 2 * i + 2]) for d in DAYS[:2] for i in (0, 1)]
    assert sorted(((r.ts_code, r.trade_date), r.v) for r in export.long(blocks, "v").collect()) == sorted(((c, d), known.get((c, d))) for c in codes for d in DAYS[:2])


def test_plan_of_wide_status_does_not_grow_with_the_codes(spark, monkeypatch):
    from gridloom.plans import queries

    monkeypatch.setattr(export, "PIVOT_UP_TO", 3)
    got = queries.QUERIES["wide_st"](spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.collect()
    assert not any(r.ts_code in plan for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.st(spark, "/root/testdata/sf0.001").collect()))


def test_slumps_do_not_overlap(spark):
    chg = [0, -1, -5, -9, -8, -1, 0, 2, -7, -7, -7, 0]
    df = frame(spark, "index_daily", [{"ts_code": "i", "trade_date": DAYS[i], "pct_chg": float(x)} for i, x in enumerate(chg)])
    got = pressure.slumps(df, worst=2).orderBy("rank").collect()
    assert [r.trade_date for r in got] == [DAYS[4], DAYS[10]]


def test_publish_twice(spark, tmp_path):
    root, out = str(tmp_path / "db"), str(tmp_path / "out")
    cells = [(c, i, 10.0 + i) for c in ("000001.SZ", "300001.SZ") for i in range(40)]
    def store(n):
        tables.upsert(spark, root, "daily", bars(spark, [x for x in cells if x[1] < n]))
        tables.upsert(spark, root, "adj_factor", frame(spark, "adj_factor", [{"ts_code": c, "trade_date": DAYS[i], "adj_factor": 1.0} for c, i, _ in cells if i < n]))
        tables.replace(spark, root, "index_daily", frame(spark, "index_daily", [{"ts_code": k, "trade_date": DAYS[i], "pct_chg": 1.0} for k in S.MARKET_INDEXES for i in range(n)]))
    for n in (30, 40):
        store(n)
        paths = publish.publish(spark, root, out, wide=n == 40)
    files = sorted(p.name for p in (tmp_path / "out/features/trends").iterdir())
    publish.publish(spark, root, out, measures=("amount", "pe"))
    assert sorted(p.name for p in (tmp_path / "out/features/trends").iterdir()) == files
    with pytest.raises(checks.CheckFailed):
        publish.publish(spark, str(tmp_path / "none"), out)
    t = spark.read.parquet(paths["features/trends"])
    assert t.count() == 80 and t.where("tr_10 is not null").count() == 2 * 31
    assert spark.read.parquet(paths["wide/close"]).columns == ["trade_date", "000001.SZ", "300001.SZ"]
