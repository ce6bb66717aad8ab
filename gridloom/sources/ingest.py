"""Incremental ingestion from a pluggable source, with a ledger of dates done."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import yyyymmdd
from . import tables

log = logging.getLogger(__name__)
#: Called with a YYYYMMDD date; returns rows or a pandas frame, None or empty if there are none.
Fetch = Callable[[str], "pd.DataFrame | Iterable[dict] | None"]


def calendar_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every natural day from start to end (YYYYMMDD, inclusive) as logical_date."""
    day = lambda x: F.to_date(F.lit(x), "yyyyMMdd")
    days = F.when(day(start) <= day(end), F.sequence(day(start), day(end))).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(days).alias("day")).select(F.date_format("day", "yyyyMMdd").alias("logical_date"))


def completed(ledger: DataFrame, dataset: str) -> DataFrame:
    return ledger.where((F.col("dataset") == dataset) & F.col("status").isin("success", "empty")).select("logical_date").distinct()


def missing_dates(candidates: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """Candidates not yet done; failed ones come again."""
    return candidates.select("logical_date").distinct().join(completed(ledger, dataset), "logical_date", "left_anti")


def resume_date(ledger: DataFrame, dataset: str, default: str = "20140101") -> DataFrame:
    return completed(ledger, dataset).agg(F.coalesce(F.max("logical_date"), F.lit(default)).alias("resume_date"))


def trading_days(calendar: DataFrame) -> DataFrame:
    """Open days of a calendar (cal_date as YYYYMMDD text, is_open 0 or 1), ascending."""
    return calendar.where(F.col("is_open").cast("int") == 1).select(F.col("cal_date").cast("string").alias("logical_date")).distinct().orderBy("logical_date")


def typed(rows: DataFrame, table: str, *more: str) -> DataFrame:
    """Columns of the table in its types; dates come as YYYYMMDD text, NaN becomes null, missing columns are null."""
    def one(f):
        if f.name not in rows.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c, kind = F.col(f.name), rows.schema[f.name].dataType.typeName()
        if f.dataType.typeName() == "date" and kind == "string":
            c = yyyymmdd(c)
        elif kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return c.cast(f.dataType).alias(f.name)

    return rows.select(*[one(f) for f in S.TABLES[table]], *more)


def ingest(spark: SparkSession, root: str, dataset: str, table: str, dates: Iterable[str], fetch: Fetch, pause: float = 0.0) -> dict[str, str]:
    """Fetch each date on its own: a failure is noted and the others go on. What was fetched is written month
    by month, data first and the ledger last, so a crash repeats a month at most."""
    if table not in S.TABLES:
        raise ValueError(f"unknown table {table!r}")
    frames, notes, done = [], [], {}
    for date in dates:
        if len(date) != 8 or not date.isdigit():
            raise ValueError(f"not a YYYYMMDD date: {date!r}")
        if notes and notes[-1][1][:6] != date[:6]:
            done |= _flush(spark, root, table, frames, notes)
            frames, notes = [], []
        try:
            got = fetch(date)
            got = got if isinstance(got, pd.DataFrame) else pd.DataFrame(list(got or []))
            notes.append((dataset, date, "success" if len(got) else "empty", len(got), None))
            if len(got):
                frames.append(got)
        except Exception as e:  # noqa: BLE001  any failure of a source belongs in the ledger
            log.warning("%s %s failed: %s", dataset, date, e)
            notes.append((dataset, date, "failed", 0, str(e)[:500]))
        time.sleep(pause)
    return done | _flush(spark, root, table, frames, notes)


def _flush(spark: SparkSession, root: str, table: str, frames: list[pd.DataFrame], notes: list[tuple]) -> dict[str, str]:
    if frames:
        batch = pd.concat(frames, ignore_index=True).dropna(axis=1, how="all")  # columns without a value have no type
        batch["_n"] = range(len(batch))
        tables.upsert(spark, root, table, typed(spark.createDataFrame(batch), table, "_n"), "_n")
    if notes:
        entry = spark.createDataFrame(notes, "dataset string, logical_date string, status string, row_count int, message string").withColumn("updated_at", F.current_timestamp())
        tables.upsert(spark, root, "download_status", entry)
    return {n[1]: n[2] for n in notes}


class Source:
    """A vendor: rows of a dataset for a YYYYMMDD date, its calendar, its lists of securities."""

    def fetch(self, dataset: str, date: str, fields: list[str]) -> pd.DataFrame | Iterable[dict] | None:
        raise NotImplementedError

    def trading_days(self, first: str, last: str) -> Iterable[dict]:
        """Rows with cal_date and is_open."""
        raise NotImplementedError

    def stocks(self, list_status: str) -> Iterable[dict]:
        raise NotImplementedError


def update(spark: SparkSession, root: str, source: Source, first: str, last: str, pause: float = 0.0) -> dict[str, dict[str, str]]:
    """Bring every dataset up to date for the days from ``first`` to ``last``, then the list of securities;
    what became of each missing date, by dataset. A dataset without missing dates is left alone."""
    text = lambda rows, *names: spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    open_days = trading_days(text(source.trading_days(first, last), "cal_date", "is_open"))
    out = {}
    for name, d in S.DATASETS.items():
        days = open_days if d.on_trading_days else calendar_days(spark, first, last)
        todo = [r[0] for r in missing_dates(days, tables.read(spark, root, "download_status"), name).orderBy("logical_date").collect()]  # days
        out[name] = ingest(spark, root, name, d.table, todo, lambda day, n=name, f=d.fields: source.fetch(n, day, f), pause)
    lists = [text(source.stocks(s), *S.TABLES["stock_list"].names) for s in S.LIST_STATUS]
    tables.replace(spark, root, "stock_list", stock_list(lists))
    return out


def stock_list(batches: list[DataFrame]) -> DataFrame:
    """Union of the listed, delisted and paused lists in the table's form: other exchanges out, status
    letters in upper case, by code. A list that could not be fetched must fail the caller: replacing
    the table with a part would lose codes."""
    if not batches:
        raise ValueError("no list was fetched")
    rows = typed(batches[0], "stock_list")
    for b in batches[1:]:
        rows = rows.unionByName(typed(b, "stock_list"))
    return rows.where(~F.col("ts_code").contains("BJ")).withColumn("list_status", F.replace("list_status", F.lit("d"), F.lit("D"))).orderBy("ts_code")


def list_status_counts(stocks: DataFrame) -> DataFrame:
    return stocks.groupBy("list_status").agg(F.count("*").alias("n")).orderBy(F.desc("n"))
