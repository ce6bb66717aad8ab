"""Keyed Parquet tables below one root: typed reads, upserts, replacement, snapshots.

Fact tables are partitioned by month. An upsert merges and rewrites only the months that the batch
touches; it is staged first and replaying it changes nothing, so a failed job is simply run again.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S

_MONTH = {t: "trade_date" for t in ("daily", "index_daily", "adj_factor", "daily_basic", "stk_limit")}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _aside(path: str) -> str:
    folder, _, name = path.rpartition("/")
    return f"{folder}/_old-{name}"


def _move(spark: SparkSession, src: str, dst: str) -> None:
    """Swap ``src`` in for ``dst``. The old folder is moved aside first and removed last, so a crash leaves one
    of the two, which ``_settle`` puts back."""
    fs, p = _fs(spark, src)
    q, old = _fs(spark, dst)[1], _fs(spark, _aside(dst))[1]
    _settle(spark, dst)
    if fs.exists(q) and not fs.rename(q, old):
        raise OSError(f"cannot move {dst} aside")
    if not fs.rename(p, q):
        raise OSError(f"cannot move {src} to {dst}")
    fs.delete(old, True)


def _settle(spark: SparkSession, path: str) -> None:
    fs, old = _fs(spark, _aside(path))
    if fs.exists(old):
        q = _fs(spark, path)[1]
        fs.delete(old, True) if fs.exists(q) else fs.rename(old, q)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table with its fixed schema; an empty one if nothing has been written."""
    path, schema = f"{root}/{name}", S.TABLES[name]
    _settle(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def latest(df: DataFrame, key: tuple[str, ...], order: str = "_seq") -> DataFrame:
    """One row per key, that with the greatest ``order``."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", order)


def merged(old: DataFrame, new: DataFrame, key: tuple[str, ...], *order: str) -> DataFrame:
    """Upsert: new rows replace old ones; within the batch the greatest ``order`` (columns of whole numbers)
    wins, else the row that was read last."""
    by = [F.col(c).cast("long") for c in order] or [F.monotonically_increasing_id()]
    seq = F.struct(F.lit(1).alias("new"), F.array(*by).alias("n"))
    a = old.withColumn("_seq", F.struct(F.lit(0).alias("new"), F.array(F.lit(0).cast("long")).alias("n")))
    return latest(a.unionByName(new.withColumn("_seq", seq).select(*old.columns, "_seq")), key)


def upsert(spark: SparkSession, root: str, name: str, new: DataFrame, *order: str) -> None:
    key, stage = S.PRIMARY_KEYS[name], f"{root}/_stage-{uuid.uuid4().hex}"
    old = read(spark, root, name)
    if name not in _MONTH:
        merged(old, new, key, *order).write.parquet(stage)
        return _move(spark, stage, f"{root}/{name}")
    month = F.date_format(_MONTH[name], "yyyy-MM")
    new.write.parquet(f"{stage}/new")
    new = spark.read.schema(new.schema).parquet(f"{stage}/new")
    touched = [r[0] for r in new.select(month.alias("m")).distinct().collect()]  # months, bounded by the calendar
    if touched:
        if exists(spark, f"{root}/{name}"):
            old = spark.read.schema(f"{S.TABLES[name].simpleString()[7:-1].replace(':', ' ')}, month string").parquet(f"{root}/{name}").where(F.col("month").isin(touched)).drop("month")
        out = merged(old, new, key, *order).withColumn("month", F.date_format(_MONTH[name], "yyyy-MM"))
        out.write.partitionBy("month").parquet(f"{stage}/out")
        ready = spark.read.schema(out.schema).parquet(f"{stage}/out")
        ready.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{root}/{name}")
    fs, p = _fs(spark, stage)
    fs.delete(p, True)


def replace(spark: SparkSession, root: str, name: str, new: DataFrame) -> None:
    """Full replacement: written aside, then swapped in."""
    stage = f"{root}/_stage-{uuid.uuid4().hex}"
    new.select(*S.TABLES[name].names).write.parquet(stage)
    _move(spark, stage, f"{root}/{name}")


def snapshot(spark: SparkSession, root: str, into: str) -> str:
    """Copy all tables to a time-stamped folder."""
    target = f"{into}/{datetime.now():%Y%m%d_%H%M%S}"
    for name in S.TABLES:
        if exists(spark, f"{root}/{name}"):
            read(spark, root, name).write.parquet(f"{target}/{name}")
    return target
