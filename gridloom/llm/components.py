"""Connected components of an edge table by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014). Each step is an
aggregate and a join on the edge table, written to the shared folder; nothing but a count and a
checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def _onto_least(rows: DataFrame, low: DataFrame) -> DataFrame:
    """Rows (u, v) with the m of their u; rows of one u are salted and ``low`` is copied for each salt in use."""
    copied = low.select("u", "m", F.explode(store.salts("used")).alias("salt"))
    return rows.withColumn("salt", store.salt("v")).join(copied, ["u", "salt"]).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected edges (a > b)."""
    rows = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        rows = rows.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = rows.groupBy("u").agg(F.min("v").alias("m"), store.salts_used(store.salt("v")).alias("used"))
    if large:
        out = _onto_least(rows.where("v > u"), low.withColumn("m", F.least("m", "u")))
    else:
        out = _onto_least(rows, low).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has long columns a and b in any order. Returns (node, component): each node of an
    edge between different nodes with the smallest node it reaches; component < node, so minima have
    no row. Nulls and loops are left out; no edges give no rows."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b and b is not null").distinct()
    e = store.table(e, "edges")
    seen = _mark(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        new = store.table(_star(_star(e, True), False), "edges")
        mark = _mark(new)
        store.drop(e)
        e = new
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]
