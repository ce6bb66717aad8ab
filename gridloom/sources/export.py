"""Date-by-security wide tables and the way back. The stored form is long; wide is an export."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOT_UP_TO = 500


def names(panel: DataFrame) -> list[str]:
    """The codes of a panel in order: column names, bounded by the securities."""
    return [r[0] for r in panel.select("ts_code").distinct().orderBy("ts_code").collect()]


def _values(rows: pa.Table, codes: pa.Array) -> pa.Array:
    """The values of one date's rows in the order of ``codes``, null for a code that has no row."""
    place = pc.index_in(rows.column("ts_code").combine_chunks(), value_set=codes)
    known = np.flatnonzero(place.is_valid())
    source = np.full(len(codes), -1)
    source[place.drop_null().to_numpy(zero_copy_only=False)] = known
    return rows.column("v").combine_chunks().take(pa.array(source, mask=source < 0))


def wide(panel: DataFrame, value: str, codes: list[str] | None = None) -> DataFrame:
    """trade_date and one column per code. A few hundred codes are pivoted in the engine; for more,
    whose pivot costs grow with dates times codes squared, each date's rows are laid out by Arrow."""
    columns = codes if codes is not None else names(panel)
    if len(columns) <= PIVOT_UP_TO:
        return panel.groupBy("trade_date").pivot("ts_code", columns).agg(F.first(value)).orderBy("trade_date")
    kind = panel.schema[value].dataType
    schema = T.StructType([T.StructField("trade_date", T.DateType()), *[T.StructField(n, kind) for n in columns]])
    order = pa.array(columns)

    def lay(rows: pa.Table) -> pa.Table:
        values = _values(rows, order)
        return pa.table([rows.column("trade_date")[:1], *[values[i : i + 1] for i in range(len(columns))]], names=["trade_date", *columns])

    return panel.select("trade_date", "ts_code", F.col(value).alias("v")).groupBy("trade_date").applyInArrow(lay, schema).orderBy("trade_date")


def blocks(panel: DataFrame, value: str, codes: list[str] | None = None) -> DataFrame:
    """The wide form in blocks of PIVOT_UP_TO columns: trade_date, block (from 0), codes and the date's
    values in their order, null where it has none. A plan does not grow with the codes, as it does for a
    table of tens of thousands of columns; every date has every block."""
    columns = codes if codes is not None else names(panel)
    kind = panel.schema[value].dataType
    schema = T.StructType([T.StructField("trade_date", T.DateType()), T.StructField("block", T.IntegerType()), T.StructField("codes", T.ArrayType(T.StringType())), T.StructField("values", T.ArrayType(kind))])
    order = pa.array(columns, pa.string())
    cuts = pa.array([*range(0, len(columns), PIVOT_UP_TO), len(columns)], pa.int32())

    def lay(rows: pa.Table) -> pa.Table:
        n = len(cuts) - 1
        return pa.table(
            [pa.array([rows.column("trade_date")[0].as_py()] * n, pa.date32()), pa.array(range(n), pa.int32()), pa.ListArray.from_arrays(cuts, order), pa.ListArray.from_arrays(cuts, _values(rows, order))],
            names=schema.names,
        )

    return panel.select("trade_date", "ts_code", F.col(value).alias("v")).groupBy("trade_date").applyInArrow(lay, schema)


def long(panel: DataFrame, value: str) -> DataFrame:
    """The wide form, whole or in blocks, unpivoted, nulls included."""
    if dict(panel.dtypes).get("block") == "int" and panel.columns == ["trade_date", "block", "codes", "values"]:
        cells = F.inline(F.arrays_zip(F.col("codes"), F.col("values"))).alias("ts_code", value)
        return panel.select("trade_date", cells)
    return panel.unpivot("trade_date", [f"`{c}`" for c in panel.columns if c != "trade_date"], "ts_code", value)


def write(panel: DataFrame, path: str) -> None:
    """One ordered file for a wide table, whose size the calendar bounds."""
    panel.coalesce(1).sortWithinPartitions("trade_date").write.mode("overwrite").parquet(path)
