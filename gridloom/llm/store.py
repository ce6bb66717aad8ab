"""Shared-folder tables that cut lineage, and row keys common to the operators.

Every operator that needs an intermediate result more than once writes it as Parquet below the
folder that the cluster names in ``spark.checkpoint.dir`` and reads it back, so that a lost executor
costs a re-read and not a recomputation, and nothing depends on a machine's own disk.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_libc = ctypes.CDLL(None)
_written: list[tuple[SparkSession, str]] = []
_shared: list = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one of our own only where the setting is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="gridloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_all)
    _written.append((spark, path))
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove a table made by ``table`` that nothing will read again."""
    for f in df.inputFiles()[:1]:
        path = f.rsplit("/", 1)[0]
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove_all() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended before this hook
            return


_SALTS = 16


def salt(c: Column | str) -> Column:
    """A number under 16 by which rows of one key are spread."""
    return F.pmod(F.xxhash64(c, F.lit(0x5A17)), F.lit(_SALTS)).cast("int")


def salts_used(c: Column | str) -> Column:
    """Aggregate: a bit for each salt of a key."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), F.col(c) if isinstance(c, str) else c))


def salts(used: str) -> Column:
    """The salts of ``salts_used``, to copy the other side of a join for each."""
    return F.expr(f"filter(sequence(0, {_SALTS - 1}), i -> (shiftright({used}, i) & 1) = 1)")


def share(spark: SparkSession, value):
    """Broadcast of a value of bounded size; ``unshare`` or ``settled`` takes it away again."""
    b = spark.sparkContext.broadcast(value)
    _shared.append(b)
    return b


def unshare(b) -> None:
    """Remove a broadcast that no plan still to run reads."""
    _shared.remove(b)
    b.destroy()


def settled(make, name: str) -> DataFrame:
    """The written table of the rows of ``make()``; broadcasts and tables that it made for them are removed."""
    shared, written = len(_shared), len(_written)
    out = table(make(), name)
    for b in _shared[shared:]:
        unshare(b)
    for spark, path in _written[written:-1]:
        _delete(spark, path)
    del _written[written:-1]
    return out


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def batches(spark: SparkSession, rows: int = 250) -> None:
    """Bound what one Arrow batch of whole texts holds; the session's own smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def trim() -> None:
    """Give memory that is free but held by the allocators back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def lean(run):
    """``run`` for ``mapInArrow``; a Python worker, which serves many tasks, holds no free memory after it."""

    def trimmed(it):
        yield from run(it)
        trim()

    return trimmed


def text_key(text: Column | str) -> Column:
    """Identifies a text beside its document's id; equal for repeated rows."""
    c = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(c, F.lit("")), F.length(F.coalesce(c, F.lit(""))))
