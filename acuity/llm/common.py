"""What the operators share: code on the executors, batches of rows, spans."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import acuity

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: the most texts that a Python worker holds at a time
MOST_TEXTS = 1000
#: white space that parts words
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def ship(spark: SparkSession) -> SparkSession:
    """Let the executors' Python import this package, once for each application.

    Also lowers the session's number of records in an Arrow batch to ``MOST_TEXTS`` where it is
    higher, as texts are long.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= MOST_TEXTS:
        spark.conf.set(_BATCH, str(MOST_TEXTS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(acuity.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="code-"), "acuity_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind them until no column of ``df`` has such a name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def forget(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that only tables written by now were made from.

    It does so when the driver's JVM collects its garbage, which else may take half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Give freed memory back, which a Python worker else keeps from task to task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(col: F.Column, n: int) -> F.Column:
    """CRC-32 of a value's text, modulo n; NULL stays NULL."""
    return F.crc32(col.cast("string").cast("binary")) % n
