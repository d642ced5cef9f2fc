"""Session settings the plans are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot (stay, minute) even where a later step then shuffles again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge small partitions of what is held, and split large ones
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to the session, for all its later work.

    Cluster-wide ones such as shuffle sizes stay untouched. ``SETTINGS`` can be passed
    to the session builder instead.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """Where intermediate tables go: the caller's folder, or the one the cluster names for checkpoints.

    Where neither is given and Spark itself runs on this machine, a temporary folder
    stands in for the life of the application; no setting is changed.
    """
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="run-")
        _delete_at_end(spark, _OWN[app])
    return _OWN[app]


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Make a scratch folder, and let the file system remove it when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new folder in the shared one, removed when the application ends."""
    path = f"{shared_folder(spark, folder)}/{name}_{uuid.uuid4().hex}"
    _delete_at_end(spark, path)
    return path


#: application -> the folder that holds the package for its executors, removed when Python ends
_SHARED: dict[str, tempfile.TemporaryDirectory] = {}


def share_code(spark: SparkSession) -> None:
    """Let the executors' Python import this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHARED:
        return
    _SHARED[app] = tempfile.TemporaryDirectory(prefix="code-")
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(_SHARED[app].name, "acuity_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(home)))
    spark.sparkContext.addPyFile(path)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and return it as written, which cuts the lineage."""
    path = f"{scratch_path(df.sparkSession, name, folder)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
