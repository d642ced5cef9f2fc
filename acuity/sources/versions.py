"""Tables kept as whole versions.

A write never touches what readers see: it makes a new version beside the old ones, and one small
step then makes that the current one. In a folder this step is a commit file of the next number
that names the folders of the version; in a database it is a view moved to the version's table. A
write that dies half way leaves the version before it, and a reader that has begun goes on
reading the files it has found, as the version before the current one is kept.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "stay_bucket"
#: versions that stay readable, the current one among them
KEPT = 2


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the maker of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, path: str) -> list[str]:
    files, make = _files(spark, path)
    if not files.exists(make(path)):
        return []
    return [f.getPath().getName() for f in files.listStatus(make(path))]


@dataclass(frozen=True)
class Version:
    """Where a table's rows are: a folder for each bucket, or one for the key "" without buckets."""

    number: int = 0
    made_from: str = ""
    schema: str = ""
    parts: dict[str, str] = field(default_factory=dict)


def commits(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{root}/commits") if n.endswith(".json") and n[0].isdigit())


def _read_commit(spark: SparkSession, root: str, number: int) -> Version | None:
    files, make = _files(spark, root)
    stream = files.open(make(f"{root}/commits/{number:012d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    # a writer may be at it, or have died
    return Version(number, **json.loads(text)) if text.endswith("}\n") else None


def current(spark: SparkSession, root: str) -> Version | None:
    """The last version whose commit is whole; None if there is none."""
    for number in reversed(commits(spark, root)):
        found = _read_commit(spark, root, number)
        if found:
            return found
    return None


def read(spark: SparkSession, root: str, version: Version | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of a version, the current one by default, or of some of its buckets."""
    version = version or current(spark, root)
    if version is None:
        raise FileNotFoundError(f"no table at {root}")
    schema = StructType.fromJson(json.loads(version.schema))
    wanted = None if buckets is None else {str(b) for b in buckets}
    paths = [f"{root}/{p}" for b, p in sorted(version.parts.items()) if wanted is None or b in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Make a version the current one; fails if another writer has taken its number."""
    files, make = _files(spark, root)
    body = {"made_from": version.made_from, "schema": version.schema, "parts": version.parts}
    out = files.create(make(f"{root}/commits/{version.number:012d}.json"), False)
    try:
        out.write(bytearray((json.dumps(body) + "\n").encode()))
    finally:
        out.close()
    return version


def tidy(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Remove the folders that none of the last versions names, and their commits."""
    numbers = commits(spark, root)
    held, kept = set(), 0
    files, make = _files(spark, root)
    for number in reversed(numbers):
        found = _read_commit(spark, root, number)
        if kept < keep:
            if found:
                held |= {p.split("/")[1] for p in found.parts.values()}
                kept += 1
        else:
            files.delete(make(f"{root}/commits/{number:012d}.json"), False)
    for name in _names(spark, f"{root}/data"):
        if name not in held:
            files.delete(make(f"{root}/data/{name}"), True)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def publish(
    df: DataFrame,
    root: str,
    made_from: str = "",
    order: Iterable[str] = (),
    key: str | None = None,
    buckets: int = 0,
    changed: Iterable[int] | None = None,
    laid_out: bool = False,
) -> Version:
    """Write ``df`` as the next version of the table at ``root`` and make it the current one.

    With ``buckets`` the rows go to a folder for each bucket of ``key``. ``changed`` names the buckets
    that ``df`` stands for; the others are taken over from the version before, without being read.
    Rows are sorted by ``order`` inside a file; those that are ``laid_out`` by key or bucket are not
    shuffled. Writers of one table have to take turns: of two
    at a time the later one fails before readers see anything of it.
    """
    spark = df.sparkSession
    before = current(spark, root)
    number = max([0, *commits(spark, root)]) + 1
    folder = f"data/{number:012d}-{uuid.uuid4().hex}"
    schema = df.schema.json()
    order = list(order)
    if buckets:
        df = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
        df = df if laid_out else df.hint("rebalance", BUCKET)
        df.sortWithinPartitions(BUCKET, *order).write.partitionBy(BUCKET).parquet(f"{root}/{folder}")
        made = {n.partition("=")[2]: f"{folder}/{n}" for n in _names(spark, f"{root}/{folder}") if n.startswith(f"{BUCKET}=")}
        gone = {str(b) for b in changed} if changed is not None else None
        kept = before.parts if before and gone is not None else {}
        parts = {b: p for b, p in kept.items() if b not in gone} | made
    else:
        if key and not laid_out:
            df = df.hint("rebalance", key)
        (df.sortWithinPartitions(*order) if order else df).write.parquet(f"{root}/{folder}")
        parts = {"": folder}
    version = commit(spark, root, Version(number, made_from, schema, parts))
    tidy(spark, root)
    return version


def made_from_view(spark: SparkSession, view: str) -> str:
    """What a database's current version was made from; the empty text if nobody said."""
    if not spark.catalog.tableExists(view):
        return ""
    found = spark.sql(f"SHOW TBLPROPERTIES {view}").where("key = 'made_from'").select("value").first()
    return found[0] if found else ""


def _tables(spark: SparkSession, view: str) -> list[int]:
    """Numbers of the versions of a view."""
    database, _, name = view.rpartition(".")
    where = f"IN {database} " if database else ""
    found = [r.tableName for r in spark.sql(f"SHOW TABLES {where}LIKE '{name}__*'").collect()]
    return sorted(int(t.rpartition("__")[2]) for t in found if t.rpartition("__")[0] == name.lower() and t.rpartition("__")[2].isdigit())


def publish_view(df: DataFrame, view: str, write: Callable[[DataFrame, str], None], made_from: str = "") -> None:
    """Write ``df`` as a table of its own, then move the view ``view`` to it.

    ``write`` saves a frame as a table of the given name. A table that has the view's name
    becomes the first version.
    """
    spark = df.sparkSession
    numbers = _tables(spark, view)
    number = max([0, *numbers]) + 1
    write(df, f"{view}__{number}")
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        # only once, when a table of the older layout gives way
        spark.sql(f"ALTER TABLE {view} RENAME TO {view}__0")
        numbers = [0, *numbers]
    note = made_from.replace("'", "")
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('made_from' = '{note}') AS SELECT * FROM {view}__{number}")
    for old in [*numbers, number][:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {view}__{old}")
