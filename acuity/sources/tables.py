"""Reading the input tables and writing the outputs."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acuity import contracts, rules
from acuity.plans.scoring import run
from acuity.sources import versions

STAY = "patientunitstayid"
#: raised when the rules change, so that tables made by others count as out of date
RULES = "3"

# --- fixed values: output table -> time column the rows are sorted by ---------
SORT_WITHIN_STAY = {
    "dobutamine": "infusionoffset",
    "dopamine": "infusionoffset",
    "epinephrine": "infusionoffset",
    "norepinephrine": "infusionoffset",
    "infusion_rejects": "infusionoffset",
    "blood_pressure": "observationoffset",
    "quarantine": "table",
    "ventilation": "starttime",
    "sofa": "hr",
}
DOSE_TABLES = tuple(drug.name for drug in rules.DRUGS)
#: tables that come laid out by stay: doses from the rates that are held so, the score from its grid
LAID_OUT = (*DOSE_TABLES, "sofa")
# --- fixed values: output table -> the inputs it is made from ------------------
_DOSES = ("infusiondrug", "medication", "icustay_detail")
NEEDS = {
    "contract_violations": tuple(contracts.INPUTS),
    "quarantine": tuple(contracts.INPUTS),
    "infusion_rejects": ("infusiondrug",),
    "weight": ("icustay_detail",),
    "dobutamine": _DOSES,
    "dopamine": _DOSES,
    "epinephrine": _DOSES,
    "norepinephrine": _DOSES,
    "blood_pressure": ("pivoted_vital", "vitalaperiodic", "vitalperiodic"),
    "ventilation": ("careplangeneral", "icustay_detail"),
    "sofa": tuple(contracts.INPUTS),
}


def _qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def read_inputs(
    spark: SparkSession,
    database: str | None = None,
    path: str | None = None,
    names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Input tables of a catalog database, or of a folder with a parquet table each.

    ``names`` maps an input to another table or folder name.
    """
    names = names or {}

    def read(table: str) -> DataFrame:
        name = names.get(table, table)
        if path is not None:
            return spark.read.parquet(f"{path.rstrip('/')}/{name}")
        return spark.table(_qualified(name, database))

    return {table: read(table) for table in contracts.INPUTS}


def _order(df: DataFrame, name: str) -> list[str]:
    if STAY not in df.columns:
        return []
    return [STAY, *([SORT_WITHIN_STAY[name]] if name in SORT_WITHIN_STAY else [])]


def replace_table(
    df: DataFrame,
    name: str,
    database: str | None = None,
    path: str | None = None,
    made_from: str = "",
    buckets: int = 0,
    laid_out: bool = False,
) -> DataFrame:
    """Replace an output table and return it as written.

    Rows are laid out by stay and sorted by time inside a file. The rebalance lets
    Spark split a stay that is too big for one file and merge small ones; rows that are
    ``laid_out`` so are written where they lie. Readers see the
    old rows until all new ones are written; a failed write leaves the old table.

    A database's table can have ``buckets`` by stay instead, a sorted file each, so that what
    groups or joins by stay reads it without a shuffle. A stay then lies in one file.
    """
    if buckets and path is not None:
        raise ValueError("only tables of a database have buckets")
    spark = df.sparkSession
    order = _order(df, name)
    if path is not None:
        root = f"{path.rstrip('/')}/{name}"
        return versions.read(spark, root, versions.publish(df, root, made_from, order, STAY if order else None, laid_out=laid_out))

    def write(df: DataFrame, table: str) -> None:
        out = df
        if order and not buckets:
            out = (df if laid_out else df.hint("rebalance", STAY)).sortWithinPartitions(*order)
        writer = out.write.format("parquet")
        if order and buckets:
            # the layout of the buckets, so that a task writes one file
            writer = df.repartition(buckets, STAY).write.format("parquet").bucketBy(buckets, STAY).sortBy(*order)
        writer.saveAsTable(table)

    target = _qualified(name, database)
    versions.publish_view(df, target, write, made_from)
    return spark.table(target)


def hold(rates: DataFrame, buckets: int = 0) -> DataFrame:
    """The dose rates on the executors' disks, laid out by stay, or its bucket, as the tables of the drugs will be.

    One shuffle serves all drugs; rows are sorted by drug first, so that a drug's table reads its own blocks only.
    """
    rows, by, order = rates, STAY, _order(rates, DOSE_TABLES[0])
    if buckets:
        rows, by = rates.withColumn(versions.BUCKET, versions.bucket_of(F.col(STAY), buckets)), versions.BUCKET
        order = [by, *order]
    laid_out = rows.hint("rebalance", by).sortWithinPartitions("drug", *order)
    return laid_out.select(*rates.columns).persist(StorageLevel.DISK_ONLY)


def read_table(spark: SparkSession, name: str, database: str | None = None, path: str | None = None) -> DataFrame:
    """The current version of an output table."""
    if path is not None:
        return versions.read(spark, f"{path.rstrip('/')}/{name}")
    return spark.table(_qualified(name, database))


def _digest(hashes: Column) -> list[Column]:
    """An order-free digest of rows: copies count. The sums hold for half a trillion rows."""
    low, high = (F.sum(F.shiftright(hashes, by).bitwiseAND((1 << 24) - 1)) for by in (0, 24))
    return [F.count("*").alias("n"), F.bit_xor(hashes).alias("x"), low.alias("s"), high.alias("t")]


DIGEST = ("n", "x", "s", "t")


def input_digests(inputs: Mapping[str, DataFrame]) -> dict[str, str]:
    """A digest of the rows of each input, from one scan of each."""
    parts = [df.agg(*_digest(F.xxhash64(*df.columns))).select(F.lit(name).alias("table"), *DIGEST) for name, df in inputs.items()]
    found = reduce(DataFrame.unionByName, parts).collect() if parts else []  # a row an input
    return {r.table: ":".join(str(r[c]) for c in DIGEST) for r in found}


def _made_from(name: str, digests: Mapping[str, str], mode: str, strict: bool) -> str:
    text = "|".join([RULES, name, mode, str(strict), *[f"{t}={digests[t]}" for t in NEEDS[name]]])
    return hashlib.sha256(text.encode()).hexdigest()


def build(
    inputs: Mapping[str, DataFrame],
    database: str | None = None,
    path: str | None = None,
    mode: str = "reference",
    strict: bool = False,
    resume: bool = False,
    input_versions: Mapping[str, str] | None = None,
    buckets: int = 0,
) -> dict[str, DataFrame]:
    """Write every output table in dependency order; later tables read the written ones.

    Written tables end the lineage, so a lost executor costs one table's work at most.
    The dose rates are worked out once and held on the executors' disks while the four
    drug tables are written; what is lost of them is worked out again.

    With ``resume`` each table notes what it was made from, and a table whose inputs, options and rules
    are as they were is not made again: a build that died goes on where it stood. What
    stands for an input is a digest of its rows, or what ``input_versions`` says, such as the
    snapshot of a table.

    With ``buckets`` a database's tables get so many by stay, and the score is worked out from them without
    a shuffle of what has been written. Other numbers of buckets make the tables anew.
    """
    if buckets and path is not None:
        raise ValueError("only tables of a database have buckets")
    held: list[DataFrame] = []
    spark = next(iter(inputs.values())).sparkSession
    conformed = contracts.conform_all(inputs)
    digests: dict[str, str] = {}
    if resume:
        digests = dict(input_versions or {})
        digests |= input_digests({t: df for t, df in conformed.items() if t not in digests})

    def share(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY) if buckets else hold(df))
        return held[-1]

    def noted(name: str) -> str:
        if path is None:
            return versions.made_from_view(spark, _qualified(name, database))
        found = versions.current(spark, f"{path.rstrip('/')}/{name}")
        return found.made_from if found else ""

    def keep(name: str, df: DataFrame) -> DataFrame:
        made_from = _made_from(name, digests, mode, strict) if resume else ""
        made_from += f"-{buckets}" if made_from and buckets else ""
        if resume and noted(name) == made_from:
            return read_table(spark, name, database, path)
        return replace_table(df, name, database, path, made_from, buckets, name in LAID_OUT)

    try:
        return run(conformed, mode, strict, keep, share, buckets)
    finally:
        for df in held:
            df.unpersist()


def stay_digests(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """(stay and ``DIGEST``): a digest of all rows of a stay in all inputs, from one scan of each and one shuffle."""
    hashed = [
        df.select(STAY, F.xxhash64(F.lit(name), *df.columns).alias("h")) for name, df in contracts.conform_all(inputs).items()
    ]
    return reduce(DataFrame.unionByName, hashed).groupBy(STAY).agg(*_digest(F.col("h")))


def changed_stays(new: DataFrame, old: DataFrame) -> DataFrame:
    """The stays that are new, gone or have other rows, each once; NULL counts as one."""
    a, b = new.alias("a"), old.alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DIGEST])
    both = a.join(b, F.col(f"a.{STAY}").eqNullSafe(F.col(f"b.{STAY}")), "full").where(~same)
    # a stay that stands on one side only is known from there
    return both.select(F.when(F.col("a.n").isNotNull(), F.col(f"a.{STAY}")).otherwise(F.col(f"b.{STAY}")).alias(STAY))


def _buckets_of(stays: DataFrame, buckets: int) -> list[int]:
    """A number for each bucket at most."""
    return sorted(r[0] for r in stays.select(versions.bucket_of(F.col(STAY), buckets)).distinct().collect())


def changed_buckets(new: DataFrame, old: DataFrame, buckets: int) -> list[int]:
    """The buckets of changed stays."""
    return _buckets_of(changed_stays(new, old), buckets)


def _among(df: DataFrame, stays: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of the stays, or with ``left_anti`` those of all others."""
    one = stays.withColumnRenamed(STAY, "among")
    return df.join(one, F.col(STAY).eqNullSafe(F.col("among")), how)


def refresh(
    inputs: Mapping[str, DataFrame], path: str, buckets: int = 64, mode: str = "reference", strict: bool = False
) -> dict[str, DataFrame]:
    """Bring the tables at ``path`` up to date, working out only the stays that have changed.

    The tables lie in ``buckets`` folders by stay. A digest of each stay's input rows tells which stays
    are new, gone or changed since the last refresh; the plan runs on the inputs of these, the rows of other stays
    in their buckets are copied and the other buckets' folders are taken over unread. The digests are kept last,
    so a refresh that died is made again. Other options or a new number of buckets rebuild everything. ``contract_violations`` and
    ``quarantine`` look at the rows of all stays together and are always made anew.
    """
    spark = next(iter(inputs.values())).sparkSession
    inputs = contracts.conform_all(inputs)
    root = path.rstrip("/")
    state, kind = f"{root}/stay_digests", "|".join([RULES, mode, str(strict), str(buckets)])
    before = versions.current(spark, state)
    # written under a number of its own: what the digests say is what the plan reads
    digests = versions.publish(stay_digests(inputs), f"{root}/stay_digests_next", kind)
    new = versions.read(spark, f"{root}/stay_digests_next", digests)
    changed, part, stays = list(range(buckets)), inputs, None
    if before and before.made_from == kind:
        found = changed_stays(new, versions.read(spark, state, before))
        # written once, as every input and table is parted by it
        stays = versions.read(spark, f"{root}/stays_changed", versions.publish(found, f"{root}/stays_changed", kind))
        changed = _buckets_of(stays, buckets)
        part = {t: _among(df, stays) for t, df in inputs.items()}
    out: dict[str, DataFrame] = {}
    whole = {"contract_violations": contracts.violations, "quarantine": contracts.quarantine}

    def keep(name: str, df: DataFrame) -> DataFrame:
        table = f"{root}/{name}"
        if name in whole:
            out[name] = versions.read(spark, table, versions.publish(whole[name](inputs), table, kind))
            return out[name]
        version = versions.current(spark, table)
        laid_out = name in DOSE_TABLES
        if stays is not None and version and changed:
            df, laid_out = df.unionByName(_among(versions.read(spark, table, version, changed), stays, "left_anti")), False
        if changed or version is None:
            version = versions.publish(df, table, kind, _order(df, name), STAY, buckets, changed, laid_out)
        out[name] = versions.read(spark, table, version)
        written = versions.read(spark, table, version, changed)
        return written if stays is None else _among(written, stays)

    held: list[DataFrame] = []

    def share(df: DataFrame) -> DataFrame:
        held.append(hold(df, buckets))
        return held[-1]

    try:
        run(part, mode, strict, keep, share)
    finally:
        for df in held:
            df.unpersist()
    versions.publish(new, state, kind)
    return out
