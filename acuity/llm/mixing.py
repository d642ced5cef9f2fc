"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens goes down a tree of domains, languages and sources. Children share
their parent's budget by weight; what a child can't fill goes to its siblings, and only
what a whole subtree can't fill goes to the subtree's siblings. A leaf then gives the
first tokens of its seeded epochs, each an order of all its documents.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acuity.llm.common import SPACE, fresh, table
from acuity.session import stored

LEVELS = ("domain", "lang", "source")
#: weights by level and child; ``OTHER`` for children that are not named
OTHER = "other"
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 40, "books": 25, "forum": 20, "code": 10, OTHER: 5},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10, OTHER: 5},
    "source": {OTHER: 1},
}
#: the sources of each domain, in this corpus
DOMAINS: dict[str, tuple[str, ...]] = {
    "web": ("src0", "src1", "src2", "src3", "src4"),
    "books": ("src5", "src6", "src7", "src8", "src9"),
    "code": ("src10", "src11", "src12", "src13", "src14"),
    "forum": ("src15", "src16", "src17", "src18", "src19"),
}
SEED = 11
SHARE = 80  # of the available tokens, in hundredths
EPOCHS = 3
BUCKET = 500  # documents in a stretch of an epoch that is summed up for itself


def domain_of(source: Column) -> Column:
    out = F.lit(OTHER)
    for name, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), F.lit(name)).otherwise(out)
    return out


def n_tokens(text: Column) -> Column:
    """Words of a text, parted by white space; 0 for NULL."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACE, " " * len(SPACE))
    return F.size(F.filter(F.split(plain, " "), lambda w: w != "")).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    own = weights.get(level, {})
    out = F.lit(own.get(OTHER, 1))
    for name, w in own.items():
        if name != OTHER:
            out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("double")


def _fill(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Give each node its part of ``budget``, by ``weight``, at most ``capacity``.

    Nodes fill up in the order of capacity to weight; from the first that doesn't, all
    take weight times one level. A weight of 0 takes nothing.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    parent = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = parent.orderBy(F.col("ratio").asc_nulls_last(), F.col(child))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = nodes.withColumn("ratio", ratio)
    found = found.withColumn("level", (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.nullif(F.sum("weight").over(rest), F.lit(0.0)))
    open_level = F.when((F.col("weight") > 0) & (F.col("ratio") > F.col("level")), F.col("level"))
    found = found.withColumn("common", F.max(open_level).over(parent))
    part = F.least(F.col("capacity"), F.col("weight") * F.col("common"))
    given = F.when(F.col("weight") == 0, F.lit(0.0)).when(F.col("common").isNull(), F.col("capacity")).otherwise(part)
    return found.withColumn("budget", given).drop("ratio", "level", "common")


def budgets(leaves: DataFrame, share: int = SHARE, epochs: int = EPOCHS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> DataFrame:
    """The leaves (domain, lang, source, docs, tokens) with a whole ``quota`` of tokens.

    ``share`` hundredths of all tokens are given out; a leaf can give ``epochs`` times its own.
    The table has one row for each leaf, however many documents.
    """
    now = leaves.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    for level in LEVELS:
        # what has no weight has no capacity either
        now = now.withColumn("capacity", F.when(_weight(level, weights) > 0, F.col("capacity")).otherwise(0.0))
    given = None
    for depth, level in enumerate(LEVELS):
        keys, parents = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = now.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights))
        if given is None:
            all_tokens, most = now.agg(F.sum("tokens"), F.sum("capacity")).first()
            root = min(float(math.floor((all_tokens or 0) * share / 100)), most or 0.0)
            nodes = nodes.withColumn("budget", F.lit(root))
        else:
            nodes = nodes.join(given, parents)
        given = _fill(nodes, parents, level).select(*keys, "budget")
    return leaves.join(given, list(LEVELS)).withColumn("quota", F.floor("budget").cast("long")).drop("budget")


def _order(epoch: Column, doc: Column, seed: int) -> Column:
    """A place in the epoch's order, from a hash of seed, epoch and document."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def plan(
    docs: DataFrame, share: int = SHARE, epochs: int = EPOCHS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    seed: int = SEED, folder: str | None = None,
) -> DataFrame:
    """The tokens taken of each document: (doc_id, domain, lang, source, epoch, key, start_token, n_tokens, taken).

    ``docs`` has doc_id, domain, lang, source and n_tokens. A NULL in a level is a child
    named ``none``. A document is taken if the tokens before it in its epoch are fewer than
    the leaf's quota has left for the epoch; ``taken`` is how many of its own still fit.
    Documents without tokens are never taken. Rows that share leaf and doc_id stand
    together. An empty table gives an empty result.

    Running totals go by stretches of an epoch, as many as a leaf's size asks for: first
    over the sums of stretches, then inside each, so that no task holds a leaf.
    """
    rows = docs.select(
        "doc_id", "n_tokens", *[F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in LEVELS]
    ).where(F.col("n_tokens") > 0)
    rows = stored(rows, "tokens", folder)
    leaves = rows.groupBy(*LEVELS).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    leaves = stored(budgets(stored(leaves, "leaves", folder), share, epochs, weights), "quotas", folder)
    each = rows.join(leaves, list(LEVELS)).where(F.col("quota") > 0)
    last = F.floor((F.col("quota") - 1) / F.col("tokens")).cast("int")
    each = each.withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    each = each.withColumn("left", F.col("quota") - F.col("epoch") * F.col("tokens"))
    each = each.withColumn("key", _order(F.col("epoch"), F.col("doc_id"), seed))
    stretches = F.ceil(F.col("docs") / BUCKET)
    at = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 4294967296.0 * stretches).cast("long")
    each = each.withColumn("stretch", at)
    epoch = [*LEVELS, "epoch"]
    sums = each.groupBy(*epoch, "stretch").agg(F.sum("n_tokens").alias("sum"))
    earlier = Window.partitionBy(*epoch).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum")
    inside = Window.partitionBy(*epoch, "stretch").orderBy("key", "doc_id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.join(sums, [*epoch, "stretch"]).withColumn("end", F.col("before") + F.sum("n_tokens").over(inside))
    each = each.withColumn("start_token", F.col("end") - F.col("n_tokens")).where(F.col("start_token") < F.col("left"))
    taken = F.least("n_tokens", F.col("left") - F.col("start_token")).alias("taken")
    return each.select("doc_id", *LEVELS, "epoch", "key", "start_token", "n_tokens", taken)


def mix(
    docs: DataFrame, share: int, epochs: int, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = SEED, folder: str | None = None
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source and others) that the plan takes, whole, once for each epoch.

    The plan is worked out without the texts; the texts are only read again and filtered by
    the last document of each leaf's epoch, so they are never shuffled by leaf. Rows with a
    text that has no words hold no tokens and go. Other columns stay as they are.
    """
    found = docs.select("doc_id", "lang", "source", domain_of(F.col("source")).alias("domain"), n_tokens(F.col("text")).alias("n_tokens"))
    taken = plan(found, share, epochs, weights, seed, folder)
    none = F.lit("none")
    last = taken.groupBy(*LEVELS, "epoch").agg(F.max("key").alias("key"))
    names = dict(zip((*LEVELS, "epoch", "key"), fresh(docs, *[f"cut_{c}" for c in (*LEVELS, "epoch", "key")]), strict=True))
    last = stored(last.select(*[F.col(c).alias(name) for c, name in names.items()]), "cut", folder)
    leaf = (
        (F.coalesce(domain_of(F.col("source")), none) == F.col(names["domain"]))
        & (F.coalesce(F.col("lang").cast("string"), none) == F.col(names["lang"]))
        & (F.coalesce(F.col("source").cast("string"), none) == F.col(names["source"]))
    )
    inside = _order(F.col(names["epoch"]), F.col("doc_id"), seed) <= F.col(names["key"])
    return docs.where(n_tokens(F.col("text")) > 0).join(last, leaf & inside).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", "lang", "source", domain_of(F.col("source")).alias("domain"), n_tokens(F.col("text")).alias("n_tokens"))
    return plan(found).drop("key")


def op6_sql() -> str:
    """The same rows in plain SQL."""
    domain = " ".join(f"WHEN source IN ({', '.join(repr(s) for s in names)}) THEN '{d}'" for d, names in DOMAINS.items())

    def weight(level: str) -> str:
        own = WEIGHTS[level]
        named = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in own.items() if k != OTHER)
        return f"CAST({f'CASE {named} ELSE {own[OTHER]} END' if named else own[OTHER]} AS DOUBLE)"

    steps, keys = [], []
    for depth, level in enumerate(LEVELS):
        parents, keys = list(keys), [*keys, level]
        by = f"PARTITION BY {', '.join(parents)}" if parents else ""
        budget = (
            f"(SELECT least(CAST(floor(sum(tokens) * {SHARE} / 100.0) AS DOUBLE), sum(capacity)) FROM leaves)" if not parents else f"p{depth - 1}.budget"
        )
        join = f"JOIN p{depth - 1} USING ({', '.join(parents)})" if parents else ""
        steps.append(f"""
n{depth} AS (SELECT {", ".join(keys)}, sum(capacity) AS capacity, {weight(level)} AS weight FROM leaves GROUP BY {", ".join(keys)}),
m{depth} AS (SELECT n{depth}.*, {budget} AS given FROM n{depth} {join}),
l{depth} AS (SELECT *, (given - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER ({by} ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM m{depth}),
c{depth} AS (SELECT *, max(CASE WHEN capacity / weight > level THEN level END) OVER ({by}) AS common FROM l{depth}),
p{depth} AS (SELECT {", ".join(keys)}, CASE WHEN common IS NULL THEN capacity ELSE least(capacity, weight * common) END AS budget FROM c{depth})""")
    leaf = ", ".join(LEVELS)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, CASE {domain} ELSE '{OTHER}' END AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
t AS (SELECT * FROM d WHERE n_tokens > 0),
leaves AS (SELECT {leaf}, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) * {EPOCHS} AS capacity FROM t GROUP BY {leaf}),
{",".join(steps)},
q AS (SELECT {leaf}, CAST(floor(budget) AS BIGINT) AS quota, CAST(tokens AS BIGINT) AS tokens FROM p2 JOIN leaves USING ({leaf})),
e AS (SELECT t.*, quota, tokens, unnest(range(0, CAST(floor((quota - 1) / tokens) AS BIGINT) + 1)) AS epoch FROM t JOIN q USING ({leaf}) WHERE quota > 0),
k AS (SELECT *, quota - epoch * tokens AS "left", md5('{SEED}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM e),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {leaf}, epoch ORDER BY key, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS start_token FROM k)
SELECT doc_id, {leaf}, CAST(epoch AS INT) AS epoch, CAST(start_token AS BIGINT) AS start_token, n_tokens,
  CAST(least(n_tokens, "left" - start_token) AS BIGINT) AS taken
FROM s WHERE start_token < "left"
"""
