"""Exact top-k inner products by a Voronoi kNN join (Lu, Shen, Chen and Ooi 2012).

With one component more, sqrt(M^2 - |x|^2) for data and 0 for queries, the highest inner
products of a query are its nearest neighbours. Queries and data are grouped by pivots.
Summaries (each pivot's least distances to the data, the radius of its queries) bound how far
a group's queries have to look; a row is sent only to the groups whose bound it can meet, and
each cell of a query group and a chunk of rows is solved with exact whole-number scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table
from acuity.llm.vectors import CELLS, best, dealt, finite, longest, matrix, pieces, rank_within, to_all, whole_parts
from acuity.session import stored

_EXACT = 1 << 53


@dataclass
class Plan:
    """Pivots in the lifted space, the query group of each, and how far from it a row may lie to matter."""

    top: float  # M squared
    pivots: np.ndarray
    group: np.ndarray
    reach: np.ndarray


def lift(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that makes them equally long."""
    x = x.astype(np.float64)
    rest = np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0)
    return np.concatenate((x, np.sqrt(rest)[:, None]), axis=1)


def apart(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows and pivots."""
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None, :] - 2 * (a @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def spread_out(x: np.ndarray, most: int) -> np.ndarray:
    """Pivots: the first row, then ever the row farthest from those taken; no two alike."""
    taken = [0]
    far = apart(x, x[:1])[:, 0]
    while len(taken) < most and far.max(initial=0.0) > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, apart(x, x[taken[-1:]])[:, 0])
        far[taken] = 0.0
    return x[taken]


def bundle(pivots: np.ndarray, weight: np.ndarray, groups: int) -> np.ndarray:
    """A group for each pivot: near pivots together, queries shared out about evenly."""
    group = np.full(len(pivots), -1)
    left = np.flatnonzero(weight > 0)
    between = apart(pivots, pivots)
    for g in range(groups):
        if not len(left):
            break
        fair = weight[left].sum() / (groups - g)
        # the pivot farthest from those placed so far, and its neighbours
        placed = np.flatnonzero(group >= 0)
        seed = left[between[np.ix_(left, placed)].min(axis=1).argmax()] if len(placed) else left[0]
        order = left[np.argsort(between[seed, left], kind="stable")]
        run = np.cumsum(weight[order]) - weight[order]
        mine = order[(run < fair) | (run == 0)]
        group[mine] = g
        left = np.setdiff1d(left, mine)
    return group


def _least(rows: DataFrame, spark, pivots: np.ndarray, top: float, k: int) -> np.ndarray:
    """[pivot, k]: each pivot's k least distances to all rows."""
    sent = spark.sparkContext.broadcast((pivots, top))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, top = sent.value
        held = np.full((len(pivots), 0), 0.0)
        for pdf in batches:
            if len(pdf):
                held = np.concatenate((held, apart(lift(matrix(pdf["v"]), top), pivots).T), axis=1)
                held = np.partition(held, min(k, held.shape[1]) - 1, axis=1)[:, :k]
        own, at = np.nonzero(np.isfinite(held))
        yield pd.DataFrame({"pivot": own, "d": held[own, at]})

    found = rows.select("v").mapInPandas(work, "pivot int, d double")
    least = found.groupBy("pivot").agg(F.slice(F.sort_array(F.collect_list("d")), 1, k).alias("d"))
    out = np.full((len(pivots), k), np.inf)
    for pivot, d in least.collect():  # a few numbers a pivot
        out[pivot, : len(d)] = d
    return out


def _merged(found: DataFrame, k: int) -> DataFrame:
    return rank_within(found, ["query", "query_id"], k, "score", "vec_id")


def _same_length(rows: DataFrame, k: int, pivots: int, sample: int, groups: int, block: int, chunk: int, chunks: int, every: int, folder: str | None) -> DataFrame:
    spark = rows.sparkSession
    n, top = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()
    top = float(top) * (1 + 1e-9)
    # copies of a query ask once
    asking = rows.where(F.col("id") % every == 0).groupBy("id", "v").agg(F.count("*").alias("copies"))
    asking = asking.select("id", "v", F.xxhash64("id", "v").alias("query"), "copies")
    queries, copies = asking.agg(F.count("*"), F.max("copies")).first()
    if not queries:
        return spark.createDataFrame([], "query long, query_id long, vec_id long, score long")
    some = rows.orderBy(F.xxhash64("id", "v"), "id").limit(sample).toPandas()
    centres = spread_out(lift(matrix(some["v"]), top), pivots)
    least = _least(rows, spark, centres, top, k + copies)
    sent = spark.sparkContext.broadcast((centres, top))

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, top = sent.value
        for pdf in batches:
            if len(pdf):
                x = matrix(pdf["v"]).astype(np.float64)
                d = apart(np.concatenate((x, np.zeros((len(x), 1))), axis=1), centres)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell, d=d[np.arange(len(d)), cell])

    placed = stored(asking.drop("copies").mapInPandas(home, "id long, v array<long>, query long, cell int, d double"), "queries", folder)
    weight, radius = np.zeros(len(centres)), np.zeros(len(centres))
    for cell, count, far in placed.groupBy("cell").agg(F.count("*"), F.max("d")).collect():  # a row a pivot
        weight[cell], radius[cell] = count, far
    group = bundle(centres, weight, pieces(queries, block, groups))
    # d(p, q) <= radius, so its k-th neighbour is within radius + least[k]; such a row is at most a radius farther from p
    reach = (2 * radius + least[:, -1]) * (1 + 1e-9) + 1e-9 * np.sqrt(top)
    plan = spark.sparkContext.broadcast(Plan(top, centres, group, reach))

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = plan.value
        for pdf in batches:
            if len(pdf):
                near = apart(lift(matrix(pdf["v"]), own.top), own.pivots) <= own.reach
                for g in range(own.group.max() + 1):
                    wanted = near[:, own.group == g].any(axis=1)
                    if wanted.any():
                        yield pdf[wanted].assign(group=g)

    parts = pieces(n, chunk, chunks)
    blocks = {g: pieces(int(weight[group == g].sum()), block, 1) for g in range(group.max() + 1)}
    of_cell = F.element_at(F.array(*[F.lit(int(g)) for g in group]), F.col("cell") + 1)
    blocks_of = F.element_at(F.array(*[F.lit(b) for b in blocks.values()]), F.col("group") + 1)
    # a group of very many queries in blocks of its own
    left = placed.withColumn("group", of_cell).withColumn("block", F.pmod(F.xxhash64("query"), blocks_of).cast("int"))
    left = left.withColumn("chunk", to_all(parts)).select("query", "id", "v", "group", "block", "chunk")
    right = rows.select("id", "v").mapInPandas(replicate, "id long, v array<long>, group int")
    right = right.withColumn("chunk", dealt("id", parts)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks_of - 1)))

    def solve(key: tuple, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        x = x.sort_values("id", kind="stable")
        return solve_cell(q["query"].to_numpy(), q["id"].to_numpy(np.int64), matrix(q["v"]), x["id"].to_numpy(np.int64), matrix(x["v"]), k)

    by = ["group", "block", "chunk"]
    kind = "query long, query_id long, vec_id long, score long"
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(solve, kind)


def solve_cell(key: np.ndarray, query_id: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The k highest inner products of each query with rows in order of their ids, its own row apart."""
    bound = longest(q) * longest(x)
    if bound >= 1 << 62:
        raise OverflowError("scores of such vectors don't fit a 64-bit whole number")
    kind = np.float64 if bound < _EXACT else np.int64
    qs, xs = q.astype(kind), x.astype(kind)
    step = max(1, CELLS // len(ids))
    out = []
    for lo in range(0, len(q), step):
        scores = (qs[lo : lo + step] @ xs.T).astype(np.int64)
        allowed = np.ones(scores.shape, bool)
        a, b = np.searchsorted(ids, query_id[lo : lo + step]), np.searchsorted(ids, query_id[lo : lo + step], side="right")
        for i in np.flatnonzero(b > a):
            allowed[i, a[i] : b[i]] = (x[a[i] : b[i]] != q[lo + i]).any(axis=1)
        kept = scores.copy()
        i, j = best(scores, allowed, k)
        out.append(pd.DataFrame({"query": key[lo + i], "query_id": query_id[lo + i], "vec_id": ids[j], "score": kept[i, j]}))
    return pd.concat(out)


def top_k(
    vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, every: int = 100,
    pivots: int = 64, sample: int = 2048, groups: int = 4, block: int = 32_768, chunk: int = 32_768, chunks: int = 12, folder: str | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each row whose id ``every`` divides.

    Components become floor(scale * x). Ties go to the smaller id. A vector that is NULL, empty, or
    holds a NULL, NaN or infinite component takes no part, nor does a row with a NULL id; vectors of
    different lengths don't meet. A query's own row is each one with its id and its vector, so
    repeated rows ask once but are found as often as they stand. Fewer rows than k: all. An empty
    table gives an empty result. Scores that need over 62 bits fail.

    ``pivots`` are picked from ``sample`` rows; ``groups`` is the least number of query groups, ``block``
    the most queries and ``chunk`` the most rows of a cell, ``chunks`` the least number of chunks.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("v"))).select("id", whole_parts(F.col("v"), scale).alias("v"))
    rows = stored(rows.withColumn("dim", F.size("v")), "whole", folder)
    found = None
    for (dim,) in sorted(rows.select("dim").distinct().collect()):
        own = _same_length(rows.where(F.col("dim") == dim).drop("dim"), k, pivots, sample, groups, block, chunk, chunks, every, folder)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _merged(found, k).select("query_id", "rank", "vec_id", "score")


def op12(spark, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


def op12_sql() -> str:
    return """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score,
    (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, x.v) DESC, x.vec_id))::INTEGER AS rank
  FROM rows q JOIN rows x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
WHERE rank <= 10"""
