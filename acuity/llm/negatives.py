"""Hard negatives by windowed selection on exact scores of a residue-number-system GEMM.

Whole-number components are taken modulo a few small primes, the residue matrices are multiplied
in float32 (every partial sum stays below 2^24, so nothing is rounded), and the signed
scores come back by Chinese remaindering. Blocks of anchors meet chunks of rows; a first pass finds
each anchor's positives among the rows of its label, a second the negatives in the windows below them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table
from acuity.llm.vectors import CELLS, best, dealt, finite, longest, matrix, pieces, rank_within, to_all, whole_parts
from acuity.session import stored

#: the primes below 256 and above 2, largest first; sums of up to 1,000 products of residues stay exact
PRIMES = [p for p in range(255, 2, -2) if all(p % d for d in range(3, 16, 2) if d < p)]
_EXACT = 1 << 24


def primes_for(bound: int) -> list[int]:
    """As few primes as tell all whole numbers from -bound to bound apart."""
    chosen, product = [], 1
    for p in PRIMES:
        if chosen and product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    if product > 1 << 62 or product <= 2 * bound:
        raise OverflowError("the residues of such scores don't fit a 64-bit whole number")
    return chosen


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues around zero, as float32."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def multiply(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of rows given by their residues for each prime."""
    total, product = None, 1
    for x, y, p in zip(a, b, primes, strict=True):
        # so many products of residues add up exactly
        width = (_EXACT - 1) // (p // 2) ** 2
        r = np.zeros((len(x), len(y)), np.int64)
        for lo in range(0, x.shape[1], width):
            r += (x[:, lo : lo + width] @ y[:, lo : lo + width].T).astype(np.int64)
        if total is None:
            total = r % p
        else:
            # the least number that leaves the residues so far and this one
            total += product * ((r - total) % p * pow(product, -1, p) % p)
        product *= p
    total[total > product // 2] -= product
    return total


def _scores(q: np.ndarray, x: np.ndarray):
    """(first row of a block of q, its scores with all of x), block by block."""
    primes = primes_for(longest(q) * longest(x))
    right = [residues(x, p) for p in primes]
    step = max(1, CELLS // len(x))
    for lo in range(0, len(q), step):
        yield lo, multiply([residues(q[lo : lo + step], p) for p in primes], right, primes)


def _keys(df: pd.DataFrame) -> np.ndarray:
    """What tells rows apart: the id, and a hash for rows that share one."""
    return df[["id", "row"]].to_numpy(np.int64)


def find_positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best other rows of each anchor of one label, from the rows of a cell."""
    rows = rows.sort_values("id", kind="stable")
    keys, own = _keys(rows), _keys(anchors)
    out = []
    for lo, scores in _scores(matrix(anchors["v"]), matrix(rows["v"])):
        kept = scores.copy()
        other = (own[lo : lo + len(scores), None, :] != keys[None, :, :]).any(axis=2)
        i, j = best(scores, other, k)
        out.append(np.column_stack((own[lo + i], keys[j, 0], kept[i, j])))
    return pd.DataFrame(np.concatenate(out), columns=["id", "row", "positive_id", "positive_score"])


def find_negatives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """For each anchor and positive the k best rows of another label inside its window, from the rows of a cell."""
    rows = rows.sort_values("id", kind="stable")
    ids, labels = rows["id"].to_numpy(np.int64), rows["label"].to_numpy()
    own, own_label = _keys(anchors), anchors["label"].to_numpy()
    marks = [np.array(m, np.int64) for m in anchors["marks"]]
    most = max((len(m) for m in marks), default=0)
    mark = np.array([np.append(m, np.zeros(most - len(m), np.int64)) for m in marks])
    count = np.array([len(m) for m in marks])
    out = [np.zeros((0, 5), np.int64)]
    for lo, scores in _scores(matrix(anchors["v"]), matrix(rows["v"])):
        now = slice(lo, lo + len(scores))
        other = own_label[now, None] != labels[None, :]
        for at in range(most):
            bar = mark[now, at, None]
            # whole-number bounds of low * bar <= 100 * score <= high * bar
            inside = other & (scores >= -((-low * bar) // 100)) & (scores <= high * bar // 100) & (count[now, None] > at)
            some = np.flatnonzero(inside.any(axis=1))
            i, j = best(scores[some], inside[some], k)
            i = some[i]
            out.append(np.column_stack((own[lo + i], np.full(len(i), at + 1), ids[j], scores[i, j])))
    return pd.DataFrame(np.concatenate(out), columns=["id", "row", "at", "negative_id", "negative_score"])


def hard_negatives(
    vectors: DataFrame, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    block: int = 32_768, chunk: int = 32_768, chunks: int = 12, folder: str | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides. Their positives are the best other rows of the same
    label; for each, the best rows of other labels with a score of ``low`` to ``high`` hundredths of the
    positive's are returned. Components become floor(scale * x); ties go to the smaller id.

    A row with a NULL label or id takes no part, nor does a vector that is NULL, empty, or holds a NULL,
    NaN or infinite component; vectors of different lengths don't meet. Rows repeated whole count
    once. An anchor without positives, or a positive without rows in its window, gives no row. An
    empty table gives an empty result. Scores that may need over 53 bits fail.

    ``block`` is the most anchors and ``chunk`` the most rows of a cell, ``chunks`` the least number of chunks.
    """
    ship(vectors.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    rows = rows.select("id", "label", whole_parts(F.col("v"), scale).alias("v"), F.size("v").alias("dim")).distinct()
    rows = stored(rows.withColumn("row", F.xxhash64("label", "v")), "whole", folder)
    anchors = rows.where(F.col("id") % every == 0)
    n, asked = rows.count(), anchors.count()
    blocks, parts = pieces(asked, block, 1), pieces(n, chunk, chunks)

    # positives: within a label; a label of any size is dealt over chunks
    left = anchors.withColumn("block", dealt("id", blocks)).withColumn("chunk", to_all(parts))
    right = rows.withColumn("chunk", dealt("id", parts, 1)).withColumn("block", to_all(blocks))
    same = ["dim", "label", "block", "chunk"]

    def positive(key: tuple, a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(x):
            return pd.DataFrame({"id": [], "row": [], "positive_id": [], "positive_score": []})
        return find_positives(a, x, positives)

    kind = "id long, row long, positive_id long, positive_score long"
    found = left.groupBy(*same).cogroup(right.groupBy(*same)).applyInPandas(positive, kind)
    found = rank_within(found, ["id", "row"], positives, "positive_score", "positive_id")
    found = stored(found.withColumnRenamed("rank", "at"), "positives", folder)

    # negatives: each anchor with its positives' scores meets all chunks
    marks = found.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("at", "positive_score"))).alias("marks"))
    left = left.join(marks.withColumn("marks", F.col("marks.positive_score")), ["id", "row"])
    left = left.select(*[F.col(c).alias(c) for c in left.columns])  # columns of its own beside those of the rows
    by = ["dim", "block", "chunk"]

    def negative(key: tuple, a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(x):
            return pd.DataFrame({"id": [], "row": [], "at": [], "negative_id": [], "negative_score": []})
        return find_negatives(a, x, negatives, low, high)

    kind = "id long, row long, at int, negative_id long, negative_score long"
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(negative, kind)
    first = rank_within(met, ["id", "row", "at"], negatives, "negative_score", "negative_id")
    said = found.select("id", "row", "at", "positive_id", "positive_score")
    columns = [F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return first.join(said, ["id", "row", "at"]).select(*columns)


def op13(spark, folder: str) -> DataFrame:
    """Every seventh id gets the next label, as the contract says."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), label)


def op13_sql() -> str:
    return """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS alike, list_inner_product(a.v, x.v)::BIGINT AS score
  FROM rows a JOIN rows x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5"""
