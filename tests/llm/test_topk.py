import math
import random

import numpy as np
import pytest

from acuity.llm import topk
from checks.compare import compare, connect


def plain(rows, k=10, scale=1024, every=100):
    """{(query_id, vector): [(vec_id, score)]} of (id, vector) rows, row by row."""
    good = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            others = [(j, sum(a * b for a, b in zip(q, x, strict=True))) for j, x in good if (j, x) != (i, q) and len(x) == len(q)]
            out[i, q] = sorted(others, key=lambda r: (-r[1], r[0]))[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    full = [(i, v, 1, 2.0, 3, 4, 5, 6) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, query long, score double, cell int, `group` int, v int, dim int")


def test_the_query_equals_its_sql_form(spark, sf_dir):
    same, note = compare(spark, connect(sf_dir), sf_dir, "op12_top_k")
    assert same, note


@pytest.mark.parametrize("sizes", [{}, {"groups": 3, "block": 2, "chunk": 9, "chunks": 5, "pivots": 6, "sample": 40}])
def test_clusters_ties_and_copies(spark, sizes):
    """Clusters, a vector that many rows hold, ties, and blocks that split every group."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [round(c + rng.gauss(0, 0.02), 2) for c in centres[i % 5]]) for i in range(150)]
    rows += [(i, [0.5, -0.25, 1.0, 0.0, 2.0, -1.0]) for i in range(150, 240)]
    rng.shuffle(rows)
    want = {i: found for (i, _), found in plain(rows, every=10).items()}
    assert got(topk.top_k(frame(spark, rows), every=10, **sizes)) == want


def test_only_what_is_needed_is_replicated(spark):
    """Far clusters: a row of one can't be among the ten best of another's queries."""
    rng = np.random.default_rng(4)
    centres = 50 * np.eye(4, 8)
    x = np.concatenate([c + rng.normal(0, 0.01, (60, 8)) for c in centres])
    own = topk.lift(np.floor(1024 * x).astype(np.int64), float((np.floor(1024 * x) ** 2).sum(axis=1).max()))
    pivots = topk.spread_out(own, 4)
    assert sorted(topk.apart(own, pivots).argmin(axis=1)[::60]) == [0, 1, 2, 3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = topk.top_k(frame(spark, rows), every=20, pivots=4, chunks=1)
    text = {i: [j for j, _ in found] for i, found in got(df).items()}
    assert all(j // 60 == i // 60 for i, found in text.items() for j in found)
    want = {i: found for (i, _), found in plain([(i, np.float32(v).tolist()) for i, v in rows], every=20).items()}
    assert got(df) == want
    group = topk.bundle(pivots, np.full(4, 3.0), 4)
    assert sorted(group) == [0, 1, 2, 3]


def test_bounds_hold():
    """No row within the k-th distance of a query lies beyond the reach of the query's pivot."""
    rng = np.random.default_rng(8)
    x = rng.integers(-300, 300, (400, 5))
    top = float((x.astype(float) ** 2).sum(axis=1).max())
    lifted, q = topk.lift(x, top), np.concatenate((x[:40].astype(float), np.zeros((40, 1))), axis=1)
    pivots = topk.spread_out(lifted, 9)
    home, d = topk.apart(q, pivots).argmin(axis=1), topk.apart(q, lifted)
    least = np.sort(topk.apart(lifted, pivots), axis=0)[10]  # the own row and ten more
    for i in range(40):
        p = home[i]
        radius = topk.apart(q[home == p], pivots)[:, p].max()
        best = np.argsort(-(x[i] @ x.T))[:11]
        assert (topk.apart(lifted[best], pivots)[:, p] <= 2 * radius + least[p] + 1e-6).all()
        assert (np.sort(d[i])[10] <= radius + least[p] + 1e-6).all()


def test_odd_rows(spark):
    """NULL, empty and non-finite vectors, NULL ids, other lengths, repeated rows, fewer rows than k."""
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]),
        (None, [3.0, 3.0]), (7, [1.0]), (100, [2.0]), (8, [0.0, 0.0]), (200, [0.0, 0.0]), (300, [9.0, 9.0, 9.0]),
    ]
    found = got(topk.top_k(frame(spark, rows)))
    one = 1024 * 1024
    assert found == {0: [(1, 5 * one), (8, 0), (200, 0)], 100: [(7, 2 * one)], 200: [(0, 0), (0, 0), (1, 0), (8, 0)]}
    # two vectors under one id ask apart
    two = topk.top_k(frame(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0])]))
    assert sorted((r.rank, r.vec_id, r.score) for r in two.collect()) == [(1, 1, one), (1, 1, one), (2, 0, 0), (2, 0, 0)]
    empty = topk.top_k(frame(spark, rows).where("false"))
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(frame(spark, [(1, [1.0])])).collect() == []


def test_large_components_stay_exact():
    q, x = np.array([[3_000_000_001, 7]]), np.array([[1_000_000_007, 5], [1_000_000_007, 6]])
    found = topk.solve_cell(np.array([9]), np.array([0]), q, np.array([1, 2]), x, 2)
    assert found["score"].tolist() == [3_000_000_001 * 1_000_000_007 + 42, 3_000_000_001 * 1_000_000_007 + 35]
    with pytest.raises(OverflowError):
        topk.solve_cell(np.array([9]), np.array([0]), q * 10**6, np.array([1, 2]), x * 10**6, 2)
