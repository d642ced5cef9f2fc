import math
import random

import numpy as np
import pytest

from acuity.llm import negatives
from checks.compare import compare, connect


def plain(rows, scale=256, every=100, k=5):
    """(anchor, positive, rank, negative, two scores) of distinct (id, label, vector) rows."""
    good = {(i, y, tuple(math.floor(scale * x) for x in v)) for i, y, v in rows if None not in (i, y) and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = [(b, sum(p * q for p, q in zip(a[2], b[2], strict=True))) for b in good if b != a and len(b[2]) == len(a[2])]
        scored.sort(key=lambda r: (-r[1], r[0][0]))
        for p, ps in [r for r in scored if r[0][1] == a[1]][:k]:
            window = [r for r in scored if r[0][1] != a[1] and 80 * ps <= 100 * r[1] <= 100 * ps][:k]
            out += [(a[0], p[0], rank, n[0], ps, ns) for rank, (n, ns) in enumerate(window, 1)]
    return sorted(out)


def frame(spark, rows):
    full = [(i, y, v, 1, 2, 3, 4, 5) for i, y, v in rows]
    return spark.createDataFrame(full, "vec_id long, label int, embedding array<float>, id int, `row` int, chunk int, block int, marks int")


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def test_the_query_equals_its_sql_form(spark, sf_dir):
    same, note = compare(spark, connect(sf_dir), sf_dir, "op13_hard_negatives")
    assert same, note


@pytest.mark.parametrize("dim, size", [(3, 5), (64, 256), (3000, 256), (40, 1 << 20), (7, 1 << 25)])
def test_residues_give_exact_products(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size + 1, (9, dim)), rng.integers(-size, size + 1, (13, dim))
    a[0], b[0], b[1] = size, size, -size  # the ends of the range
    found = [s for _, s in negatives._scores(a, b)]
    assert (np.concatenate(found).astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_few_small_primes():
    assert negatives.PRIMES[:4] == [251, 241, 239, 233] and len(negatives.PRIMES) == 53
    assert negatives.primes_for(70_000) == [251, 241, 239]
    assert negatives.primes_for(0) == [251]
    with pytest.raises(OverflowError):
        negatives.primes_for(1 << 62)


@pytest.mark.parametrize("sizes", [{}, {"block": 2, "chunk": 7, "chunks": 4}])
def test_windows_ties_and_a_hot_label(spark, sizes):
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.choice([-0.5, 0.0, 0.5, 1.0]) for _ in range(5)]) for i in range(160)]
    want = plain(rows, every=20)
    assert want and got(negatives.hard_negatives(frame(spark, rows), every=20, **sizes)) == want


def test_window_bounds(spark):
    """80 and 100 hundredths belong to the window; a negative or zero positive score has its own."""
    rows = [(0, 1, [10.0, 0.0]), (1, 1, [10.0, 0.0]), (2, 2, [8.0, 0.0]), (3, 2, [10.0, 9.0]), (4, 2, [7.996, 0.0]), (5, 2, [10.01, 0.0])]
    assert [r[3] for r in got(negatives.hard_negatives(frame(spark, rows), positives=1))] == [3, 2]
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 1, [0.0, 1.0]), (3, 2, [-0.9, 0.0]), (4, 2, [0.0, 5.0])]
    assert got(negatives.hard_negatives(frame(spark, rows))) == [(0, 2, 1, 4, 0, 0)]


def test_odd_rows(spark):
    """NULLs, non-finite and empty vectors, other lengths, repeated rows, an id with two rows."""
    rows = [
        (0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 0.8]), (2, 2, [1.0, 0.8]), (3, None, [1.0, 1.0]),
        (None, 2, [1.0, 0.9]), (4, 2, None), (5, 2, []), (6, 2, [None, 1.0]), (7, 2, [math.nan, 1.0]), (8, 2, [-math.inf, 1.0]), (9, 2, [1.0]),
        (100, 3, [1.0]), (200, 1, [0.9, 1.0]), (200, 1, [1.0, 0.9]),
    ]
    want = plain([(i, y, v and [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows])
    assert want and got(negatives.hard_negatives(frame(spark, rows))) == want
    assert got(negatives.hard_negatives(frame(spark, rows).where("false"))) == []
