"""Hard negatives against brute force."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from shopflow.llm import hard_negatives as hn
from shopflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<double>, anchor_id long, rid string"


def brute(rows, is_anchor, k=5):
    """Rows (vec_id, label, vector) -> counted result rows; Python integers throughout."""
    rows = [(i, n, [math.floor(256 * x) for x in v]) for i, n, v in rows
            if None not in (i, n, v) and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = Counter()
    clip = lambda s: min(max(s, -2 ** 63), 2 ** 63 - 1)
    for r, (a, la, va) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(va, v))), i, n == la) for q, (i, n, v) in enumerate(rows) if q != r)
        for ps, p, _ in [s for s in scored if s[2]][:k]:
            fit = [(i, -s) for s, i, same in scored if not same and 80 * -ps <= 100 * -s <= 100 * -ps]
            for rank, (i, s) in enumerate(fit[:k], 1):
                out[a, p, rank, i, -ps, s] += 1
    return out


def mined(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, n, v, 7, "x") for i, n, v in rows], SCHEMA).repartition(parts)
    return Counter(map(tuple, hn.mine(df, "vec_id % 10 = 0", **how).collect()))


def clustered(n, dim, labels, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, int(rng.integers(labels)), (centres[rng.integers(6)] + spread * rng.normal(size=dim)).tolist())
            for i in range(n)]


@pytest.mark.parametrize("dim,seed,spread", [(3, 1, 0.1), (8, 2, 0.3), (24, 3, 1.0)])
def test_equals_brute_force_over_many_windows(spark, dim, seed, spread):
    rows = clustered(400, dim, 3, seed, spread)
    assert mined(spark, rows, piece=64, window=8) == brute(rows, lambda i: i % 10 == 0)


def test_hot_label_and_copies(spark):
    rows = clustered(150, 4, 2, 5)
    rows += [(1000 + i, 0, rows[0][2]) for i in range(120)] + [(2000 + i, 1, rows[0][2]) for i in range(40)]
    assert mined(spark, rows, piece=32, window=8) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 2.0]), (10, 1, [0.0, 0.0]), (20, 1, []), (30, 2, [1.0, 2.0, 3.0]), (40, None, [1.0, 2.0]),
            (50, 1, None), (60, 1, [1.0, None]), (70, 1, [1.0, nan]), (80, 1, [inf, 0.0]), (None, 1, [1.0, 2.0]),
            (1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (2, 2, [0.9, 1.9]), (3, 2, [1.0]), (4, 2, [-1.0, -2.0]),
            (5, 2, [0.001, -0.001]), (6, -3, [0.95, 1.95]), (7, -3, [0.0, 0.0, 0.0])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(10, 1, None), (20, None, [1.0])]) == Counter()
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])]) == Counter()


def test_large_components(spark):
    rows = [(i, i % 2, [1e9 * (1 + i % 5), 3e8 * (i % 3)]) for i in range(30)]
    rows += [(100 + i, i % 2, [1e300, -1e300 * (i % 2)]) for i in range(4)]
    assert mined(spark, rows, piece=8, window=4) == brute(rows, lambda i: i % 10 == 0)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(4)
    for dim in (2, 5, 40):
        x = np.floor(256 * rng.normal(size=(300, dim)) * rng.choice([0, 0.01, 1, 50], size=(300, 1)))
        theta, norm = hn.angles(x, hn.directions(x))
        bottom, top = hn.interval(theta, norm, theta, theta, norm, norm)
        score = x @ x.T
        assert (bottom <= score).all() and (score <= top).all()


def test_windows_are_passed_over():
    rng = np.random.default_rng(6)
    centres = np.eye(8)
    x = np.concatenate([256 * (c + 0.01 * rng.normal(size=(64, 8))) for c in centres])
    theta, norm = hn.angles(x, hn.directions(x))
    cut = lambda f, m: np.array([f(m[k:k + 64], axis=0) for k in range(0, 512, 64)])
    _, top = hn.interval(theta, norm, cut(np.min, theta), cut(np.max, theta), cut(np.min, norm), cut(np.max, norm))
    assert (top >= 0.8 * norm[:, None] ** 2).mean() < 0.2


def test_query(spark):
    d = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    rows = [(i, None if n != n else (int(n) + 1) % 10 if i % 7 == 0 else int(n), list(map(float, v)))
            for i, n, v in zip(d.vec_id, d.label, d.embedding)]
    got = Counter(map(tuple, QUERIES["op11_hard_negatives"](spark, SMALL).collect()))
    assert got == brute(rows, lambda i: i % 100 == 0)
