import math
import random
from fractions import Fraction

import numpy as np
import pytest

from taxorule.llm import whitening as W


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(dim, dim)) * 0.1
    return (rng.normal(size=(n, dim)) @ mixing).astype(np.float32).tolist()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "z", 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, id string, n int").repartition(5)


def plain(vecs):
    """Exact covariance of the remaining vectors as fractions, their whole numbers and sums."""
    xs = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vecs]
    n, dim = len(xs), len(xs[0])
    sums = [sum(x[d] for x in xs) for d in range(dim)]
    dev = [[Fraction(n * x[d] - sums[d], n) for d in range(dim)] for x in xs]
    cov = [[sum(r[a] * r[b] for r in dev) / n for b in range(dim)] for a in range(dim)]
    return xs, sums, dev, cov


def test_rows_equal_plain_arithmetic(spark):
    vecs = vectors(80, 12, 1)
    rows = [(i, v) for i, v in enumerate(vecs)] + [(3, vecs[3]), (None, vecs[4])]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    df = frame(spark, rows + bad)
    xs, sums, dev, cov = plain([v for _, v in rows])
    n, dim = len(xs), 12
    exact = np.array([[float(c) for c in r] for r in cov])
    values, basis = np.linalg.eigh(exact)
    values, basis = values[::-1], basis[:, ::-1]
    model = W.fit(df)
    got = W.whiten(df, model).collect()
    assert len(got) == n * 8 and {r.n for r in got} == {n}
    deviation = {i: sum((n * x[d] - sums[d]) ** 2 for d in range(dim)) for (i, _), x in zip(rows, xs)}
    by = {(r.vec_id, r.component): r for r in got}
    for (i, _), d in zip(rows, dev):
        for k in range(8):
            r = by[i, k + 1]
            want = np.array([float(c) for c in d]) @ basis[:, k] / math.sqrt(values[k])
            assert r.deviation == deviation[i]
            assert min(abs(r.whitened - want), abs(r.whitened + want)) < 1e-8
            assert abs(r.explained / (values[k] / values.sum()) - 1) < 1e-10
            assert r.identity_error < 1e-9
    white = np.array([[by[i, k].whitened for k in range(1, 9)] for i, _ in rows])
    assert np.abs(white.T @ white / n - np.eye(8)).max() < 1e-9


def test_covariance_is_exact_with_far_entries(spark):
    rng = random.Random(2)
    vecs = [[rng.choice([0.0, 1.5, -2e6, 3e7]), rng.random(), 5.0] for _ in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>").repartition(3)
    xs, sums, dev, cov = plain(vecs)
    got = W._covariance(df.select("embedding"), 40, sums)
    for a in range(3):
        for b in range(3):
            assert abs(Fraction(str(got[a, b])) - cov[a][b]) <= abs(cov[a][b]) * Fraction(1, 10**17)
    rows = W.whiten(df, W.fit(df)).collect()
    assert len(rows) == 40 * 3
    assert {r.deviation for r in rows} == {None}  # all beyond a long
    assert {r.whitened is None for r in rows if r.component == 3} == {True}  # a constant dimension


@pytest.mark.parametrize("values", [
    [9, 5, 3, 2, 1, 0.5], [4, 1 + 3e-9, 1 + 1e-9, 1, 0.25, 0.2499999], [2, 1, 1, 1, 1, 1], [1 + 1e-13, 1, 1e-3, 1e-9, 0, 0]])
def test_refinement_reaches_extended_precision(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(6, dtype=np.longdouble) - 0.5 * (q.T @ q))
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = W.refined_eigenvectors(a)
    eps = np.finfo(np.longdouble).eps
    assert np.abs(found - np.sort(np.array(values, np.longdouble))[::-1]).max() < 100 * eps * values[0]
    assert np.abs(x.T @ x - np.eye(6)).max() < 100 * eps
    assert np.abs(a @ x - x * found).max() < 200 * eps * values[0]


def test_few_rows_and_empty(spark):
    none = frame(spark, [])
    assert W.fit(none) is None and W.whiten(none, None).collect() == []
    assert W.whiten(none, None).schema == W.whiten(frame(spark, [(1, [1.0])]), W.fit(frame(spark, [(1, [1.0])]))).schema
    one = frame(spark, [(1, [0.5, 0.25])] * 3)
    rows = W.whiten(one, W.fit(one)).collect()
    assert len(rows) == 6 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(0, None, 0.0, None)}
    assert W.fit(frame(spark, [(1, []), (2, None)])) is None
    with pytest.raises(Exception, match="lengths"):
        W.fit(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
