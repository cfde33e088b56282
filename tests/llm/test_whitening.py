import math
import random
from fractions import Fraction

import numpy as np
import pytest

from orderlens.llm import queries
from orderlens.llm import whitening as W

SF = "/root/testdata/sf0.01"


def exact_scatter(y):
    """n * sum(y y^T) - S S^T in Python integers."""
    y = np.array([[int(v) for v in row] for row in y], object)
    s = y.sum(0)
    return len(y), s, len(y) * y.T.dot(y) - np.outer(s, s)


def determinant(m):
    m = [[Fraction(int(x)) for x in row] for row in m]
    n, out = len(m), Fraction(1)
    for k in range(n):
        i = next((i for i in range(k, n) if m[i][k]), None)
        if i is None:
            return 0
        if i != k:
            m[i], m[k], out = m[k], m[i], -out
        out *= m[k][k]
        for r in range(k + 1, n):
            f = m[r][k] / m[k][k]
            m[r] = [a - f * b for a, b in zip(m[r], m[k])]
    return out


def test_exact_products():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 20, 1 << 33, 1 << 61):
        a, b = rng.integers(-top, top, (500, 3)), rng.integers(-top, top, (500, 4))
        a[0, 0] = top
        want = a.astype(object).T.dot(b.astype(object))
        assert (W.exact_products(a, b) == want).all()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9])
def test_polynomial_is_exact(spark, n):
    rng = np.random.default_rng(n)
    for rank in {n, max(1, n - 2)}:
        y = rng.integers(-2000, 2000, (20, rank)) @ rng.integers(-5, 5, (rank, n))
        m = exact_scatter(y)[2]
        c = W.characteristic_polynomial(spark, m)
        assert c[-1] == 1 and len(c) == n + 1
        for t in (-7, 0, 1, 12345):
            assert sum(x * t**i for i, x in enumerate(c)) == determinant(np.diag([t] * n) - m)


def poly(roots):
    c = [1]
    for r in roots:
        c = [(c[i - 1] if i else 0) - r * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    return c


def test_roots():
    rnd = random.Random(4)
    for roots in [[5], [0, 0, 3], [7, 7, 7], [1 << 90, (1 << 90) + 1, 12, 12, 0], [2, 1 << 200], *([rnd.randint(0, 50) for _ in range(9)] for _ in range(30))]:
        found = W.largest_roots(poly(roots), 4, 120)
        want = sorted((r for r in roots if r), reverse=True)
        got = [r for num, bits, many in found for r in [Fraction(2 * num + 1, 1 << (bits + 1))] * many]
        assert len(got) >= min(4, len(want)) and len(got) <= len(want)
        for g, w in zip(got, want):
            assert abs(g - w) <= Fraction(w, 1 << 119)
        assert W.roots_beyond(poly(roots), 6, 0) == sum(r > 6 for r in roots)


def check(got, vectors, count=8):
    """Rows of the operator against numpy, for vectors (by id) whose eigenvalues are well apart."""
    ids = list(vectors)
    y = np.floor(np.array([vectors[i] for i in ids], float) * 1024)
    n, s, m = exact_scatter(y)
    values, axes = np.linalg.eigh(m.astype(float) / n / n)
    values, axes = values[::-1], axes[:, ::-1]
    real = [k for k in range(min(count, len(values))) if values[k] > 1e-9 * values[0]]
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(rows) == len(ids) * len(real)
    mean = s.astype(float) / n
    for k in real:
        want = (y - mean) @ axes[:, k] / math.sqrt(values[k])
        have = np.array([rows[i, k + 1].whitened for i in ids])
        sign = np.sign(want @ have)
        assert np.abs(have * sign - want).max() < 1e-6
        for i in ids:
            r = rows[i, k + 1]
            assert r.n == n and abs(r.explained - values[k] / values.sum()) < 1e-9 and r.identity_error < 1e-9
    for i, v in zip(ids, y):
        exact = sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))
        assert rows[i, 1].deviation == (exact if exact < 1 << 63 else None) and rows[i, 1].deviation_exact == str(exact)


def test_query(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    bad = [i for i, v in vectors.items() if v is None or any(x is None or not math.isfinite(x) for x in v)]
    got = queries.QUERIES["op11_whitening"](spark, SF).collect()
    check(got, {i: v for i, v in vectors.items() if i not in bad})


def test_close_eigenvalues_keep_their_components():
    """Components whose eigenvalues differ by 1 in 2**60, where doubles cannot tell them apart."""
    q = np.array([[2, -2, 1], [1, 2, 2], [2, 1, -2]], object)  # rows of length 3 at right angles
    base = 1 << 70
    values = [base + (1 << 10), base, 5]
    m = sum(np.outer(row, row) * v for row, v in zip(q, values))
    c = poly([9 * v for v in values])
    found = W.largest_roots(c, 3)
    assert [many for _, _, many in found] == [1, 1, 1]
    for (num, bits, many), row in zip(found, q):
        v = np.array(W.null_vectors(m, num, bits, many, 1)[0])
        assert abs(abs(v @ row.astype(float)) / 3 - 1) < 1e-15


def test_equal_eigenvalues_share_a_basis(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 2), (0, 0, -2)])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    w = np.zeros((6, 3))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
        assert r.identity_error < 1e-12
    assert np.abs(w.T @ w / 6 - np.eye(3)).max() < 1e-12


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = {i: rng.normal(0, 1, 5).tolist() for i in range(40)}
    good[3] = [1e12, -1e12, 3.0, 0.0, -5.5]  # deviations beyond a long
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    schema = "vec_id long, embedding array<double>, component int, whitened string"
    rows = [(i, v, None, "x") for i, v in [*good.items(), *bad]]
    got = W.whiten(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert {r.vec_id for r in got} == set(good) and len(got) == 40 * 5
    n, s, m = exact_scatter(np.floor(np.array(list(good.values())) * 1024))
    assert {r.vec_id: r.deviation_exact for r in got} == {
        i: str(sum((n * math.floor(x * 1024) - int(t)) ** 2 for x, t in zip(v, s))) for i, v in good.items()}
    assert any(r.deviation is None for r in got)
    # repeated rows and null ids count each
    twice = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (None, [0.0, 0.5])]
    got = W.whiten(spark.createDataFrame(twice, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 8 and {r.n for r in got} == {4} and all(r.identity_error < 1e-9 for r in got)
    # nothing varies, nothing is there
    for rows in ([(1, [1.0, 2.0])] * 3, [(1, None)], []):
        out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]


def test_rank_below_the_number_of_components(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-50, 50, (30, 3)) @ rng.integers(-3, 3, (3, 10))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(flat)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check(got, dict(rows))
