"""k-NN in blocks against brute force: every metric, ties and repeated rows, any block size."""

import numpy as np
import pytest

from orderlens.operators import knn


def brute(Q, qid, R, rid, labels, k, p, weights):
    out = {}
    for q, i in zip(Q, qid):
        d = [((np.abs(q - r) ** p).sum() ** (1 / p), j, l) for r, j, l in zip(R, rid, labels) if j != i]
        near = sorted((round(x, 9), j, l) for x, j, l in d)[:k]
        votes: dict = {}
        for x, _, l in near:
            w = 1.0 if weights == "uniform" else (float(x == 0) if near[0][0] == 0 else 1 / x)
            votes[l] = votes.get(l, 0) + w
        out[i] = min((-round(w, 9), l) for l, w in votes.items())[1]
    return out


@pytest.mark.parametrize("p,weights,block", [(1, "uniform", 37), (2, "distance", 4096), (3, "uniform", 50), (2, "uniform", 11)])
def test_matches_brute_force(spark, p, weights, block):
    rng = np.random.default_rng(p)
    X = rng.integers(0, 4, (160, 5)).astype(float)
    X[100:150] = X[0]                                     # many copies of one vector
    y = rng.integers(0, 3, 160)
    df = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(160)], "id long, v array<double>, label long")
    got = {r["id"]: r["predicted"] for r in knn.knn_predict(df, df, "id", "v", "label", 6, p, weights, block_rows=block).collect()}
    assert got == brute(X, range(160), X, range(160), y, 6, p, weights)


@pytest.mark.parametrize("p,exclude", [(1, True), (2, False), (3, True)])
def test_far_cells_are_never_joined(spark, p, exclude):
    """Clusters far apart: a query block meets the blocks of its own cluster, and the result is exact."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1000, (20, 3))
    X = np.concatenate([c + rng.normal(0, 1, (60, 3)) for c in centres])
    y = rng.integers(0, 3, len(X))
    df = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(len(X))], "id long, v array<double>, label long").repartition(6)
    cells = knn.Cells(df, "id", "v", "label", p, block_rows=20, pivots=60)
    got = {r["id"]: [(e["near_id"]) for e in r["near"]] for r in cells.neighbours(df, "id", "v", "label", 5, exclude).collect()}
    for i in range(0, len(X), 7):
        d = (np.abs(X - X[i]) ** p).sum(1) ** (1 / p)
        if exclude:
            d[i] = np.inf
        assert got[i] == [int(j) for j in np.lexsort((np.arange(len(X)), d))[:5]]
    blocks = len(cells.stats.value[0])
    met = cells.first_pairs.count() + cells.further_pairs.count()
    assert blocks >= 60 and met < 0.1 * blocks * blocks


def test_odd_vectors_and_empty_tables(spark):
    rows = [(1, [0.0, 0.0], 1), (2, [0.0, 1.0], 0), (3, None, 1), (4, [1.0], 1), (5, [0.0, 0.5], None), (6, [None, 1.0], 1), (7, [], 0)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label long")
    got = {r["id"]: (r["label"], [e["near_id"] for e in r["near"]]) for r in knn.neighbours(df, df, "id", "v", "label", 3).collect()}
    assert got == {1: (1, [2]), 2: (0, [1]), 5: (None, [1, 2])}
    assert knn.neighbours(df, df.limit(0), "id", "v", "label", 3).count() == 0
    assert knn.neighbours(df.limit(0), df, "id", "v", "label", 3).count() == 0


def test_no_cartesian_product(spark):
    df = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(9)], "id long, v array<double>, label long")
    out = knn.knn_predict(df, df, "id", "v", "label", 3)
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("p,exclude", [(1, True), (2, True), (2, False), (3, True)])
def test_screened_rows_are_those_of_all_distances(p, exclude):
    """Wide vectors in clusters, with copies and ties: the pairs that the matrix product leaves hold the k nearest, in
    the order of all distances; a bound leaves out what is beyond it only."""
    rng = np.random.default_rng(9)
    X = rng.normal(0, 50, (30, 16))[rng.integers(0, 30, 400)] + rng.integers(0, 3, (400, 16))
    X[300:340] = X[0]
    ids, labels, bound = np.arange(400), rng.integers(0, 3, 400), rng.uniform(0, 20, 400)
    for bounds in (None, bound):
        got = [f for f in knn._found(ids, X, labels, ids, X, labels, 7, p, exclude, bounds)]
        got = {i: list(zip(g["distance"], g["near_id"])) for f in got for i, g in f.groupby("id")}
        d = knn._distances(X, X, p)
        if exclude:
            np.fill_diagonal(d, np.inf)
        for i in range(400):
            near = [(d[i, j], j) for j in np.lexsort((ids, d[i]))[:7] if bounds is None or d[i, j] <= bounds[i]]
            assert sorted(got.get(i, [])) == near
    pairs = knn._screened(X, X, np.eye(400, dtype=bool), 7, p, np.full(400, np.inf))
    assert (pairs is None) == (p == 1)


def test_lists_of_further_blocks_end_at_the_bound(spark):
    """Rows that the first blocks rule out are not listed, however many blocks a query meets."""
    rng = np.random.default_rng(3)
    X = rng.normal(0, 1, (600, 3))
    df = spark.createDataFrame([(i, X[i].tolist(), i % 2) for i in range(600)], "id long, v array<double>, label long")
    cells = knn.Cells(df, "id", "v", "label", 2, block_rows=30, pivots=4)
    listed = cells._first(df, "id", "v", "label", 5, True).count()
    met = sum(len(r["q_ids"]) // 8 for r in cells.further_pairs.select("q_ids").collect())
    assert met > 600 and listed < 0.6 * 5 * (600 + met)                # 5 a query and block it meets without a bound
