"""Cost model: sweep equals brute force, partition independence, baselines, AUC, GA."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions import cost as C
from orderlens.operators import cost as CO


def scored_rows(n=400, seed=3, ties=True):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        p = round(rng.random(), 2) if ties else rng.random()
        y = 1 if rng.random() < p else 0
        rows.append((p, y, round(rng.uniform(10, 100), 2)))
    rows += [(0.0, 1, 20.0), (1.0, 0, 30.0), (C.grid_value(7), 1, 40.0), (C.grid_value(50), 0, 50.0)]
    return rows


@pytest.mark.parametrize("ties", [True, False])
def test_sweep_matches_brute_force(spark, ties):
    rows = scored_rows(ties=ties)
    df = spark.createDataFrame(rows, "p double, y int, price double")
    best = CO.cutoff_sweep(df, "p", "y", "price").first()
    bu, bc = CO.brute_force_sweep(rows)
    assert best["best_utility"] == pytest.approx(bu, abs=1e-9)
    assert best["best_cutoff"] == bc


def test_extreme_fixtures(spark):
    perfect = [(1.0, 1, 10.0), (0.0, 0, 10.0)]
    allpos = [(0.9, 1, 10.0), (0.8, 1, 20.0)]
    allneg = [(0.1, 0, 10.0), (0.2, 0, 20.0)]
    for rows in (perfect, allpos, allneg):
        df = spark.createDataFrame(rows, "p double, y int, price double")
        best = CO.cutoff_sweep(df, "p", "y", "price").first()
        assert best["best_utility"] == pytest.approx(CO.brute_force_sweep(rows)[0])


def test_fitness_independent_of_partitioning(spark):
    rng = np.random.default_rng(0)
    X = rng.uniform(size=(600, 4))
    Xi = np.hstack([np.ones((600, 1)), X])
    beta = np.array([-0.5, 1.0, -2.0, 3.0, -4.0])
    y = (1 / (1 + np.exp(-Xi @ beta)) > 0.7).astype(int)
    price = rng.uniform(10, 100, 600).round(2)
    rows = [([float(v) for v in Xi[i]], int(y[i]), float(price[i])) for i in range(600)]
    df = spark.createDataFrame(rows, "x array<double>, y int, price double")
    pool = np.vstack([np.zeros(5), beta, 2 * beta])
    a = {r["cand_id"]: r["best_utility"] for r in CO.population_fitness(df.repartition(1), "x", "y", "price", pool).collect()}
    b = {r["cand_id"]: r["best_utility"] for r in CO.population_fitness(df.repartition(7), "x", "y", "price", pool).collect()}
    assert a == b
    # candidate 1 (true beta) equals the single-candidate sweep on its own scores
    sc = df.withColumn("p", CO.logit_score(F.col("x"), list(beta)))
    assert CO.cutoff_sweep(sc, "p", "y", "price").first()["best_utility"] == pytest.approx(a[1])
    # scaled beta: same ranking, so the best utility can only be equal or found at another cutoff
    assert a[1] >= a[0]


def test_baselines(spark):
    rows = [(0.3, 1, 10.0), (0.6, 0, 20.0)]
    df = spark.createDataFrame(rows, "p double, y int, price double")
    r = CO.baselines(df, "y", "price").first()
    assert r["predict_none"] == pytest.approx(-(2.5 * (3 + 0.1 * 10.0)))
    assert r["predict_all"] == pytest.approx(-(0.5 * 20.0))


def test_auc_exact_with_ties(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.35, 1), (0.8, 1), (0.1, 1), (0.9, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = CO.auc_exact(df, "s", "y").first()["auc"]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)


def test_bucket_counts_grid_points(spark):
    vals = [0.0, C.grid_value(1), C.grid_value(1) + 1e-12, 0.5, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r["k"] for r in df.select(C.bucket(F.col("p")).alias("k")).collect()]
    want = [sum(1 for i in range(100) if C.grid_value(i) < v) for v in vals]
    assert got == want


def test_ga_elitism_keeps_best(spark):
    from orderlens.operators.genetic import GeneticSearch
    rng = np.random.default_rng(1)
    X = rng.uniform(size=(300, 4))
    y = ((np.hstack([np.ones((300, 1)), X]) @ np.array([-0.5, 1, -2, 3, -4])) > 0.8).astype(int)
    rows = [(i, *map(float, X[i]), int(y[i]), float(round(X[i, 1] * 100, 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, d double, y int, price double")
    ga = GeneticSearch(elitism=0.2, population_size=10, crossover="point", prob_mutation=0.3, seed=42)
    ga.fit(df, ["a", "b", "c", "d"], "y", "price", ["k"])
    ga.run(maxiter=4, subsample=None)
    best = [g.best for g in ga.history]
    assert all(b2 >= b1 - 1e-12 for b1, b2 in zip(best, best[1:]))
    assert ga.optimal_candidate is not None and 0.0 <= ga.optimal_cutoff <= 1.0


def simulated(spark, n=1000, seed=42):
    """The simulation study: four uniform columns, a label that is p > 0.7, the second column as price."""
    rng = np.random.default_rng(seed)
    X = rng.uniform(size=(n, 4))
    beta = np.array([-0.5, 1.0, -2.0, 3.0, -4.0])
    y = (1 / (1 + np.exp(-np.hstack([np.ones((n, 1)), X]) @ beta)) > 0.7).astype(int)
    rows = [(i, *map(float, X[i]), int(y[i]), float(round(X[i, 1], 2))) for i in range(n)]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, d double, y int, price double")


@pytest.mark.parametrize("crossover,bootstrap", [("arithmetic", False), ("point", True), ("heuristic", False)])
def test_ga_simulation_study(spark, crossover, bootstrap):
    from orderlens.operators.genetic import GeneticSearch
    df = simulated(spark)
    train, test = df.filter("k % 4 <> 0"), df.filter("k % 4 = 0")
    ga = GeneticSearch(elitism=0.1, population_size=200, crossover=crossover, prob_mutation=0.5, seed=1)
    ga.fit(train, ["a", "b", "c", "d"], "y", "price", ["k"], scale=3.0)
    ga.run(maxiter=8, subsample=0.6, bootstrap=bootstrap, reset_prob=0.5)
    nobody = CO.baselines(train, "y", "price").first()["predict_none"]
    # the true coefficients cost 0; the search comes close to it, and far beyond predicting nobody
    assert ga.predict_cost() >= 0.25 * nobody
    assert ga.predict_cost(test, "y", "price") >= 0.5 * CO.baselines(test, "y", "price").first()["predict_none"]
    true = GeneticSearch(seed=1)
    true.fit(train, ["a", "b", "c", "d"], "y", "price", ["k"])
    assert len(ga.history) == 8 and all(g.out_of_bag is not None for g in ga.history)


def test_search_over_arrays_and_components(spark):
    """Folded coefficients score raw features as the scaled ones, and as the components, would be scored."""
    from orderlens.operators.genetic import GeneticSearch
    df = simulated(spark, 400).withColumn("x", F.expr("array(a, b * 50, c, d, 7.0D)"))
    rows = df.orderBy("k").collect()
    X = np.array([r["x"] for r in rows])
    mean, std = X.mean(0), X.std(0, ddof=1)
    ga = GeneticSearch(population_size=12, seed=3).fit_array(df, "x", "y", "price", ["k"])
    cells = np.sqrt(((X - X.mean()) ** 2).mean())                      # one deviation over all cells
    want = np.column_stack([np.ones(400), (X - mean) / cells])
    raw = np.column_stack([np.ones(400), X])
    assert np.allclose(raw @ ga._raw(ga.pool).T, want @ ga.pool.T)
    pc = GeneticSearch(population_size=12, seed=3).fit_array(df, "x", "y", "price", ["k"], components=2)
    Z = (X - mean) / np.where(std > 0, std, np.inf)
    values, axes = np.linalg.eigh(np.cov(Z.T))
    P = Z @ axes[:, ::-1][:, :2]
    got = raw @ pc.fold.T
    assert pc.m == 3 and np.allclose(got[:, 0], 1)
    for j in range(2):
        assert np.allclose(np.abs(got[:, 1 + j]), np.abs(P[:, j]) / np.sqrt((P ** 2).mean()), atol=1e-8)
    pc.run(maxiter=3, subsample=0.5)
    assert len(pc.history) == 3 and pc.predict_cost() <= 0
    assert pc.predict_cost() == pytest.approx(pc.predict_cost(df, "y", "price"))


def test_calibrated_margins(spark):
    from orderlens.operators import models as M
    rng = np.random.default_rng(2)
    m = rng.normal(0, 2, 3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-1.7 * m + 0.6))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(m, y)], "m double, y int")
    a, b = M.sigmoid_fit(df, "m", "y")
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = 1 / (1 + np.exp(a * m + b))
    assert abs(((t - p) * m).sum()) < 1e-4 and abs((t - p).sum()) < 1e-4   # the loss is flat there
    assert a == pytest.approx(-1.7, abs=0.2) and b == pytest.approx(0.6, abs=0.2)
    apart = spark.createDataFrame([(-1.0, 0), (1.0, 1)] * 5, "m double, y int")
    assert all(np.isfinite(M.sigmoid_fit(apart, "m", "y")))
    assert all(np.isfinite(M.sigmoid_fit(df.limit(0), "m", "y")))


def test_one_class_and_constant_columns(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1), (None, 1)], "s double, y int")
    r = CO.auc_exact(df, "s", "y").first()
    assert r["auc"] is None and r["n_pos"] == 2 and r["n_neg"] == 0
    assert CO.auc_exact(df.limit(0), "s", "y").first()["auc"] is None
    x = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert CO.standardize_params(x, ["a", "b"], "column") == ([2.0, 5.0], [1.0, 1.0])
    assert CO.standardize_params(x.limit(0), ["a", "b"], "global") == ([0.0, 0.0], [1.0, 1.0])


def test_auc_of_margins(spark):
    rng = np.random.default_rng(0)
    s = rng.normal(0, 30, 4000).round(1)
    y = (rng.random(4000) < 1 / (1 + np.exp(-s / 30))).astype(int)
    df = spark.createDataFrame(list(zip(s.tolist(), y.tolist())), "s double, y int").repartition(5)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert CO.auc_exact(df, "s", "y").first()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_makes_each_score_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.arrow_udf("double")
    def score(x):
        made.add(len(x))
        return x
    df = spark.range(50).select(F.when(F.col("id") < 40, score(F.col("id").cast("double"))).alias("s"), (F.col("id") % 2).alias("y"))
    r = CO.auc_exact(df, "s", "y").first()
    assert made.value == 50 and (r["n_pos"], r["n_neg"]) == (20, 20)


def test_integer_sums_are_exact():
    idx = np.array([0, 1, 0, 2])
    units = np.array([2**52 + 1, 3, 2**53 + 1, -7])
    got = CO._int_bincount(idx, units, 1, 4)
    assert got[:3].tolist() == [2**52 + 2**53 + 2, 3, -7]


def test_fitness_from_cells_equals_that_from_the_array(spark):
    """A generation that makes the matrix where it multiplies it gives what the array gives, copies and out of bag alike."""
    from orderlens.operators.features import Expansion
    rng = np.random.default_rng(8)
    none = np.zeros(0, int)
    pairs = (np.array([2]), np.array([0]), np.array([1]))                       # the product of both cells
    expansion = Expansion(2, 3, (np.array([0, 1]), np.array([0, 1])), (none, none, none), pairs, (none, none, none), np.zeros(0), np.zeros(0, bool),
                          np.zeros(1, bool))
    cells = rng.normal(size=(9000, 2))
    rows = [(c.tolist(), [1.0, *c.tolist(), float(c[0] * c[1])], int(rng.random() < 0.5), float(round(rng.uniform(0, 90), 2)), int(rng.integers(0, 3))) for c in cells]
    df = spark.createDataFrame(rows, "cells array<double>, x array<double>, y int, price double, copies int").repartition(3)
    pool = rng.normal(size=(5, 4))
    key = ["cand_id", "out_of_bag"]
    for copies in (None, "copies"):
        want = CO.population_fitness(df, "x", "y", "price", pool, copies=copies).orderBy(*key).collect()
        got = CO.population_fitness(df, "cells", "y", "price", pool, copies=copies, expansion=expansion).orderBy(*key).collect()
        assert got == want and len(got) == (5 if copies is None else 10)
