"""Logistic regression with its constant, Fourier features, search spaces."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import models as M


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(1500, 3))
    y = rng.random(1500) < 1 / (1 + np.exp(2.2 - X[:, 0]))          # base rate about 0.15
    rows = [(X[i].tolist(), float(y[i])) for i in range(1500)]
    return spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").cache()


def mean_score(pipe, data):
    return M.positive_score(pipe.fit(data).transform(data)).agg(F.avg("score")).first()[0]


def test_scores_meet_the_base_rate(data):
    rate = data.agg(F.avg("label")).first()[0]
    assert mean_score(M.logistic(C=1.0, n=1500, poly=False), data) == pytest.approx(rate, abs=0.002)
    assert mean_score(M.logistic(C=1.0, n=1500), data) == pytest.approx(rate, abs=0.002)
    assert mean_score(M.logistic(C=1.0, n=1500, poly=False, intercept=False), data) > 2 * rate


def test_degree_two_terms(data):
    pipe = M.Pipeline(stages=M.degree_two("features", "poly"))
    r = pipe.fit(data).transform(data).select(vector_to_array("features").alias("x"), vector_to_array("poly").alias("t")).first()
    x = r["x"]
    want = [1.0, x[0], x[0] * x[0], x[1], x[0] * x[1], x[1] * x[1], x[2], x[0] * x[2], x[1] * x[2], x[2] * x[2]]
    assert r["t"] == pytest.approx(want)


def test_fourier_features_approximate_the_kernel(data):
    t = M.RandomFourierFeatures(3, inputCol="features", dim=2048, gamma=0.3).transform(data.limit(40)).select(
        vector_to_array("features").alias("x"), vector_to_array("rff").alias("z")).collect()
    X, Z = np.array([r["x"] for r in t]), np.array([r["z"] for r in t])
    kernel = np.exp(-0.3 * ((X[:, None] - X[None]) ** 2).sum(-1))
    assert np.abs(Z @ Z.T - kernel).max() < 0.15


def test_maps_give_vectors_without_a_list_a_row(data):
    """The batch leaves Python as vectors: no function turns arrays into vectors afterwards."""
    for t in (M.LandmarkMap("features", "z", "rbf", 20, 0.3).fit(data), M.RandomFourierFeatures(3, inputCol="features", outputCol="z", dim=8)):
        plan = t.transform(data).select("z")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("InMemoryRelation")[0].count("UDF(") == 1  # the input as an array
        assert t.transform(data.limit(0)).select("z").collect() == []


def test_a_missing_value_is_an_error_not_a_zero():
    x = np.array([[1.0, 2.0], [0.0, 4.0]])
    assert [v["values"] for v in M.vector_batch(x).to_pylist()] == x.tolist()
    with pytest.raises(ValueError, match="missing"):
        M.vector_batch(x, np.array([[False, False], [True, False]]))


@pytest.mark.parametrize("kernel,gamma", [("rbf", 0.3), ("sigmoid", 0.2)])
def test_landmark_map_approximates_the_kernel(data, kernel, gamma):
    fit = lambda df: M.LandmarkMap("features", "z", kernel, 300, gamma).fit(df)
    model = fit(data)
    rows = model.transform(data.limit(60)).select(vector_to_array("features").alias("x"), vector_to_array("z").alias("z")).collect()
    X, Z = np.array([r["x"] for r in rows]), np.array([r["z"] for r in rows])
    K = M.kernel_matrix(kernel, X, X, gamma)
    if kernel == "rbf":
        assert np.abs(Z @ Z.T - K).max() < 0.02
    else:  # what is left out is the kernel's negative part
        values, U = np.linalg.eigh(K)
        positive = (U * np.maximum(values, 0)) @ U.T
        assert np.abs(Z @ Z.T - K).mean() < 2 * np.abs(positive - K).mean() + 0.05
    assert np.allclose(fit(data.repartition(7)).rows, model.rows)          # partitions do not matter
    few = data.limit(5)
    assert len(fit(few).rows) == 5 and len(fit(few.unionAll(few)).rows) == 5


def test_svm_kernels_separate_what_a_line_cannot(spark):
    rng = np.random.default_rng(1)
    X = rng.uniform(-1, 1, (800, 2))
    y = ((X ** 2).sum(1) < 0.5).astype(float)
    df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(800)], "x array<double>, label double").select(
        array_to_vector("x").alias("features"), "label").cache()
    score = lambda kernel: M.auc(M.svm(2, C=10.0, kernel=kernel, n=1, gamma=2.0, max_iter=50).fit(df).transform(df))
    assert score("rbf") > 0.95 > 0.7 > score("linear")


def test_forest_depth_is_not_clamped():
    with pytest.raises(ValueError):
        M.forest(max_depth=87)


def test_spaces_draw():
    assert set(M.SPACES) == {"logistic", "svm", "knn", "network", "boosted", "forest"}
    seen = []
    M.random_search(M.SPACES["boosted"], lambda p: seen.append(p) or M.Trial(p, 0, 0, 0, 0), max_evals=5)
    assert len(seen) == 5 and all(10 <= p["max_iter"] <= 1000 and 1 <= p["max_depth"] <= 5 for p in seen)
    assert random is not None
