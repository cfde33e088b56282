"""Return classifiers with ``pyspark.ml``.

Every model is a ``Pipeline`` of scaler -> (expansion) -> estimator over an
assembled feature vector; data never leaves the cluster.  Scores are the
positive-class probability (or the margin for the linear SVM, whose AUC only
needs a ranking).  AUC is the exact one of ``cost.auc_exact``.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import MinMaxScaler, PCA, PolynomialExpansion, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cost as CO

LABEL = "label"
FEATURES = "features"


def assemble(df: DataFrame, cols: list[str], label: str | None = "return") -> DataFrame:
    """P25: feature columns -> one vector column (+ integer label)."""
    va = VectorAssembler(inputCols=cols, outputCol=FEATURES, handleInvalid="keep")
    out = va.transform(df)
    if label and label in df.columns:
        out = out.withColumn(LABEL, F.col(label).cast("double"))
    return out


def _scaled(kind: str) -> list:
    if kind == "minmax":
        return [MinMaxScaler(inputCol=FEATURES, outputCol="scaled")]
    return [StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=True, withStd=True)]


def degree_two(inp: str, out: str) -> list:
    """M3: the constant 1, the terms and their products of degree 2."""
    return [PolynomialExpansion(degree=2, inputCol=inp, outputCol=f"{out}_terms"),
            SQLTransformer(statement="SELECT *, 1.0D AS __one FROM __THIS__"),
            VectorAssembler(inputCols=["__one", f"{out}_terms"], outputCol=out)]


def logistic(C: float = 0.5, penalty: str = "l2", n: int = 1, poly: bool = True, max_iter: int = 100,
             intercept: bool = True) -> Pipeline:
    """M1 + M3 + M4: standardise -> degree-2 terms with a constant -> L1/L2 logistic regression.

    The inverse regularisation strength C maps to ``regParam = 1 / (C * n)``; the penalty acts on the
    terms as they are (no second standardisation).  Spark's estimator gives a constant term the
    coefficient 0, so its part is taken by the intercept, which is not penalised.
    """
    stages = _scaled("standard")
    inp = "scaled"
    if poly:
        stages += degree_two("scaled", "poly")
        inp = "poly"
    stages.append(LogisticRegression(featuresCol=inp, labelCol=LABEL, fitIntercept=intercept, standardization=False, maxIter=max_iter,
                                     regParam=1.0 / (max(C, 1e-9) * max(n, 1)),
                                     elasticNetParam=1.0 if penalty == "l1" else 0.0))
    return Pipeline(stages=stages)


#: Trees that one fit of Spark's forest grows: it holds a number a tree for every row.
TREES_AT_ONCE = 500


def forest(num_trees: int = 50, max_depth: int = 8, feature_fraction: float = 0.5,
           min_leaf_fraction: float = 0.001, n: int = 1, seed: int = 42) -> Pipeline:
    """M5: standardise -> random forest (Spark's trees go to depth 30), grown ``TREES_AT_ONCE`` trees at a time."""
    if max_depth > 30:
        raise ValueError("Spark grows trees to depth 30")
    rf = RandomForestClassifier(featuresCol="scaled", labelCol=LABEL, numTrees=num_trees,
                                maxDepth=max_depth, featureSubsetStrategy=str(feature_fraction),
                                minInstancesPerNode=max(1, int(min_leaf_fraction * n)), seed=seed)
    return Pipeline(stages=_scaled("standard") + [rf if num_trees <= TREES_AT_ONCE else ForestOfParts(rf)])


def boosted(max_iter: int = 20, step: float = 0.1, max_depth: int = 3, subsample: float = 1.0,
            feature_fraction: float = 1.0, min_leaf_fraction: float = 0.001, n: int = 1, seed: int = 42) -> Pipeline:
    """M6: standardise -> gradient-boosted trees."""
    gb = GBTClassifier(featuresCol="scaled", labelCol=LABEL, maxIter=max_iter, stepSize=step, maxDepth=max_depth,
                       subsamplingRate=subsample, featureSubsetStrategy=str(feature_fraction),
                       minInstancesPerNode=max(1, int(min_leaf_fraction * n)), seed=seed)
    return Pipeline(stages=_scaled("standard") + [gb])


def network(hidden: tuple[int, ...] = (100,), activation: str = "relu", solver: str = "adam", alpha: float = 1e-4, momentum: float = 0.9,
            max_iter: int = 1000, step: float = 1e-3, steps: int = 8, seed: int = 42) -> Pipeline:
    """M7: min-max scale -> feed-forward network with early stopping."""
    from .network import NetworkClassifier
    net = NetworkClassifier(hidden, activation, solver, alpha, momentum, step, max_iter, steps, seed=seed, featuresCol="scaled", labelCol=LABEL)
    return Pipeline(stages=_scaled("minmax") + [net])


def svm(n_features: int, C: float = 0.5, kernel: str = "linear", n: int = 1, landmarks: int = 200, gamma: float | None = None,
        coef0: float = 0.0, max_iter: int = 100, seed: int = 42) -> Pipeline:
    """M8: min-max scale -> (map of landmark rows for an RBF or sigmoid kernel) -> linear SVM."""
    stages = _scaled("minmax")
    inp = "scaled"
    if kernel != "linear":
        stages.append(LandmarkMap(inputCol="scaled", outputCol="mapped", kernel=kernel, landmarks=landmarks,
                                  gamma=1.0 / n_features if gamma is None else gamma, coef0=coef0, seed=seed))
        inp = "mapped"
    stages.append(LinearSVC(featuresCol=inp, labelCol=LABEL, regParam=1.0 / (max(C, 1e-9) * max(n, 1)),
                            maxIter=max_iter))
    return Pipeline(stages=stages)


# ------------------------------------------------------------------ kernel maps

from pyspark.ml import Estimator, Transformer  # noqa: E402
from pyspark.ml.param.shared import HasInputCol, HasOutputCol  # noqa: E402


def vector_batch(x: np.ndarray, nulls: np.ndarray | None = None):
    """The rows of a matrix as an Arrow batch of dense vectors, which an Arrow function returns as ``VectorUDT``: no list a
    row in Python, and no array that the JVM turns into a vector afterwards.  A vector holds no null: one is an error."""
    import pyarrow as pa
    if nulls is not None and nulls.any():
        raise ValueError("a vector's value is missing")
    n, width = x.shape
    values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32),
                                      pa.array(x.ravel()))
    return pa.StructArray.from_arrays([pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), values],
                                      names=["type", "size", "indices", "values"])


def row_matrix(x) -> np.ndarray:
    """An Arrow batch of arrays of one length as a matrix."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.empty((0, 0))


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi): one matrix product an Arrow batch."""

    def __init__(self, n_features: int, inputCol: str = "scaled", outputCol: str = "rff", dim: int = 64, gamma: float = 1.0,
                 seed: int = 42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.dim = dim
        rng = np.random.default_rng(seed)
        self.W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_features, dim))
        self.b = rng.uniform(0.0, 2 * math.pi, size=dim)

    def _transform(self, df: DataFrame) -> DataFrame:
        W, b, scale = self.W, self.b, math.sqrt(2.0 / self.dim)

        @F.arrow_udf(VectorUDT())
        def features(x):
            z = scale * np.cos(row_matrix(x) @ W + b) if len(x) else np.empty((0, len(b)))
            return vector_batch(z, np.isnan(z))

        return df.withColumn(self.getOutputCol(), features(vector_to_array(F.col(self.getInputCol()))))


def kernel_matrix(kind: str, X: np.ndarray, Y: np.ndarray, gamma: float, coef0: float = 0.0) -> np.ndarray:
    dots = X @ Y.T
    if kind == "rbf":
        return np.exp(-gamma * np.maximum((X * X).sum(1)[:, None] + (Y * Y).sum(1)[None, :] - 2 * dots, 0.0))
    if kind == "sigmoid":
        return np.tanh(gamma * dots + coef0)
    raise ValueError(f"unknown kernel {kind}")


class LandmarkMap(Estimator, HasInputCol, HasOutputCol):
    """z(x) = k(x, L) U D**-1/2 for landmark rows L with k(L, L) = U D U^T (Nystroem), so that z(x) . z(y) is close to
    k(x, y).  The landmarks are the different rows of the smallest hashes: the same in every run and partitioning, and
    no more than ``landmarks`` rows reach the driver.  A kernel that is not positive, as the sigmoid, gives its
    positive part."""

    def __init__(self, inputCol: str = "scaled", outputCol: str = "mapped", kernel: str = "rbf", landmarks: int = 200,
                 gamma: float = 1.0, coef0: float = 0.0, seed: int = 42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        if kernel not in ("rbf", "sigmoid"):
            raise ValueError(f"unknown kernel {kernel}")
        self.kernel, self.landmarks, self.gamma, self.coef0, self.seed = kernel, landmarks, gamma, coef0, seed

    def _fit(self, df: DataFrame) -> "LandmarkModel":
        x = vector_to_array(F.col(self.getInputCol()))
        # rows that are equal hash alike: more are taken than needed, and told apart here
        rows = df.select(x.alias("x")).orderBy(F.xxhash64("x", F.lit(self.seed)), "x").limit(4 * self.landmarks).collect()
        L = np.array([*dict.fromkeys(tuple(r["x"]) for r in rows)][:self.landmarks], float)
        values, U = np.linalg.eigh(kernel_matrix(self.kernel, L, L, self.gamma, self.coef0))
        keep = values > 1e-10 * max(values.max(), 1e-300)
        return LandmarkModel(self.getInputCol(), self.getOutputCol(), self.kernel, self.gamma, self.coef0, L, U[:, keep] / np.sqrt(values[keep]))


class LandmarkModel(Transformer, HasInputCol, HasOutputCol):
    """The fitted map: two matrix products an Arrow batch."""

    def __init__(self, inputCol: str, outputCol: str, kernel: str, gamma: float, coef0: float, rows: np.ndarray, weights: np.ndarray):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.args, self.rows, self.weights = (kernel, gamma, coef0), rows, weights

    def _transform(self, df: DataFrame) -> DataFrame:
        (kernel, gamma, coef0), L, W = self.args, self.rows, self.weights

        @F.arrow_udf(VectorUDT())
        def features(x):
            z = kernel_matrix(kernel, row_matrix(x), L, gamma, coef0) @ W if len(x) else np.empty((0, W.shape[1]))
            return vector_batch(z, np.isnan(z))

        return df.withColumn(self.getOutputCol(), features(vector_to_array(F.col(self.getInputCol()))))


# ------------------------------------------------------------------ forests of many trees

class ForestOfParts(Estimator):
    """A forest grown some trees at a time, each part with a seed of its own, so what a fit holds a row does not grow with
    the forest.  The trees vote together, as those of one forest."""

    def __init__(self, forest: RandomForestClassifier):
        super().__init__()
        self.forest = forest

    def _fit(self, df: DataFrame) -> "ForestOfPartsModel":
        rf, trees = self.forest, self.forest.getNumTrees()
        parts = [rf.copy({rf.numTrees: min(TREES_AT_ONCE, trees - at), rf.seed: rf.getSeed() + at}).fit(df) for at in range(0, trees, TREES_AT_ONCE)]
        return ForestOfPartsModel(parts)


class ForestOfPartsModel(Transformer):
    """The fitted parts: a class's votes are the sum of theirs."""

    def __init__(self, parts: list):
        super().__init__()
        self.parts = parts

    @property
    def featureImportances(self):
        trees = sum(p.getNumTrees for p in self.parts)
        return Vectors.dense(sum(p.featureImportances.toArray() * p.getNumTrees for p in self.parts) / trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        out, votes = df, [f"__votes_{j}" for j in range(len(self.parts))]
        for part, v in zip(self.parts, votes):
            out = part.copy({part.rawPredictionCol: v, part.probabilityCol: "", part.predictionCol: ""}).transform(out)
        total = F.aggregate(F.array(*[vector_to_array(v) for v in votes]), F.array_repeat(F.lit(0.0), self.parts[0].numClasses),
                            lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
        out = out.withColumn("__votes", total).drop(*votes)
        share = F.transform("__votes", lambda x: F.try_divide(x, F.aggregate("__votes", F.lit(0.0), lambda a, b: a + b)))
        return out.withColumn("rawPrediction", array_to_vector("__votes")).withColumn("probability", array_to_vector(share)).drop("__votes")


# ------------------------------------------------------------------ calibrated margins

def sigmoid_fit(scored: DataFrame, margin: str, label: str, max_iter: int = 100, tol: float = 1e-10) -> tuple[float, float]:
    """(a, b) of P(1 | margin) = 1 / (1 + exp(a * margin + b)), by Newton steps over aggregates.

    Targets are (n1 + 1) / (n1 + 2) and 1 / (n0 + 2) in place of 1 and 0, which keeps a separable sample finite.  A step is
    one aggregate of six sums; it is halved while it does not lower the loss."""
    m, y = F.col(margin).cast("double"), F.col(label) == 1
    count = scored.agg(F.count_if(y).alias("n1"), F.count_if(~y).alias("n0")).first()
    n1, n0 = count["n1"] or 0, count["n0"] or 0
    hi, lo = (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0)
    target = F.when(y, F.lit(hi)).otherwise(F.lit(lo))

    def sums(a: float, b: float):
        z = F.lit(a) * m + F.lit(b)
        e = F.exp(-F.abs(z))
        p = F.when(z >= 0, e / (1 + e)).otherwise(1 / (1 + e))
        loss = F.when(z >= 0, target * z).otherwise((target - 1) * z) + F.log1p(e)
        d, w = target - p, p * (1 - p)
        return scored.agg(F.sum(loss).alias("f"), F.sum(d * m).alias("ga"), F.sum(d).alias("gb"),
                          F.sum(w * m * m).alias("haa"), F.sum(w * m).alias("hab"), F.sum(w).alias("hbb")).first()

    a, b = 0.0, math.log((n0 + 1.0) / (n1 + 1.0))
    now = sums(a, b)
    if now["f"] is None:
        return a, b
    for _ in range(max_iter):
        haa, hab, hbb = now["haa"] + 1e-12, now["hab"], now["hbb"] + 1e-12
        det = haa * hbb - hab * hab
        da, db = -(hbb * now["ga"] - hab * now["gb"]) / det, -(haa * now["gb"] - hab * now["ga"]) / det
        step = 1.0
        while step > 1e-10:
            then = sums(a + step * da, b + step * db)
            if then["f"] <= now["f"] + 1e-4 * step * (now["ga"] * da + now["gb"] * db):
                break
            step /= 2
        else:
            break
        a, b, gain = a + step * da, b + step * db, now["f"] - then["f"]
        now = then
        if gain <= tol * (abs(now["f"]) + 1.0):
            break
    return a, b


class Calibrated:
    """A fitted margin model whose score is a probability."""

    def __init__(self, model: PipelineModel, a: float, b: float):
        self.model, self.a, self.b = model, a, b

    def transform(self, df: DataFrame) -> DataFrame:
        margin = vector_to_array("rawPrediction")[1]
        z = F.lit(self.a) * margin + F.lit(self.b)
        return self.model.transform(df).withColumn("score", F.when(z >= 0, F.exp(-z) / (1 + F.exp(-z))).otherwise(1 / (1 + F.exp(z))))


def calibrated(pipe: Pipeline, train: DataFrame, folds: int = 3, seed: int = 42) -> Calibrated:
    """Class probabilities from margins.  The sigmoid is fitted to cross-fitted margins -- each row's from a
    model that has not seen it -- and set on the model of all rows."""
    from ..session import materialize
    part = F.pmod(F.xxhash64(vector_to_array("features"), "label", F.lit(seed)), F.lit(folds))
    dealt = train.withColumn("__fold", part)
    out = None
    for f in range(folds):
        rest, mine = dealt.filter(F.col("__fold") != f), dealt.filter(F.col("__fold") == f)
        scored = pipe.fit(rest).transform(mine).select(vector_to_array("rawPrediction")[1].alias("margin"), "label")
        out = scored if out is None else out.unionByName(scored)
    a, b = sigmoid_fit(materialize(out, "margins"), "margin", "label")
    return Calibrated(pipe.fit(train), a, b)


# ------------------------------------------------------------------ scores, AUC, penalty

def positive_score(pred: DataFrame) -> DataFrame:
    """Positive-class probability, or the raw margin when the model has no probability column."""
    if "score" in pred.columns:
        return pred
    if "probability" in pred.columns:
        return pred.withColumn("score", vector_to_array("probability")[1])
    return pred.withColumn("score", vector_to_array("rawPrediction")[1])


def auc(pred: DataFrame) -> float:
    """M12 on a scored frame (exact)."""
    return CO.auc_exact(positive_score(pred), "score", LABEL).first()["auc"]


def penalised(train_auc: float, test_auc: float, gap: float = 0.03, two_sided: bool = True) -> float:
    """Test AUC minus 1 when the train/test gap exceeds ``gap`` (one- or two-sided)."""
    d = abs(test_auc - train_auc) if two_sided else (train_auc - test_auc)
    return test_auc - (1.0 if d > gap else 0.0)


@dataclass
class Trial:
    params: dict
    train_auc: float
    test_auc: float
    score: float
    seconds: float


def evaluate(pipe: Pipeline, train: DataFrame, test: DataFrame, two_sided: bool = True) -> tuple[PipelineModel, Trial]:
    """Fit on train, exact AUC on train and test, penalised score."""
    import time
    t0 = time.time()
    model = pipe.fit(train)
    a_tr = auc(model.transform(train))
    a_te = auc(model.transform(test))
    return model, Trial({}, a_tr, a_te, penalised(a_tr, a_te, two_sided=two_sided), time.time() - t0)


# The priors of each model family (fixed values: the reference's ranges; those Spark's estimators
# have no counterpart of -- shrinking, batch rules -- are left out)
SPACES: dict[str, dict[str, Callable[[random.Random], object]]] = {
    "logistic": {"penalty": lambda r: r.choice(["l1", "l2"]), "C": lambda r: r.uniform(0.0, 1.0)},
    "svm": {"C": lambda r: r.uniform(0.0, 1.0), "kernel": lambda r: r.choice(["linear", "rbf", "sigmoid"])},
    "knn": {"k": lambda r: r.randint(3, 15), "weights": lambda r: r.choice(["distance", "uniform"]), "p": lambda r: r.choice([1, 2, 3])},
    "network": {"hidden": lambda r: r.choice([(100,), (1000,), (500,), (750,), (100, 100, 100), (100, 100), (30, 30, 30, 30)]),
                "activation": lambda r: r.choice(["identity", "logistic", "tanh", "relu"]), "solver": lambda r: r.choice(["adam", "sgd"]),
                "alpha": lambda r: r.uniform(0.00001, 0.0005), "momentum": lambda r: r.uniform(0.1, 0.9)},
    "boosted": {"max_iter": lambda r: r.randint(10, 1000), "feature_fraction": lambda r: r.uniform(0.2, 0.5),
                "max_depth": lambda r: r.randint(1, 5), "min_leaf_fraction": lambda r: r.uniform(0.001, 0.05),
                "step": lambda r: r.uniform(0.01, 0.3), "subsample": lambda r: r.uniform(0.3, 1.0)},
    "forest": {"num_trees": lambda r: r.randint(100, 25000), "feature_fraction": lambda r: r.uniform(0.2, 0.7),
               "max_depth": lambda r: r.randint(1, 30), "min_leaf_fraction": lambda r: r.uniform(0.001, 0.05)},
}


def objective(family: str, train: DataFrame, test: DataFrame, n: int, n_features: int, gap: float = 0.03,
              at_most: dict[str, int] | None = None) -> Callable[[dict], dict]:
    """the objective of a family of ``SPACES``: fits its pipeline with a trial's parameters and returns the negative
    penalised test AUC as loss (one-sided penalty for the forest, two-sided for the others).  ``at_most`` bounds
    parameters that only make a trial longer (trees, rounds, iterations)."""
    limits = at_most or {}
    build = {
        "logistic": lambda p: logistic(n=n, max_iter=limits.get("max_iter", 100), **p),
        "svm": lambda p: svm(n_features, n=n, max_iter=limits.get("max_iter", 100), **p),
        "network": lambda p: network(max_iter=limits.get("max_iter", 1000), steps=limits.get("steps", 8), **p),
        "boosted": lambda p: boosted(n=n, **p),
        "forest": lambda p: forest(n=n, **p),
    }

    def fit(params: dict) -> dict:
        params = {k: min(v, limits[k]) if k in limits else v for k, v in params.items()}
        if family == "knn":
            a_tr, a_te = _knn_auc(train, test, **params)
        else:
            model = build[family](params).fit(train)
            a_tr, a_te = auc(model.transform(train)), auc(model.transform(test))
        score = penalised(a_tr, a_te, gap, two_sided=family != "forest")
        return {"loss": -score, "status": "ok", "train_auc": a_tr, "test_auc": a_te}

    return fit


def _knn_auc(train: DataFrame, test: DataFrame, k: int, weights: str, p: int, id_col: str = "order_item_id") -> tuple[float, float]:
    """M9 on standardised features: train and test AUC of the votes' share of returns (a train row is its own
    neighbour, as in the original)."""
    from . import knn
    scaler = Pipeline(stages=_scaled("standard")).fit(train)
    side = lambda d: scaler.transform(d).select(F.xxhash64(id_col).alias("id"), vector_to_array("scaled").alias("v"),
                                                F.col(LABEL).cast("long").alias("label"))
    cells = knn.Cells(side(train), "id", "v", "label", p)
    out = [CO.auc_exact(knn.vote(cells.neighbours(side(d), "id", "v", "label", k, exclude_self=False), "id", "label", weights),
                        "positive", "label").first()["auc"] for d in (train, test)]
    return out[0], out[1]


def random_search(space: dict[str, Callable[[random.Random], object]], objective: Callable[[dict], Trial],
                  max_evals: int = 100, seed: int = 42) -> list[Trial]:
    """Seeded random search over a space of ``SPACES``; each trial is one Spark fit (data stays cached)."""
    rng = random.Random(seed)
    trials = []
    for _ in range(max_evals):
        params = {k: draw(rng) for k, draw in space.items()}
        t = objective(params)
        t.params = params
        trials.append(t)
    return trials


def trials_frame(spark, trials: list[Trial], model: str) -> DataFrame:
    """One row per trial (the metrics log as a table)."""
    rows = [(model, i, str(sorted(t.params.items())), float(t.train_auc), float(t.test_auc), float(t.score),
             float(t.seconds)) for i, t in enumerate(trials)]
    return spark.createDataFrame(rows, "model string, trial long, params string, train_auc double, "
                                       "test_auc double, score double, seconds double")


def feature_importance(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    """Forest importances by feature name, largest first."""
    est = model.stages[-1]
    imp = est.featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: -t[1])


def pca_fit(df: DataFrame, k: int):
    """Standardise -> PCA(k); returns (model, scores frame, explained variance list)."""
    pipe = Pipeline(stages=_scaled("standard") + [PCA(k=k, inputCol="scaled", outputCol="pca")])
    model = pipe.fit(df)
    return model, model.transform(df), list(map(float, model.stages[-1].explainedVariance.toArray()))
