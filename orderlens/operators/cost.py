"""Asymmetric misclassification cost (A19-A23), the one-pass cutoff sweep (A20),
population fitness (A21), standardisation (P32 / A24) and exact ROC AUC (M12).

Sweep plan: every row falls into bucket k = number of grid cutoffs below its
score; per (group, k) the false-negative and false-positive costs are summed
(partial aggregation, so at most 101 rows per group and map task cross the
shuffle).  The utility at cutoff i is ``-(Σ_{k<=i} fn + Σ_{k>i} fp)`` -- a
running sum over the 101 buckets of each group.  This replaces 100 passes
over the data by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cost as C

TARGET = "return"


# ------------------------------------------------------------------ A19, A22, A23

def utility_at(df: DataFrame, p: str, y: str, price: str, cutoff: float) -> DataFrame:
    """A19 (+A22): total and per-item utility at one cutoff (prediction = p > cutoff)."""
    pred = F.col(p) > F.lit(float(cutoff))
    units = F.sum(C.row_cost_units(pred, F.col(y), F.col(price)))
    return df.agg((-units / C.UNITS).alias("utility"), F.count(F.lit(1)).alias("n")).withColumn(
        "avg_utility", F.try_divide(F.col("utility"), F.col("n")))


def baselines(df: DataFrame, y: str, price: str) -> DataFrame:
    """Utility of predicting nobody / everybody as a returner."""
    fn = F.sum(F.when(F.col(y) == 1, C.fn_units(F.col(price))).otherwise(0))
    fp = F.sum(F.when(F.col(y) == 0, C.fp_units(F.col(price))).otherwise(0))
    return df.agg((-fn / C.UNITS).alias("predict_none"), (-fp / C.UNITS).alias("predict_all"),
                  F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ A20 sweep

def bucket_costs(df: DataFrame, p: str, y: str, price: str, group: list[str] | None = None) -> DataFrame:
    """Per (group, bucket): summed false-negative and false-positive cost units."""
    group = group or []
    yc, pc = F.col(y), F.col(price)
    return (df.select(*[F.col(g) for g in group], C.bucket(F.col(p)).alias("k"),
                      F.when(yc == 1, C.fn_units(pc)).otherwise(0).alias("fn"),
                      F.when(yc == 0, C.fp_units(pc)).otherwise(0).alias("fp"))
            .groupBy(*group, "k").agg(F.sum("fn").alias("fn"), F.sum("fp").alias("fp"), F.count(F.lit(1)).alias("n")))


def sweep_buckets(costs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """From bucket sums to the best cutoff per group: (group..., best_utility, best_cutoff, best_index, n),
    n being the rows.

    Every group gets all 101 buckets (sequence + explode, then a left join), a
    running sum over them, and ``max_by`` picks the first maximum (smallest
    cutoff on ties).
    """
    group = group or []
    spark = costs.sparkSession
    keys = costs.select(*group).distinct() if group else spark.range(1).select()
    full = keys.select(*group, F.explode(F.sequence(F.lit(0), F.lit(C.GRID_POINTS))).alias("k"))
    j = full.join(costs, group + ["k"], "left").fillna(0, subset=["fn", "fp", "n"])
    w = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("k")
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    u = (j.withColumn("cfn", F.sum("fn").over(cum))
          .withColumn("cfp", F.sum("fp").over(cum))
          .withColumn("tfp", F.sum("fp").over(tot))
          .withColumn("rows", F.sum("n").over(tot))
          .filter(F.col("k") < C.GRID_POINTS)
          .withColumn("units", F.col("cfn") + F.col("tfp") - F.col("cfp")))
    best = u.groupBy(*group).agg(
        F.min("units").alias("_units"),
        F.max_by("k", F.struct(-F.col("units"), -F.col("k"))).alias("best_index"), F.max("rows").alias("n"))
    return best.select(*group, (-F.col("_units") / C.UNITS).alias("best_utility"),
                       C.grid_value_col(F.col("best_index")).alias("best_cutoff"), "best_index", "n")


def cutoff_sweep(df: DataFrame, p: str, y: str, price: str, group: list[str] | None = None) -> DataFrame:
    """Best utility over the 100-point cutoff grid, one pass over the rows."""
    return sweep_buckets(bucket_costs(df, p, y, price, group), group)


def brute_force_sweep(rows: list[tuple[float, int, float]]) -> tuple[float, float]:
    """Reference for tests: evaluate all 100 cutoffs row by row on a small local list."""
    best_u, best_c = None, None
    for i in range(C.GRID_POINTS):
        c = C.grid_value(i)
        units = 0
        for p, y, price in rows:
            cents = int(round(price * 100))
            pred = p > c
            if pred and y == 0:
                units += cents * C.FP_PER_CENT
            elif not pred and y == 1:
                units += cents * C.FN_PER_CENT + C.FN_BASE
        u = -units / C.UNITS
        if best_u is None or u > best_u:
            best_u, best_c = u, c
    return best_u, best_c


# ------------------------------------------------------------------ P32 / A24

def standardize_params(df: DataFrame, cols: list[str], scale: str = "global") -> tuple[list[float], list[float]]:
    """Column means and either one global population std over all cells, or per-column std.

    Global variance from per-column (n, mean, M2): M2 = Σ_j [M2_j + n (mean_j - grand)^2].
    """
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.var_pop(x).alias(f"{c}__v"), F.count(x).alias(f"{c}__n")]
    row = df.agg(*aggs).first()
    means = [row[f"{c}__m"] or 0.0 for c in cols]
    vars_ = [row[f"{c}__v"] or 0.0 for c in cols]
    ns = [row[f"{c}__n"] for c in cols]
    if scale == "column":
        return means, [float(np.sqrt(v)) or 1.0 for v in vars_]      # a constant column is centred only
    cells = sum(ns)
    grand = sum(m * n for m, n in zip(means, ns)) / cells if cells else 0.0
    m2 = sum(n * (v + (m - grand) ** 2) for m, v, n in zip(means, vars_, ns))
    return means, [float(np.sqrt(m2 / cells)) or 1.0 if cells else 1.0] * len(cols)


def standardized_array(cols: list[str], means: list[float], stds: list[float], intercept: bool = True) -> Column:
    """``array<double>`` of (x - mean) / std, with a leading 1.0 when ``intercept``."""
    parts = [(F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, means, stds)]
    if intercept:
        parts = [F.lit(1.0)] + parts
    return F.array(*parts)


def logit_score(x: Column, beta: list[float]) -> Column:
    """sigmoid(x · beta)."""
    return C.sigmoid(C.dot(x, beta))


# ------------------------------------------------------------------ A21 population fitness

POOL_CELLS = 4_000_000                # candidates x features that one pass takes with its tasks


def _np_sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1.0 / (1.0 + e), e / (1.0 + e))


def _np_bucket(p: np.ndarray) -> np.ndarray:
    n = C.GRID_POINTS - 1
    step = C.grid_step()
    k0 = np.clip(np.ceil(p * n), 0, n).astype(np.int64)
    g = np.where(k0 == n, 1.0, k0 * step)
    gm1 = np.where(k0 - 1 == n, 1.0, (k0 - 1) * step)
    k = k0 + (g < p).astype(np.int64) - ((k0 > 0) & (gm1 >= p)).astype(np.int64)
    return np.clip(k, 0, C.GRID_POINTS)


def _int_bincount(idx: np.ndarray, units: np.ndarray, P: int, nb: int) -> np.ndarray:
    """Sums of integer units a (candidate, bucket): high and low halves are summed apart, so that each
    float64 sum stays below 2**53."""
    low, high = (units & 0xFFFFF), units >> 20
    add = lambda w: np.bincount(idx, weights=np.repeat(w.astype(np.float64), P), minlength=2 * P * nb).astype(np.int64)
    return add(low) + (add(high) << 20)


def population_bucket_costs(df: DataFrame, x: str, y: str, price: str, pool: np.ndarray,
                            cand_ids: list[int] | None = None, copies: str | None = None, expansion=None) -> DataFrame:
    """Per (cand_id, out_of_bag, bucket) cost sums and rows for every candidate coefficient vector of ``pool``.

    ``copies`` names a column that says how often a row is in the sample; rows with 0 are summed
    apart, as out of bag.  Without it all rows are in the sample.

    With an ``expansion`` (``features.feature_array`` with ``cells``) ``x`` holds what the features are made of, and a
    candidate is an offset and a coefficient a feature.

    Runs as ``mapInPandas`` (``mapInArrow`` with an expansion): each Arrow batch is one matrix product
    (rows x features) @ (features x candidates), a vectorised bucket index and
    a weighted bincount; only <= 101 x P partial rows per batch leave the task.
    The pool is shipped with the task closure; a larger one takes several passes.
    """
    pool = np.asarray(pool, dtype=np.float64)
    ids = np.asarray(cand_ids if cand_ids is not None else list(range(len(pool))), dtype=np.int64)
    at_once = max(1, POOL_CELLS // max(1, pool.shape[1]))
    if len(pool) > at_once:
        parts = [population_bucket_costs(df, x, y, price, pool[i:i + at_once], ids[i:i + at_once].tolist(), copies, expansion)
                 for i in range(0, len(pool), at_once)]
        out = parts[0]
        for part_ in parts[1:]:
            out = out.unionByName(part_)
        return out
    P = pool.shape[0]
    nb = C.GRID_POINTS + 1
    fn_base, fn_pc, fp_pc = C.FN_BASE, C.FN_PER_CENT, C.FP_PER_CENT

    def tally(sums, z, yy, price, times):
        cents = np.round(price * 100).astype(np.int64)
        out = times == 0
        times = np.where(out, 1, times)
        units = {"fn": np.where(yy == 1, cents * fn_pc + fn_base, 0) * times,
                 "fp": np.where(yy == 0, cents * fp_pc, 0) * times, "n": times}
        k = _np_bucket(_np_sigmoid(z))                         # n x P
        idx = ((out[:, None] * P + np.arange(P, dtype=np.int64)[None, :]) * nb + k).ravel()
        for c, u in units.items():
            # whole units in int64: exact past 2**53, whatever the order
            sums[c] += _int_bincount(idx, u, P, nb)

    def found(sums):
        nz = np.flatnonzero(sums["n"])
        return {"cand_id": ids[nz // nb % P], "out_of_bag": nz // nb >= P, "k": (nz % nb).astype(np.int32), **{c: v[nz] for c, v in sums.items()}}

    def part(batches):
        import pandas as pd
        sums = {c: np.zeros(2 * P * nb, dtype=np.int64) for c in ("fn", "fp", "n")}
        for b in batches:
            if len(b):
                tally(sums, np.stack(b[x].to_numpy()) @ pool.T, b[y].to_numpy().astype(np.int64), b[price].to_numpy().astype(np.float64),
                      b[copies].to_numpy().astype(np.int64) if copies else np.ones(len(b), np.int64))
        yield pd.DataFrame(found(sums))

    def part_of_cells(batches):
        import pyarrow as pa
        sums = {c: np.zeros(2 * P * nb, dtype=np.int64) for c in ("fn", "fp", "n")}
        for b in batches:
            at = 0
            column = lambda c: b.column(c).to_numpy(zero_copy_only=False)
            yy, money = column(y).astype(np.int64), column(price).astype(np.float64)
            times = column(copies).astype(np.int64) if copies else np.ones(b.num_rows, np.int64)
            for v in expansion.parts(b.column(x)):
                rows = slice(at, at := at + len(v))
                tally(sums, pool[:, 0] + v @ pool[:, 1:].T, yy[rows], money[rows], times[rows])
        yield pa.RecordBatch.from_pydict(found(sums))

    schema = "cand_id long, out_of_bag boolean, k int, fn long, fp long, n long"
    rows = df.select(x, y, price, *([copies] if copies else []))
    partial = rows.mapInPandas(part, schema) if expansion is None else rows.mapInArrow(part_of_cells, schema)
    return partial.groupBy("cand_id", "out_of_bag", "k").agg(F.sum("fn").alias("fn"), F.sum("fp").alias("fp"), F.sum("n").alias("n"))


def population_fitness(df: DataFrame, x: str, y: str, price: str, pool: np.ndarray,
                       cand_ids: list[int] | None = None, copies: str | None = None, expansion=None) -> DataFrame:
    """(cand_id, out_of_bag, best_utility, best_cutoff, best_index, n) for every candidate, one pass over
    the rows; with ``copies`` one row for the sample and one for the rows out of bag."""
    return sweep_buckets(population_bucket_costs(df, x, y, price, pool, cand_ids, copies, expansion), ["cand_id", "out_of_bag"])


def rank_candidates(fitness: DataFrame) -> DataFrame:
    """Rank by fitness (best first; ties by cand_id), population-sized."""
    w = Window.orderBy(F.desc("best_utility"), "cand_id")
    return fitness.withColumn("rank", F.row_number().over(w))


# ------------------------------------------------------------------ M12 exact AUC

def auc_exact(df: DataFrame, score: str, y: str) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney with average ranks for ties), scalable.

    Scores are first aggregated per distinct value (positives, negatives).  The count of negatives
    below each score is a prefix sum over ranges of the scores themselves, so it adapts to any
    distribution.  The numerator is an exact integer: Σ pos_s * (2 * neg_below_s + neg_s);
    AUC = num / (2 * P * N), null where a class is missing.
    """
    from . import prefix
    s = F.col(score).cast("double")
    per = (df.select(s.alias("s"), F.col(y).alias("y")).groupBy("s")
           # rows without a score count as nothing; a filter would compute every score twice
           .agg(F.sum(F.when(F.col("s").isNotNull() & (F.col("y") == 1), 1).otherwise(0)).cast("long").alias("pos"),
                F.sum(F.when(F.col("s").isNotNull() & (F.col("y") == 0), 1).otherwise(0)).cast("long").alias("neg")))
    ranked = prefix.below(per, [], "s", ["neg"])
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    tot = ranked.agg(F.sum((exact("pos") * (2 * F.col("below_neg") + F.col("neg")).cast("decimal(20,0)")).cast("decimal(38,0)")).alias("num"),
                     F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return tot.select(F.try_divide(F.col("num").cast("double"), 2.0 * F.col("P") * F.col("N")).alias("auc"),
                      F.coalesce("P", F.lit(0)).alias("n_pos"), F.coalesce("N", F.lit(0)).alias("n_neg"))
