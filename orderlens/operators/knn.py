"""k-nearest-neighbour classification (M9 / J11), exact for any Minkowski-p, over pivot cells.

References are dealt to the cells of some pivots, each to its nearest, and cells to blocks; a block knows the
least and the largest distance of its rows to the cell's pivot.  Queries are dealt to the same cells.

1. A query block meets reference blocks near it, as few as hold k rows.  A query's k-th distance there bounds its
   true one.
2. By the triangle inequality (Minkowski distances have it for p of 1 and more) a reference is no nearer to a query
   than the difference of their distances to a pivot.  A query goes on to those blocks only whose rows may be within
   its bound; blocks beyond are never joined with it, and of these blocks only rows within the bound are listed.

In a pair of blocks the Euclidean distances, as one matrix product, tell which rows may be among the k nearest
(``_screened``); only theirs are computed exactly, where they are few.  The partial lists are merged a query.  No pair of rows becomes a row, nothing is ranked by another distance, and the
result is that of comparing all pairs (ties by reference id).  The driver holds the pivots and a line a reference
block: rows / ``BLOCK_ROWS`` lines, checked against ``MAX_BLOCKS``; with more rows blocks grow instead.

Ids tell rows apart.  Vectors that are null, or not as long as most references, have no neighbours and are none; a
reference without a label is none either.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BLOCK_ROWS = 4096
#: Lines of block statistics that are sent to the tasks (32 bytes each), and pivots.
MAX_BLOCKS, MAX_PIVOTS = 1_000_000, 1024
_PACKED = "block int, cell int, ids binary, vectors binary, labels binary, n int, low double, high double"
_CELLS = 500_000                      # distances held at a time
#: What rounding may add to a bound.
_SLACK = 1e-9
#: Dimensions from which a matrix product is worth its while, and parts that the blocks' copies meet a reference block in.
_SCREEN_DIM, _PARTS = 8, 4


def _pivots(reference: DataFrame, dim: int, rows: int, block_rows: int, pivots: int | None) -> np.ndarray:
    """Different vectors of some references, those with the smallest hashes of their ids."""
    n = pivots or int(min(MAX_PIVOTS, max(1, 2 * rows // block_rows)))
    found = reference.orderBy(F.xxhash64("id"), "id").limit(4 * n).collect()
    return np.array([*dict.fromkeys(tuple(r["v"]) for r in found)][:n], float).reshape(-1, dim)


def _celled(df: DataFrame, pivots, p: int) -> DataFrame:
    """Rows (id, v, label) with their nearest pivot and the distance to it."""
    def assign(batches):
        import pandas as pd
        for b in batches:
            if not len(b):
                continue
            v = np.stack(b["v"].to_numpy())
            cell, far = np.zeros(len(v), np.int32), np.zeros(len(v))
            step = max(1, _CELLS // len(pivots.value))
            for i in range(0, len(v), step):
                d = _distances(v[i:i + step], pivots.value, p)
                cell[i:i + step] = d.argmin(1)
                far[i:i + step] = d.min(1)
            yield pd.DataFrame({"cell": cell, "far": far, "id": b["id"], "v": b["v"], "label": b["label"]})

    return df.mapInPandas(assign, "cell int, far double, id long, v array<double>, label long")


def _packed(celled: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of about ``block_rows`` rows of a cell.  A large cell is dealt to blocks by a hash of the id, so no task
    has to hold it."""
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    dealt = celled.join(F.broadcast(sizes), "cell")                      # a row a pivot
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / F.lit(block_rows))).cast("int")

    def pack(batches):
        import pandas as pd
        held: list = []

        def row():
            b = pd.concat(held)
            return pd.DataFrame([{"block": int(b["part"].iloc[0]), "cell": int(b["cell"].iloc[0]), "ids": b["id"].to_numpy(np.int64).tobytes(),
                                  "vectors": np.stack(b["v"].to_numpy()).astype(np.float64).tobytes(),
                                  "labels": b["label"].to_numpy(np.int64, na_value=_NO_LABEL).tobytes(), "n": len(b), "low": b["far"].min(), "high": b["far"].max()}])

        for batch in batches:
            for key, some in batch.groupby(["cell", "part"], sort=False):
                if held and (held[0]["cell"].iloc[0], held[0]["part"].iloc[0]) != key:
                    yield row()
                    held = []
                held.append(some)
        if held:
            yield row()

    out = (dealt.withColumn("part", part).drop("rows").repartition("cell", "part").sortWithinPartitions("cell", "part", "id")
           .mapInPandas(pack, _PACKED))
    return out


_NO_LABEL = -(1 << 62)


def _numbered(packed: DataFrame, name: str) -> DataFrame:
    """Blocks written once, with a number each."""
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _distances(q: np.ndarray, R: np.ndarray, p: int) -> np.ndarray:
    """Summed a dimension at a time: no array larger than the result."""
    total = np.zeros((len(q), len(R)))
    for a, b in zip(q.T, R.T):
        total += _power(a[:, None] - b[None, :], p)
    return _root(total, p)


def _power(diff: np.ndarray, p: int) -> np.ndarray:
    """|diff| to the p, in its place."""
    if p == 2:
        return np.multiply(diff, diff, out=diff)
    np.abs(diff, out=diff)
    return diff if p == 1 else np.multiply(diff * diff, diff, out=diff)


def _root(total: np.ndarray, p: int) -> np.ndarray:
    return total if p == 1 else np.sqrt(total) if p == 2 else total ** (1.0 / p)


def _pair_distances(Q: np.ndarray, R: np.ndarray, row: np.ndarray, col: np.ndarray, p: int) -> np.ndarray:
    """``_distances`` of some pairs only, summed in the same order."""
    total = np.zeros(len(row))
    for a, b in zip(Q.T, R.T):
        total += _power(a[row] - b[col], p)
    return _root(total, p)


def _nearest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k smallest; columns are in id order, so ties go to the smallest id."""
    n, m = d.shape
    if m <= k:
        return np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
    limit = np.partition(d, k - 1, axis=1)[:, k - 1:k]
    row, col = np.nonzero(d <= limit)
    if len(row) > n * k:                                   # ties at the limit
        order = np.lexsort((col, d[row, col], row))
        row, col = row[order], col[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[rank < k], col[rank < k]
    return row, col


def _side(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                     F.col(label_col).cast("long").alias("label")).filter("v is not null and size(v) > 0 and forall(v, x -> x is not null)")


def _screened(Q: np.ndarray, R: np.ndarray, same: np.ndarray | None, k: int, p: int, bound: np.ndarray):
    """(row, column) of the pairs that may be among a row's k nearest and within its bound; None where they are many, or
    not to be told.

    A matrix product gives the Euclidean distances up to rounding, for which the limits leave a margin.  For p = 3 the
    k nearest by them bound the k-th distance, and a Euclidean distance is at most dim ** (1/6) times that of order 3.
    For p = 1 the like bound leaves out next to nothing."""
    (n, dim), m = Q.shape, len(R)
    if p == 1 or dim < _SCREEN_DIM or m <= 4 * k or not (np.isfinite(Q).all() and np.isfinite(R).all()):
        return None
    A, B = Q - R[0], R - R[0]
    a, b = (A * A).sum(1), (B * B).sum(1)
    s = a[:, None] + b[None, :] - 2.0 * (A @ B.T)
    margin = 1e-12 * (a + b.max())
    if same is not None:
        s[same] = np.inf
    if p == 2:
        limit = np.minimum(np.partition(s, k - 1, axis=1)[:, k - 1], bound * bound * (1 + _SLACK)) + 2 * margin
    else:
        first = np.argpartition(s, k - 1, axis=1)[:, :k]
        d = _pair_distances(Q, R, np.repeat(np.arange(n), k), first.ravel(), p).reshape(n, k)
        d[~np.isfinite(np.take_along_axis(s, first, 1))] = np.inf
        limit = (np.minimum(d.max(1), bound) * dim ** (1 / 6)) ** 2 * (1 + _SLACK) + 2 * margin
    row, col = np.nonzero((s <= limit[:, None]) & np.isfinite(s))
    return (row, col) if len(row) * 4 <= n * m else None


def _found(qid, Q, ql, rid, R, rl, k: int, p: int, exclude_self: bool, bounds: np.ndarray | None = None):
    """Frames of each query's k nearest of a block; with ``bounds`` only those within its bound."""
    import pandas as pd
    step = max(1, _CELLS // max(1, len(R)))
    for i in range(0, len(Q), step):
        q = Q[i:i + step]
        same = qid[i:i + step, None] == rid[None, :] if exclude_self else None
        bound = np.full(len(q), np.inf) if bounds is None else bounds[i:i + step]
        few = _screened(q, R, same, k, p, bound)
        if few is None:
            d = _distances(q, R, p)
            if exclude_self:
                d[same] = np.inf
            row, col = _nearest(d, k)
            far = d[row, col]
        else:
            row, col = few
            far = _pair_distances(q, R, row, col, p)
            order = np.lexsort((col, far, row))
            row, col, far = row[order], col[order], far[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, col, far = row[keep], col[keep], far[keep]
        keep = np.isfinite(far) & (far <= bound[row])
        row, col = row[keep], col[keep]
        yield pd.DataFrame({"id": qid[i + row], "label": ql[i + row], "distance": far[keep], "near_id": rid[col], "near_label": rl[col]})


_FOUND = "id long, label long, distance double, near_id long, near_label long"


class Cells:
    """References in pivot cells, ready for any number of searches."""

    def __init__(self, reference: DataFrame, id_col: str, vec_col: str, label_col: str, p: int = 2, block_rows: int = BLOCK_ROWS,
                 pivots: int | None = None):
        if p not in (1, 2, 3):
            raise ValueError("p must be 1, 2 or 3")
        self.p, self.spark = p, reference.sparkSession
        rows = materialize(_side(reference, id_col, vec_col, label_col).filter("label is not null"), "knn-references")
        sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").collect()
        self.dim = sizes[0]["dim"] if sizes else 0
        rows = rows.filter(F.size("v") == self.dim)
        n = sizes[0]["count"] if sizes else 0
        self.block_rows = max(block_rows, -(-n // MAX_BLOCKS))
        self.pivots = self.spark.sparkContext.broadcast(_pivots(rows, self.dim, n, self.block_rows, pivots) if n else np.empty((0, 0)))
        self.blocks = _numbered(_packed(_celled(rows, self.pivots, p), self.block_rows), "knn-blocks") if n else None
        lines = self.blocks.select("block", "cell", "n", "low", "high").orderBy("cell", "block").collect() if n else []
        self.stats = self.spark.sparkContext.broadcast(tuple(np.array([r[c] for r in lines]) for c in ("block", "cell", "n", "low", "high")))

    def neighbours(self, queries: DataFrame, id_col: str, vec_col: str, label_col: str, k: int = 5, exclude_self: bool = True) -> DataFrame:
        """(id, label, near): each query's k nearest references as an array of (distance, id, label)."""
        if self.blocks is None:
            return self.spark.createDataFrame([], "id long, label long, near array<struct<distance:double,near_id:long,near_label:long>>")
        found = self._first(queries, id_col, vec_col, label_col, k, exclude_self)
        near = F.slice(F.sort_array(F.collect_list(F.struct("distance", "near_id", "near_label"))), 1, k)
        return found.groupBy("id", F.nullif("label", F.lit(_NO_LABEL)).alias("label")).agg(near.alias("near"))

    def _first(self, queries, id_col, vec_col, label_col, k, exclude_self) -> DataFrame:
        p, pivots, stats = self.p, self.pivots, self.stats
        mine = _side(queries, id_col, vec_col, label_col).filter(F.size("v") == self.dim)
        q = _numbered(_packed(_celled(mine, pivots, p), self.block_rows), "knn-queries")
        need = k + 1 if exclude_self else k
        q = q.toDF("q_block", "q_cell", "q_ids", "q_vectors", "q_labels", "q_n", "q_low", "q_high")

        # 1: the reference blocks of the nearest cells, as few as hold enough rows
        def starts(batches):
            import pandas as pd
            block, cell, n, _, _ = stats.value
            between = _distances(pivots.value, pivots.value, p)
            for b in batches:
                rows = []
                for number, own in zip(b["q_block"], b["q_cell"]):
                    order = np.argsort(between[own][cell], kind="stable")
                    enough = int(np.searchsorted(np.cumsum(n[order]), need)) + 1
                    rows += [(number, int(x)) for x in block[order[:enough]]]
                yield pd.DataFrame(rows, columns=["q_block", "block"])

        home = q.select("q_block", "q_cell").mapInPandas(starts, "q_block long, block long")
        self.first_pairs = home

        def search(batches):
            import pandas as pd
            for b in batches:
                for x in b.itertuples(index=False):
                    qid, rid = np.frombuffer(x.q_ids, np.int64), np.frombuffer(x.ids, np.int64)
                    out = _found(qid, np.frombuffer(x.q_vectors).reshape(len(qid), -1), np.frombuffer(x.q_labels, np.int64),
                                 rid, np.frombuffer(x.vectors).reshape(len(rid), -1), np.frombuffer(x.labels, np.int64), k, p, exclude_self,
                                 np.frombuffer(x.q_bounds) if "q_bounds" in b.columns else None)
                    yield from (f.assign(block=x.q_block) for f in out)

        r = self.blocks.select("block", "ids", "vectors", "labels")
        start = (home.join(q.select("q_block", "q_ids", "q_vectors", "q_labels"), "q_block").hint("merge").join(r, "block")
                 .repartition("q_block", "block").mapInPandas(search, _FOUND + ", block long"))
        start = materialize(start, "knn-first")

        # 2: each query's bound, and the blocks that may hold something within it
        bounds = (start.groupBy("block", "id", "label").agg(F.sort_array(F.collect_list("distance")).alias("d"))
                  .select("block", "id", "label", F.get("d", F.lit(k - 1)).alias("bound"))
                  .groupBy(F.col("block").alias("q_block")).agg(F.collect_list(F.struct("id", "label", "bound")).alias("bounds")))

        def onward(batches):
            import pandas as pd
            block, cell, _, low, high = stats.value
            between = _distances(pivots.value, pivots.value, p)
            for b in batches:
                for x in b.itertuples(index=False):
                    ids, v = np.frombuffer(x.q_ids, np.int64), np.frombuffer(x.q_vectors).reshape(x.q_n, -1)
                    labels = np.frombuffer(x.q_labels, np.int64)
                    bound = np.full(len(ids), np.inf)
                    if x.bounds is not None:
                        by = {(e["id"], e["label"]): e["bound"] for e in x.bounds if e["bound"] is not None}
                        bound = np.array([by.get(i, np.inf) for i in zip(ids.tolist(), labels.tolist())])
                    order = np.argsort(between[x.q_cell][cell], kind="stable")
                    seen = block[order[:x.done]]
                    step = max(1, _CELLS // max(len(pivots.value), len(block)))
                    wanted: dict[int, list] = {}
                    for i in range(0, len(ids), step):
                        d = _distances(v[i:i + step], pivots.value, p)[:, cell]            # to each block's pivot
                        least = np.maximum(np.maximum(d - high, low - d), 0.0)
                        row, col = np.nonzero(least <= bound[i:i + step, None] * (1 + _SLACK) + _SLACK * (1 + d))
                        by_block = np.argsort(col, kind="stable")
                        cuts = np.flatnonzero(np.diff(col[by_block])) + 1
                        for at in np.split(by_block, cuts):
                            if len(at):
                                wanted.setdefault(int(col[at[0]]), []).append(i + row[at])
                    skip = set(seen.tolist())
                    for j, rows in wanted.items():
                        if int(block[j]) in skip:
                            continue
                        at = np.concatenate(rows)
                        yield pd.DataFrame([{"q_block": x.q_block, "block": int(block[j]), "q_ids": ids[at].tobytes(),
                                             "q_vectors": v[at].tobytes(), "q_labels": labels[at].tobytes(), "q_bounds": bound[at].tobytes()}])

        done = home.groupBy("q_block").agg(F.count(F.lit(1)).cast("int").alias("done"))
        rest = (q.join(done, "q_block").join(bounds, "q_block", "left")
                .mapInPandas(onward, "q_block long, block long, q_ids binary, q_vectors binary, q_labels binary, q_bounds binary"))
        self.further_pairs = rest = materialize(rest, "knn-onward")
        # a pair is searched where it is joined: a reference block is moved once a part, not once a pair
        part = F.pmod(F.xxhash64("q_block"), F.lit(_PARTS)).cast("int")
        parts = r.withColumn("part", F.explode(F.array(*[F.lit(j) for j in range(_PARTS)])))
        later = rest.withColumn("part", part).hint("merge").join(parts, ["block", "part"]).mapInPandas(search, _FOUND + ", block long")
        return start.unionByName(later).drop("block")


def neighbours(queries: DataFrame, reference: DataFrame, id_col: str, vec_col: str, label_col: str, k: int = 5,
               p: int = 2, exclude_self: bool = True, block_rows: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """(id, label, near): each query's k nearest references as an array of (distance, id, label)."""
    return Cells(reference, id_col, vec_col, label_col, p, block_rows, pivots).neighbours(queries, id_col, vec_col, label_col, k, exclude_self)


def knn_predict(queries: DataFrame, reference: DataFrame, id_col: str, vec_col: str, label_col: str,
                k: int = 5, p: int = 2, weights: str = "uniform", exclude_self: bool = True,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every query row: (id, label, predicted, score) by the vote of its k nearest references.

    ``weights='distance'`` votes with the inverse distance; where a neighbour is at distance 0 only
    such neighbours vote.  Vote ties go to the smallest label.  ``score`` is the predicted label's
    share of the votes, ``positive`` that of label 1.
    """
    return vote(neighbours(queries, reference, id_col, vec_col, label_col, k, p, exclude_self, block_rows), id_col, label_col, weights)


def vote(near: DataFrame, id_col: str, label_col: str, weights: str = "uniform") -> DataFrame:
    """The votes of ``neighbours``, as ``knn_predict`` gives them."""
    votes = near.select("id", "label", F.col("near")[0]["distance"].alias("least"), F.explode("near").alias("v"))
    if weights == "distance":
        w = F.when(F.col("least") == 0, (F.col("v.distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("v.distance")))
    else:
        w = F.lit(1.0)
    tally = votes.groupBy("id", "label", F.col("v.near_label").alias("vote")).agg(F.sum(w).alias("w"))
    best = tally.groupBy("id", "label").agg(
        F.max_by("vote", F.struct("w", -F.col("vote"))).alias("predicted"),
        (F.max("w") / F.sum("w")).alias("score"),
        (F.sum(F.when(F.col("vote") == 1, F.col("w")).otherwise(0.0)) / F.sum("w")).alias("positive"))
    return best.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "predicted", "score", "positive")
