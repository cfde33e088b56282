import numpy as np
import pytest

from orderlens.llm import embeddings as E
from orderlens.llm import queries

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def brute(rows, threshold=0.93):
    """(id, links, component) of each row; rows as (id, vector or None, label)."""
    ok = [v is not None and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    n = len(rows)
    comp = list(range(n))
    links = [0] * n

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    comp[root(i)] = root(j)
    least: dict = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], least.get(root(i))) for i in range(n)), key=repr)


def clustered(rng, n, dim=16, labels=3):
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.3, 1.0])
        rows.append((i, np.float32(v).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("block", [4096, 7])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = clustered(rng, 260)
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(40)]                  # a group of copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((tuple(r) for r in E.near_duplicates(df, block_rows=block, tables=40, planes=6).collect()), key=repr)
    assert got == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, [2.0, 4.0, 6.0], 1), (2, [2.0, 4.0, 6.0], 1), (3, v, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1),
            (7, [NAN, 2.0, 3.0], 1), (8, [INF, 2.0, 3.0], 1), (None, v, 1), (9, v, 2), (10, [1.0, 2.0], 1), (11, [], 1), (12, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame([(*r, "z", 0) for r in rows], "vec_id long, embedding array<float>, label int, n_links string, cid int")
    got = sorted((tuple(r) for r in E.near_duplicates(df).collect()), key=repr)
    want = brute(rows)
    # a row without an id takes the component's smallest id; alone it has none
    assert got == want
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_recall_with_the_production_parameters(spark):
    """Against brute force on vectors of every similarity round the threshold: nearly all links are found."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(150, 64))
    other = rng.normal(size=(150, 64))
    other -= (other * base).sum(1, keepdims=True) / (base * base).sum(1, keepdims=True) * base
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = rng.uniform(0.931, 0.96, (150, 1))
    near = c * base + np.sqrt(1 - c * c) * other
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.concatenate([base, near]))]
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sum(r.n_links > 0 for r in got) >= 0.98 * 300


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in queries.QUERIES["op4_embedding_neardup"](spark, SF).collect()), key=repr)
    assert got == brute(rows)
