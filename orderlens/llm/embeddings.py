"""Embedding near-duplicates: sign hashing by random hyperplanes in several tables, exact cosine on the
candidates, and distributed connected components.

Equal vectors of a label are one class before hashing, so a group of copies costs one row.  In a
bucket the pairs are verified by matrix products, block against block; a pair that meets in several
tables counts only in the first of them, which both signatures tell, so no pair is ever emitted:
a task returns counts a vector and a spanning forest of links.

Recall: vectors at the threshold 0.93 agree on a plane's side with probability 0.880.  With the
default 10 planes a table and 24 tables a pair at the threshold meets with probability 0.9991, one at
0.95 with 0.99999; the tests measure it against brute force.

Defined results: a vector that is null, zero or holds a null or non-finite component, and a null
label, link with nothing; rows repeated whole link with each other; a row without an id links but is
never the smallest id; rows that tie on an id count each and share its component; vectors of another length are
never compared, vectors of any length are taken whole; an empty table gives no rows; only the id, vector and label are
read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, in_blocks, smallest_labels, written

THRESHOLD, PLANES, TABLES, SEED = 0.93, 10, 24, 42
BLOCK_ROWS = 4096


def _planes(dim: int, planes: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, tables * planes))


def signatures(vectors: np.ndarray, planes: int, tables: int, seed: int) -> np.ndarray:
    """(row, table): the bits of the sides on which a vector lies, as one integer a table."""
    side = (vectors @ _planes(vectors.shape[1], planes, tables, seed)) >= 0
    return side.reshape(len(vectors), tables, planes) @ (1 << np.arange(planes))


def _verified(vectors: np.ndarray, sigs: np.ndarray, table: int, weight: np.ndarray, own: np.ndarray,
              block: np.ndarray, threshold: float):
    """Of one bucket's block: (links of each row, a, b) over pairs not met in an earlier table.

    A pair of two indexed rows is met in this block alone; one of an indexed and a looked-up row
    counts in the block of the smaller number only."""
    members = np.flatnonzero(own)
    links = np.zeros(len(vectors), np.int64)
    norm = np.sqrt((vectors * vectors).sum(1))
    ends_a, ends_b = [], []
    for i in range(0, len(vectors), 512):
        rows = np.arange(i, min(i + 512, len(vectors)))
        cos = (vectors[rows] @ vectors[members].T) / (norm[rows, None] * norm[members])
        r, m = np.nonzero(cos >= threshold)
        a, b = rows[r], members[m]
        # both indexed: once, as a < b; one looked up: only against blocks before its own
        once = np.where(own[a], a < b, block[a] > block[b])
        a, b = a[once], b[once]
        if table and len(a):
            new = ~(sigs[a, :table] == sigs[b, :table]).any(1)
            a, b = a[new], b[new]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        ends_a.append(a)
        ends_b.append(b)
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    label = smallest_labels(len(vectors), a, b)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return links, linked, label[linked]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, planes: int = PLANES, tables: int = TABLES, seed: int = SEED,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id`` of every row of ``rows``."""
    base = written(rows.select(F.col(id_col).cast("long").alias("vec_id"),
                               F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("vector"),
                               F.col(label_col).alias("label")), "vectors")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = (F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite)
            & F.exists("vector", lambda x: x != 0))
    # a class of equal vectors: n copies, named by the smallest id (copies without an id count, too)
    classes = written(base.filter(good).groupBy("label", "vector")
                      .agg(F.count("*").alias("n"), F.min("vec_id").alias("node"))
                      .withColumn("cid", F.monotonically_increasing_id()), "classes")  # written, so the ids stay

    def sign(batches):
        import pyarrow as pa
        for b in batches:
            lists = b.column(b.schema.get_field_index("vector"))
            size = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            sigs = np.zeros((b.num_rows, tables), np.int64)
            for dim in np.unique(size):  # vectors of another length never compare
                at = np.flatnonzero(size == dim)
                sigs[at] = signatures(flat[(ends[at] - dim)[:, None] + np.arange(dim)], planes, tables, seed)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(sigs), pa.list_(pa.int64()))],
                                             names=[*b.schema.names, "sigs"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    signed = classes.mapInArrow(sign, ", ".join(f"`{k}` {t}" for k, t in kinds.items()) + ", sigs array<long>")
    dealt = in_blocks(
        signed.select("cid", "n", "label", "vector", "sigs", F.size("vector").alias("dim"), F.posexplode("sigs").alias("table", "sig")),
        ["label", "dim", "table", "sig"], "cid", block_rows)
    keys = ["label", "dim", "table", "sig", "block"]

    def verify(batches):
        import pyarrow as pa
        for groups in _groups(batches, keys):
            cid, vec, sigs, weight, own, home_, table = groups
            links, a, b = _verified(vec, sigs, table, weight, own, home_, threshold)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([cid[hit], cid[a]])), pa.array(np.concatenate([links[hit], np.zeros(len(a), np.int64)])),
                 pa.array(np.concatenate([cid[hit], cid[b]]))], names=["u", "links", "v"])

    found = written(dealt.select("cid", "n", "vector", "sigs", "own", "home", *keys)
                    .repartition(*keys).sortWithinPartitions(*keys)
                    .mapInArrow(verify, "u long, links long, v long"), "links")
    counts = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "cid")
    parts = connected_components(found.filter("u <> v").select("u", "v"))
    # the smallest id of a component, over its classes
    named = (classes.select("cid", "node", "n")
             .join(parts.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    known = (named.join(least, "component").join(counts, "cid", "left")
             .select("cid", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    known = known.join(classes.select("cid", "label", "vector"), "cid").drop("cid")
    return (base.join(known, ["label", "vector"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id")))


def _groups(batches, keys):
    """The groups of a partition sorted by ``keys``, one after another, as numpy arrays."""
    import pyarrow as pa
    held: list = []

    def cut(t):
        change = np.zeros(t.num_rows, bool)
        for k in keys:
            c = t.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= c[1:] != c[:-1]
        return np.concatenate([[0], np.flatnonzero(change), [t.num_rows]])

    def of(t, s, e):
        t = t.slice(s, e - s).combine_chunks()
        col = lambda c: t.column(c).to_numpy(zero_copy_only=False)
        flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        return (col("cid"), flat("vector"), flat("sigs"), col("n"), np.asarray(col("own"), bool), col("home"),
                int(col("table")[0]))

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        ends = cut(t)
        for s, e in zip(ends[:-2], ends[1:-1]):
            if e - s > 1:
                yield of(t, s, e)
        held = t.slice(ends[-2]).to_batches()
    if held:
        t = pa.Table.from_batches(held)
        if t.num_rows > 1:
            yield of(t, 0, t.num_rows)
