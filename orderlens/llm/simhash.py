"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius that
BK-trees search, and grouped by distributed connected components.

Two fingerprints within radius r agree on one of r + 1 bands of their bits, so each band's value
names a shard; a shard's BK-tree is kept with its own queries in one task, which follows only the
edges within the radius.  (Sending every shard's tree to every query would compare all fingerprints
with all trees; the bands give the same links.)  A shard too large for one tree is dealt to blocks.
Only distinct fingerprints are searched, and a task returns the links of a spanning forest, so a
group of n copies never becomes n * n pairs.

Defined results: a null or empty text has fingerprint zero, linked like any other; rows repeated
whole get the same component; a row without an id gets its fingerprint's component but is never its
smallest id; an empty table gives no rows; texts of any length are hashed whole; only the named columns are read, so other columns may have any names (``deduplicate`` hands them all on).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, in_blocks, smallest_labels, written

#: Rows of a block of a shard, and documents' shingle bits that are summed at a time.
BLOCK_ROWS = 8192
#: Rows of a partition that are searched at a time, in whole groups.
STREAM_ROWS = 65_536
CHUNK = 1 << 16
#: Fingerprints that a level of the search compares at a time, at most.
FRONTIER = 1 << 21


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64 values; no words: 0."""
    from xxhash import xxh64_intdigest
    words = text.encode().lower().split() if text else []  # bytes: A-Z lower-cased, cut at 20 and 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    starts, ends = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        h = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                      shingle: int = 3, seed: int = 42) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint's bits as a long) of every row."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields] + ["fp long"]
    n = len(keep)
    at = keep.index(text_col) if text_col in keep else n  # a text that is kept is sent once

    def mark(batches):
        import pyarrow as pa
        for b in batches:
            fp = np.array([fingerprint(v.as_py(), shingle, seed) for v in b.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(fp)], names=[*keep, "fp"])

    wide = docs.select(*keep) if at < n else docs.select(*keep, docs[text_col].cast("string"))
    return wide.mapInArrow(mark, ", ".join(fields))


class BKForest:
    """BK-trees of several groups of fingerprints, built and searched level by level with numpy.

    Each group's first fingerprint is its root; a fingerprint goes to the child whose edge is its
    Hamming distance to the parent, and becomes that child if there is none yet."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        n = len(values)
        self.values = values
        self.roots = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.empty(0, np.int64)
        here = np.repeat(self.roots, np.diff(np.append(self.roots, n)))  # the node each row stands at
        rows = np.setdiff1d(np.arange(n), self.roots)
        parents, edges, nodes = [], [], []
        while len(rows):
            edge = np.bitwise_count(values[rows] ^ values[here[rows]]).astype(np.int64)
            key = here[rows] * 65 + edge
            kinds, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            new = rows[first]
            parents.append(kinds // 65)
            edges.append(kinds % 65)
            nodes.append(new)
            here[rows] = new[inverse]
            rest = np.ones(len(rows), bool)
            rest[first] = False
            rows = rows[rest]
        cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        key = cat(parents) * 65 + cat(edges)
        order = np.argsort(key)
        self.keys, self.children = key[order], cat(nodes)[order]

    def within(self, queries: np.ndarray, roots: np.ndarray, radius: int):
        """Yield (query index, row) arrays of fingerprints within ``radius``, level by level."""
        q, node = np.arange(len(queries)), roots
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            wide = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide) + np.arange(int(wide.sum()))
            q, node = np.repeat(q, wide), self.children[at]


def _forest_links(values: np.ndarray, group: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) of a spanning forest over rows of the same group within ``radius``; rows come
    sorted by group, and only those with ``own`` are in the trees."""
    members = np.flatnonzero(own)
    if not len(members):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    tree = BKForest(values[members], group[members])
    rooted = group[members][tree.roots]
    label = np.arange(len(values))
    at = np.searchsorted(rooted, group)
    has = (at < len(rooted)) & (rooted[np.minimum(at, len(rooted) - 1)] == group)
    rows = np.flatnonzero(has)
    # so many queries walk at once that even a walk over all of a tree's nodes stays small
    largest = int(np.diff(np.append(tree.roots, len(members))).max())
    queries_at_once = max(16, min(4096, FRONTIER // largest))
    for i in range(0, len(rows), queries_at_once):
        part = rows[i:i + queries_at_once]
        for q, node in tree.within(values[part], tree.roots[at[part]], radius):
            a, b = part[q], members[node]
            label = _joined(label, a, b)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return linked, label[linked]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b; each label is the smallest row of its component."""
    a, b = label[a], label[b]
    if (a == b).all():
        return label
    return smallest_labels(len(label), a, b)[label]


def link_fingerprints(fps: DataFrame, radius: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v) between the ``node`` ids of distinct fingerprints (node, fp), enough to connect
    all that are within ``radius`` of each other."""
    bands = radius + 1
    cuts = [64 * i // bands for i in range(bands + 1)]
    band = F.array(*[F.struct(F.lit(i).alias("band"),
                              F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)).alias("value"))
                     if bands > 1 else F.struct(F.lit(0).alias("band"), F.lit(0).cast("long").alias("value"))
                     for i in range(bands)])
    members = fps.select("node", "fp", F.explode(band).alias("b")).select("node", "fp", "b.band", "b.value")
    dealt = in_blocks(members, ["band", "value"], "fp", block_rows)
    keys = ["band", "value", "block"]

    def changes(t):
        col = lambda c: t.column(c).to_numpy()
        return np.concatenate([[False], np.any([np.diff(col(c)) != 0 for c in keys], axis=0)])

    def links(t):
        import pyarrow as pa
        col = lambda c: t.column(c).to_numpy()
        node = col("node")
        a, b = _forest_links(col("fp").view(np.uint64), np.cumsum(changes(t)), np.asarray(col("own"), bool), radius)
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["u", "v"])

    def search(batches):
        import pyarrow as pa
        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n >= STREAM_ROWS:  # whole groups go; the last one may go on
                t = pa.Table.from_batches(held)
                ends = np.flatnonzero(changes(t))
                if len(ends):
                    yield links(t.slice(0, ends[-1]))
                    t = t.slice(ends[-1])
                held, n = t.to_batches(), t.num_rows
        if held:
            yield links(pa.Table.from_batches(held))

    return (dealt.select("node", "fp", *keys, "own")
            .repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(search, "u long, v long"))


def _grouped(marked: DataFrame, radius: int, block_rows: int) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints of ``marked`` (doc_id, fp)."""
    # a class of equal fingerprints is named by its smallest id; one without ids has no links to report
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    known = classes.filter("node is not null")
    labels = connected_components(link_fingerprints(known, radius, block_rows))
    return known.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
                    radius: int = 3, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: component_id is the smallest id reachable by links."""
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = written(with_fingerprints(marked, "text", ("doc_id",), shingle, seed), "fingerprints")
    return marked.join(_grouped(marked, radius, block_rows), "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
                radius: int = 3, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one of the smallest id, one of repeated
    rows; rows without an id make a group by fingerprint unless a row with an id has it."""
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text, key = f"c{columns.index(text_col)}", f"c{columns.index(id_col)}"
    ids = plain.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    small = written(with_fingerprints(ids, "text", ("doc_id",), shingle, seed), "fingerprints")
    grouped = small.join(_grouped(small, radius, block_rows), "fp", "left")
    copies = small.groupBy("doc_id").agg(F.count("*").alias("copies"))
    chosen = (grouped.filter("doc_id = component_id").groupBy("doc_id").agg(F.min("fp").alias("fp")).join(copies, "doc_id"))
    chosen = written(chosen.unionByName(grouped.filter("component_id is null").select(F.lit(None).cast("long").alias("doc_id"), "fp")
                                        .distinct().withColumn("copies", F.lit(0).cast("long"))), "chosen")
    match = F.col(key).cast("long") == F.col("doc_id")
    out = plain.join(chosen.filter("copies = 1").hint("merge"), match, "left_semi")
    # an id of several rows, or none: its rows are told apart by their fingerprints, and equal ones count once
    for some, rows in ((chosen.filter("copies > 1"), plain.join(chosen.filter("copies > 1"), match, "left_semi")),
                       (chosen.filter("copies = 0"), plain.filter(F.col(key).isNull()))):
        if not some.isEmpty():
            marked = with_fingerprints(rows, text, tuple(plain.columns), shingle, seed)
            some = some.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
            same = F.col(key).cast("long").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp"))
            out = out.unionByName(marked.join(some, same, "left_semi").dropDuplicates([key, "fp"]).select(*plain.columns))
    return out.toDF(*columns)


def hex_of(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
