import itertools

import numpy as np
import pytest
import xxhash

from orderlens.llm import common, simhash


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for (i, a), (j, b) in itertools.combinations(zip(ids, fps), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((root(i), root(j)))
            comp[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b", "A b C", "a b a b a b a b", "é É x\x0by z " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("radius,block", [(3, 8192), (3, 5), (0, 4), (6, 16)])
def test_links_connect_all_within_radius(spark, radius, block):
    rng = np.random.default_rng(radius + block)
    seeds = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {0}
    for s in seeds:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(0, radius + 3), replace=False)
            fps.add(int(s) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    rows = [(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)]
    links = simhash.link_fingerprints(spark.createDataFrame(rows, "node long, fp long"), radius, block).collect()
    assert all((fps[r.u] ^ fps[r.v]).bit_count() <= 2 * 64 for r in links)
    got = {r.node: r.component for r in
           simhash.connected_components(spark.createDataFrame([(r.u, r.v) for r in links], "u long, v long")).collect()}
    want = brute_components(range(len(fps)), fps, radius)
    assert {i: got.get(i, i) for i in want} == want


def test_documents(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here again " * 6
    rows = [(5, base, "x"), (3, base, "x"), (9, base.replace("lazy", "sleepy", 1), "y"), (1, None, None), (2, "", "z"),
            (None, base, "n"), (7, "something else entirely is written in this other document", "q"), (7, "one", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr)
    want_fp = sorted(((r[0], int(np.uint64(brute_fingerprint(r[1])).astype(np.int64))) for r in rows), key=repr)
    assert sorted(((r[0], r[1]) for r in got), key=repr) == want_fp
    comp = {(i, f): c for i, f, c in got}
    fp = lambda t: int(np.uint64(brute_fingerprint(t)).astype(np.int64))
    assert comp[(5, fp(base))] == comp[(None, fp(base))] == 3
    assert comp[(1, 0)] == comp[(2, 0)] == 1


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    from orderlens.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    want = brute_components(sorted(fps), [fps[i] for i in sorted(fps)], 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op8_simhash_neardup"](spark, sf).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_partitions_are_searched_in_whole_groups(spark, monkeypatch):
    """Few rows at a time give the same components as a whole partition at once."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.integers(0, 60, rng.integers(0, 3))) for b in base for _ in range(12)})
    df = spark.createDataFrame(list(enumerate(fps)), "node long, fp long").coalesce(2)
    parts = lambda: {r.node: r.component for r in common.connected_components(simhash.link_fingerprints(df, 3, 16)).collect()}
    want = parts()
    monkeypatch.setattr(simhash, "STREAM_ROWS", 5)
    assert parts() == want and len(set(want.values())) < len(fps)
