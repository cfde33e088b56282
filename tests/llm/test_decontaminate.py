import hashlib
import random

import numpy as np
import pytest

from orderlens.llm import decontaminate as D
from orderlens.llm import queries

SF = "/root/testdata/sf0.001"


def brute(docs, items, window=10):
    grams: dict = {}
    for item, t in items:
        w = D.words_of(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for t in docs:
        w = D.words_of(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[g]
        ids = ",".join(sorted(str(x) for x in found))
        out.append((len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def test_index_against_brute_force():
    rnd = random.Random(3)
    for _ in range(250):
        v = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 6]))]
        items = [(i, " ".join(rnd.choices(v, k=rnd.choice([0, 1, 3, 9, 10, 11, 14])))) for i in range(rnd.choice([0, 1, 3]))]
        docs = [" ".join(rnd.choices(v + ["zz"], k=rnd.choice([0, 1, 5, 12, 30, 60]))) for _ in range(rnd.choice([1, 2, 5]))]
        w = D.Windows(items)
        ids = [np.array([w.ids.get(x, 0) for x in D.words_of(t)], np.int32) for t in docs]
        doc, begin, size, pattern = D._shard(ids, w)
        for k, want in enumerate(brute(docs, items)):
            m = doc == k
            spans = D.merged_spans(begin[m], size[m])
            assert (len(ids[k]), sum(e - b for b, e in spans)) == want[:2]
            assert len({x for p in pattern[m] for x in w.items[p]}) == want[2]


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 11, 700)
    w = D.Wavelet(v, 11)
    i = np.arange(700)
    value, before = w.access_rank(i)
    assert (value == v).all() and (before == [int((v[:j] == v[j]).sum()) for j in i]).all()


ITEM = "One two three four five six seven eight nine ten eleven twelve"


@pytest.mark.parametrize("more", [{}, {"part_chars": 40}])
def test_odd_rows(spark, more):
    docs = [(1, f"So: {ITEM.upper()}, it ended.", "a", 3), (1, f"So: {ITEM.upper()}, it ended.", "a", 3), (2, None, None, None), (3, "", "b", 1),
            (None, "tiny ITEM", "c", 2), (4, "é" * 9 + " word " * 30_000 + ITEM, "d", 5), (5, "one two three four five six seven eight nine", "e", 6)]
    bench = [(0, ITEM, "x"), (7, "tiny item", "x"), (7, "tiny item", "x"), (8, None, "x"), (9, "", "x"), (None, "word word word word word word word word word word x", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, items string, n_words int").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string, n_hit string")
    got = D.decontaminate(d, b, cleaned=True, **more).collect()
    want = brute([r[1] for r in docs], [r[:2] for r in bench])
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == \
        sorted((r[0] or -1, *w) for r, w in zip(docs, want))
    clean = {r.doc_id: r.clean_text for r in got}
    assert clean[1] == "So: , it ended." and clean[2] is None and clean[3] == "" and clean[None] == "" and clean[4] == "é" * 9 + " "
    assert D.decontaminate(d.limit(0), b, **more).count() == 0
    assert all(not r.contaminated for r in D.decontaminate(d, b.limit(0)).collect())


def test_several_shards_a_task(spark, monkeypatch):
    rnd = random.Random(1)
    v = ["a", "b"]
    docs = [(i, " ".join(rnd.choices(v, k=40))) for i in range(60)]
    items = [(i, " ".join(rnd.choices(v, k=11))) for i in range(9)]
    monkeypatch.setattr(D, "SHARD_WORDS", 100)
    got = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), spark.createDataFrame(items, "item_id long, text string"))
    want = {i: w for (i, _), w in zip(docs, brute([t for _, t in docs], items))}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()} == want


def test_a_benchmark_of_many_parts(spark):
    """Parts of any size give the rows of one; an item in several pieces keeps all its windows."""
    rnd = random.Random(8)
    v = ["a", "b", "c"]
    docs = [(i, " ".join(rnd.choices(v, k=rnd.choice([0, 5, 60])))) for i in range(50)]
    items = [(i, " ".join(rnd.choices(v, k=rnd.choice([3, 11, 90])))) for i in range(12)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {i: w for (i, _), w in zip(docs, brute([t for _, t in docs], items))}
    for chars in (10, 300, 10_000):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.decontaminate(d, b, part_chars=chars).collect()}
        assert got == want
    cut = D._pieces(b.toDF("item", "text"), 10, 7).collect()
    whole, pieces = D.Windows(items), D.Windows([(r["item"], r["text"]) for r in cut])
    named = lambda w: {tuple({i: x for x, i in w.ids.items()}[i] for i in p): set(x) for p, x in zip(w.patterns, w.items)}
    assert len(cut) > 30 and named(whole) == named(pieces)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = dict(zip(docs, brute(docs.values(), items)))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert got == want and any(w[4] for w in want.values())
