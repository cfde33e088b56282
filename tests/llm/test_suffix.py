import hashlib
import random

import pytest

from orderlens.llm import suffix_dedup as S

SF = "/root/testdata/sf0.001"


def brute(texts, size):
    """(bytes, removed, spans, digest of the rest) of each text, from a count of every window."""
    from collections import Counter
    raws = [(t or "").encode() for t in texts]
    seen = Counter(hash(r[i:i + size]) for r in raws for i in range(len(r) - size + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[hash(r[i:i + size])] > 1:
                gone[i:i + size] = b"\x01" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(x for x, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def test_merge_orders_and_measures():
    rnd = random.Random(2)
    for trial in range(200):
        runs = [sorted({bytes(rnd.choices(b"ab", k=rnd.randint(0, 9))) for _ in range(rnd.randint(0, 12))})
                for _ in range(rnd.randint(1, 7))]
        got = list(S.merge([S.front_decoded(S.front_code(r)) for r in runs]))
        assert [s for _, _, s in got] == sorted(s for r in runs for s in r)
        last = b""
        for i, (_, n, s) in enumerate(got):
            want = next((j for j, (x, y) in enumerate(zip(last, s)) if x != y), min(len(last), len(s)))
            assert n == (want if i else 0)
            last = s
        for r, (_, _, _) in zip(runs, got):
            assert [s for _, s in S.front_decoded(S.front_code(r))] == r


def passages(rnd, n_docs, alphabet, size):
    text = lambda n: "".join(rnd.choices(alphabet, k=n))
    shared = [text(rnd.randint(size - 20, 3 * size)) for _ in range(6)]
    docs = []
    for _ in range(n_docs):
        parts = [text(rnd.randint(0, 2 * size))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(shared)
            a, b = sorted(rnd.sample(range(len(p) + 1), 2)) if rnd.random() < 0.6 else (0, len(p))
            parts += [p[a:b], text(rnd.choice([0, 1, 3, 60, 300]))]
        docs.append("".join(parts))
    return docs


@pytest.mark.parametrize("seed,alphabet,run_bytes", [(1, "abcdefgh ", 40_000_000), (2, "ab", 20_000), (3, "aéß日 ", 5_000), (4, "a", 9_000)])
def test_brute_force(spark, seed, alphabet, run_bytes):
    rnd = random.Random(seed)
    size = 100
    docs = passages(rnd, 60 if alphabet != "a" else 8, alphabet, size)
    docs += [docs[0], docs[1], docs[1], None, "", "x" * (size - 1), "y" * size, "z" * (3 * size), docs[2][:-1], "!" + docs[3]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.remove_repeats(df, size=size, run_bytes=run_bytes, range_bytes=20_000).collect()}
    want = dict(enumerate(brute(docs, size)))
    assert {i: v[:3] for i, v in got.items()} == {i: v[:3] for i, v in want.items()}
    assert got == want


def test_odd_tables(spark):
    cols = "doc_id long, text string, z string, bytes int, copies string, spans int, picked int"
    base = "".join(chr(97 + i * 7 % 26) + chr(97 + i % 23) for i in range(400))
    rows = [(None, base, "a", 1, "b", 2, 3), (4, base, None, None, None, None, None), (4, base, "q", 1, "w", 2, 3), (5, None, "a", 1, "b", 2, 3)]
    out = S.remove_repeats(spark.createDataFrame(rows, cols), kept_text=True).collect()
    assert sorted((r.n_bytes, r.n_removed, r.kept) for r in out) == [(0, 0, "")] + [(800, 800, "")] * 3
    assert S.remove_repeats(spark.createDataFrame([], cols)).count() == 0


def test_query_against_brute_force(spark):
    from orderlens.llm import queries
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(docs, brute(docs.values(), 400)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op3_suffix_dedup"](spark, SF).collect()}
    assert got == want


def test_query_gives_the_text_that_is_left(spark, tmp_path):
    from orderlens.llm import queries
    same = " ".join(f"word{i}" for i in range(80))
    rows = [(1, f"first {same} end"), (2, f"other {same} tail"), (3, "short"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.QUERIES["op3_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert [out[k]["text"] for k in (1, 2, 3, 4)] == ["firstend", "othertail", "short", ""]
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in out.values())
