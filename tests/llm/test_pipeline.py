import hashlib
import random

import numpy as np
import sentencepiece

import corpus_pipeline as C
from orderlens.llm import common, queries

from .test_simhash import brute_components, brute_fingerprint
from .test_suffix import brute as brute_repeats

SF = "/root/testdata/sf0.001"


def brute_hits(text, windows):
    """Words hit by a benchmark window, as the words' indexes."""
    from orderlens.llm.decontaminate import words_of
    words, hit = words_of(text), set()
    for w in windows:
        for i in range(len(words) - len(w) + 1):
            if words[i:i + len(w)] == w:
                hit |= set(range(i, i + len(w)))
    return words, hit


def test_stages_against_brute_force(spark):
    from orderlens.llm.decontaminate import words_of
    docs = common.table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}

    out = common.written(C.keep_quality(spark, docs, SF), "t")
    assert out.columns == docs.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert all(before[i] == r for i, r in kept.items())
    labels = {r.doc_id: r for r in common.table(spark, SF, "labels").collect()}
    clean = [i for i, r in labels.items() if r.quality and not r.toxic]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)

    out = common.written(C.drop_near_duplicates(spark, out, SF), "t")
    assert out.columns == docs.columns
    ids = sorted(kept)
    comp = brute_components(ids, [brute_fingerprint(kept[i].text) for i in ids], 3)
    alone = {r.doc_id: r for r in out.collect()}
    assert alone == {i: kept[i] for i in set(comp.values())}

    out = common.written(C.cut_repeats(spark, out, SF), "t")
    assert out.columns == docs.columns
    ids = sorted(alone)
    want = dict(zip(ids, brute_repeats([alone[i].text for i in ids], C.REPEAT_BYTES)))
    cut = {r.doc_id: r for r in out.collect()}
    assert cut.keys() == alone.keys()
    for i, r in cut.items():
        n, gone, _, _ = want[i]
        assert n - gone - 6 * want[i][2] <= len(r.text.encode()) <= n - gone and r.n_chars == len(r.text)
        assert gone or r.text == alone[i].text

    out = common.written(C.cut_benchmark(spark, out, SF), "t")
    assert out.columns == docs.columns
    windows = []
    for r in common.table(spark, SF, "benchmark").collect():
        w = words_of(r.text)
        windows += [w[i:i + 10] for i in range(max(1, len(w) - 9) if w else 0)]
    free = {r.doc_id: r for r in out.collect()}
    assert free.keys() == cut.keys()
    for i, r in free.items():
        words, hit = brute_hits(cut[i].text, windows)
        assert words_of(r.text) == [w for k, w in enumerate(words) if k not in hit]

    got = {r.doc_id: r for r in C.tokenize(spark, out, SF).collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    for i, r in free.items():
        ids = lib.encode(r.text, add_bos=True, add_eos=True)
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got.keys() == free.keys()
    assert sorted(r.doc_id for r in C.run(spark, SF).select("doc_id").collect()) == sorted(got)


def test_odd_documents(spark):
    text = "Some plain words are written in this line, and more of them follow in the next one. " * 9
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (2, None, "en", "a", None),
            (3, "", None, "b", 0), (900_004, "x" * 100_000, "fr", "c", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = docs
    for _, stage in C.STAGES:
        out = common.written(stage(spark, out, SF), "t")
    got = [r.doc_id for r in out.collect()]
    assert sorted(set(got) - {900_004}) == [1] and len(got) == len(set(got))
    out = docs.limit(0)
    for _, stage in C.STAGES:
        out = common.written(stage(spark, out, SF), "t")
    assert out.count() == 0


def test_clashing_columns(spark):
    """Columns beyond those of documents, named like a stage's own, change nothing."""
    docs = common.table(spark, SF, "documents")
    odd = docs
    for c in ("kept", "perplexity", "fp", "component_id", "clean_text", "spans", "_text", "digest", "n_words"):
        odd = odd.selectExpr("*", f"'x' as {c}")
    for _, stage in C.STAGES:
        a, b = (stage(spark, d, SF).select("doc_id").collect() for d in (docs, odd))
        assert sorted(r.doc_id for r in a) == sorted(r.doc_id for r in b)


def test_passages_of_over_fifty_words_go(spark):
    """Passages of 51 words or a few more, each in several documents, in words as long as in the given tables."""
    rnd = random.Random(11)
    words = [w for r in common.table(spark, SF, "documents").filter("text is not null").limit(200).collect() for w in r.text.split()][:20_000]
    plain = [w for w in words if w.isalpha()]
    some = lambda n: " ".join(rnd.choices(plain, k=n))
    shared = [some(rnd.randint(51, 60)) for _ in range(40)]
    rows, holds = [], {}
    for i in range(200):
        parts = [some(rnd.randint(20, 200))]
        if i % 2:
            holds[i] = shared[i % 40]
            parts += [holds[i], some(rnd.randint(20, 200))]
        rows.append((i, " ".join(parts), "en", "a", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in C.cut_repeats(spark, docs, SF).collect()}
    assert len(got) == 200
    for i, text, *_ in rows:
        if i in holds:
            assert holds[i] not in got[i] and len(got[i]) <= len(text) - len(holds[i])
        else:
            assert got[i] == text
