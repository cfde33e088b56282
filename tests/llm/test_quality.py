from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import common, quality

SF = "/root/testdata/sf0.01"


def brute_model(texts):
    """Interpolated modified Kneser-Ney over symbol tuples, straight from its definition."""
    n, edge = quality.ORDER, quality.EDGE
    raw = Counter()
    for t in texts:
        for c in quality.grams(t).tolist():
            raw[tuple((c >> 6 * (n - 1 - k)) & 63 for k in range(n))] += 1
    tables = {n: raw}
    for k in range(n - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts = {}
    for k, t in tables.items():
        n1, n2, n3, n4 = (sum(v == j for v in t.values()) + 1 for j in (1, 2, 3, 4))  # raised by 1: one rule for any size
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        cuts[k] = [min(max(x, 0.05), j - 0.05) for j, x in enumerate(d, 1)]
    assert edge == 63

    def p(gram):
        if not gram:
            return 1 / 64
        t, d = tables[len(gram)], cuts[len(gram)]
        same = {g: c for g, c in t.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        cut = lambda c: d[min(c, 3) - 1]
        c = same.get(gram, 0)
        own = (c - cut(c)) / total if c else 0
        return own + sum(map(cut, same.values())) / total * p(gram[1:])
    return p


def test_probabilities_equal_the_definition(spark):
    texts = ["the cat sat on the mat.\nThe dog sat too!", "a cat, a dog, and 42 mats", "été à la mer", "the the the"]
    counts = quality.gram_counts(spark.createDataFrame([(t,) for t in texts], "t string"))
    probs, weights = quality.train(common.written(counts, "c"))
    scorer = quality.Scorer([quality._arrays(x) for x in probs], [quality._arrays(x) for x in weights])
    p = brute_model(texts)
    for probe in texts + ["zzz", "cat dog mat", "THE %%% ###", "the été 日本"]:
        for code in quality.grams(probe).tolist():
            gram = tuple((code >> 6 * (3 - k)) & 63 for k in range(4))
            assert np.exp(-scorer.cost[code]) == pytest.approx(p(gram), rel=1e-4)
    # a proper distribution after any context
    assert np.exp(-scorer.cost.reshape(-1, 64).astype(float)).sum(1) == pytest.approx(1, abs=1e-3)


def test_held_out_accuracy(spark):
    rows = quality.classify(common.table(spark, SF, "documents"), common.table(spark, SF, "labels")).toPandas()
    labels = common.table(spark, SF, "labels").toPandas()
    m = rows.merge(labels, on="doc_id")
    clean = m[(m.quality == 1) & (m.toxic == 0)]
    assert clean.kept.mean() >= 0.97
    assert m[m.quality == 0].kept.mean() <= 0.1
    assert len(rows) == common.table(spark, SF, "documents").count()


def test_odd_rows(spark):
    good = "Some plain words are written in this line, and more of them follow in the next one."
    rows = [(i, good[i % 7:], "en", 1) for i in range(40)] + [(90, None, "en", 1), (91, "", None, 2), (92, "x" * 90000, "en", 3),
                                                                 (93, good, None, 4), (93, good, None, 4), (None, good, "xx", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels, keep=("quality",)).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert not kept[90] and not kept[91] and not kept[92] and kept[93] and kept[None] and kept[0]
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.doc_id: r.kept for r in none}[92] and not {r.doc_id: r.kept for r in none}[90]
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_each_language_has_its_own_limit(spark):
    import random
    rnd = random.Random(3)

    def texts(letters, n, size):
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(60)]
        return [" ".join(rnd.choice(words) for _ in range(size)) for _ in range(n)]

    rows, marks = [], []
    for lang, letters, n in (("big", "etaoin", 600), ("small", "qwxzjkvbpygfmhu", 60), (None, "dlcrs\u00e9\u00e8", 60)):
        for i, t in enumerate(texts(letters, n, 30)):
            rows.append((len(rows), t, lang))
            if i % 2:
                marks.append((rows[-1][0], 1, 0))
    clean = len(rows)
    rows += [(len(rows) + i, t, lang) for i, (t, lang) in enumerate([("%$ # 77 " * 20, "small"), ("QQ 77 " * 30, None), ("%$ # 77 " * 20, "new"), ("", "new")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in quality.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    limits = {lang: {out[i].threshold for i, _, x in rows if x == lang} for lang in ("big", "small", None, "new")}
    assert all(len(x) == 1 for x in limits.values()) and limits["new"] == {None}
    assert len({next(iter(x)) for x in limits.values()}) == 4
    for lang in ("big", "small", None):
        assert sum(out[i].kept for i, _, x in rows[:clean] if x == lang) >= 0.95 * sum(x == lang for _, _, x in rows[:clean])
    assert [out[i].kept for i, *_ in rows[clean:]] == [False, False, True, False]


def brute_costs(trusted, texts):
    """Sums of -log probability over code points, straight from the definition of the model."""
    n = quality.ORDER
    runs = lambda t: [(["<"] * (n - 1) + list(t) + ["<"])[i:i + n] for i in range(len(t) + 1)]
    tables = {n: Counter(tuple(r) for t in trusted for r in runs(t))}
    for k in range(n - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    least = 1 / (len({g[-1] for g in tables[n]}) + 1)

    def p(gram):
        if not gram:
            return least
        n1, n2, n3, n4 = (sum(v == j for v in tables[len(gram)].values()) + 1 for j in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(x, 0.05), j - 0.05) for j, x in enumerate([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 1)]
        same = {g: c for g, c in tables[len(gram)].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        cut = lambda c: d[min(c, 3) - 1]
        c = same.get(gram, 0)
        return ((c - cut(c) if c else 0) + sum(map(cut, same.values())) * p(gram[1:])) / sum(same.values())

    return [sum(-np.log(p(tuple(r))) for r in runs(t)) for t in texts], least


def test_scores_equal_the_definition_over_code_points(spark):
    trusted = ["the cat sat on the mat.\nThe dog", "a cat, a dog, 42 mats", "мама мыла раму", "日本語 😀"]
    # a word of another script, and one of letters that have the same remainders by 3
    probes = trusted + ["мама", "ргрг", "zzz", "CAT", "cat", "	", "the 􏿿"]
    want, least = brute_costs(trusted, probes)
    counts = quality.run_counts(spark.createDataFrame([(t,) for t in trusted], "t string"))
    counts = common.written(counts.withColumn("model", F.lit(3)), "c")
    probs, weights = quality.train_runs(counts, least=least)
    docs = spark.createDataFrame([*enumerate(probes), (90, None), (91, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.scored(docs, probs, weights, least, F.lit(3), keep=("doc_id",)).collect()}
    assert [got[i].cost for i in range(len(probes))] == pytest.approx(want, rel=1e-9)
    assert [got[i].symbols for i in range(len(probes))] == [len(t) + 1 for t in probes]
    assert got[90].cost is None and got[91].cost is None and len(got) == len(probes) + 2
    assert got[len(trusted)].cost < got[len(trusted) + 1].cost - 1 and got[len(trusted) + 3].cost > got[len(trusted) + 4].cost + 1


def test_runs_are_counted_across_batches_and_chunks(spark, monkeypatch):
    texts = ["".join(chr(0x400 + (i * j) % 90) for j in range(i)) for i in range(60)] + [None, "", "x"]
    want = Counter((t_[i], t_[i + 1], t_[i + 2], t_[i + 3]) for t in texts if t for t_ in ["<<<" + t + "<"] for i in range(len(t) + 1))
    monkeypatch.setattr(quality, "CHUNK", 50)
    rows = quality.run_counts(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)).collect()
    char = lambda c: "<" if c == quality.FRAME else chr(c)
    low = (1 << quality.POINT_BITS) - 1
    got = {(char(r.context >> 2 * quality.POINT_BITS), char(r.context >> quality.POINT_BITS & low), char(r.context & low), char(r.symbol)): r.n for r in rows}
    assert got == dict(want) and len(got) == len(rows)
