import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from orderlens.llm import align as A
from orderlens.llm import queries

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), queries.tokenizer_path()


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, "rb") as a, open(B_PATH, "rb") as b:
        return A.Aligner(a.read(), b.read())


def ranges(sizes):
    ends = [0]
    for n in sizes:
        ends.append(ends[-1] + n)
    return list(zip(ends, ends[1:]))


def brute(texts, libraries):
    """Rows of the contract, from whole texts and all pairs of ranges that are near each other."""
    a_lib, b_lib = libraries
    letters = A.byte_of_letter()
    docs, counts = [], Counter()
    for t in texts:
        a = a_lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_lib.encode(t) if t else []
        a_raw = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
        b_raw = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_lib.id_to_piece(i)]]
        if not t or b"".join(a_raw) != (" " + t).encode() or b"".join(b_raw) != (" " + t).encode():
            docs.append(None)
            continue
        ra, rb = ranges(map(len, a_raw)), ranges(map(len, b_raw))
        at = {}
        for j, (s, e) in enumerate(rb):
            for x in range(s, e):
                at[x] = j
        links = [(a[i], b[j]) for i, (s, e) in enumerate(ra) for j in sorted({at[x] for x in range(s, e)})]
        counts.update(links)
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, s = [], 0
        for e in cuts:
            groups.append(",".join(str(x) for x, (_, f) in zip(a, ra) if s < f <= e) + "|" + ",".join(str(x) for x, (_, f) in zip(b, rb) if s < f <= e))
            s = e
        docs.append((len(a), len(b), links, groups))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = d
            out.append((n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                        hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def rows_of(df):
    return {r.doc_id: tuple(r[c] for c in [*A.COUNTS, "groups_sha256"]) for r in df.collect()}


def test_units_encode_as_whole_texts(aligner, libraries):
    a_lib, b_lib = libraries
    rnd = random.Random(7)
    pool = ["a", "The", "ing", " ", " ", " ", "\n", "  ", "\t", "é", "日本", "'s", "12", "!", "\x1c", "\x85", " ", "᠎", "​", "　", "🙂", "<|endoftext|>",
            "<s>", "\r\n", "."]
    for _ in range(4000):
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(1, 30)))
        parts = aligner.encode(A.units_of(t))
        assert [i for x, _ in parts for i in x] == a_lib.encode(" " + t, add_special_tokens=False).ids, repr(t)
        assert [i for _, y in parts for i in y] == b_lib.encode(t), repr(t)


def test_composing_is_associative():
    rnd = random.Random(8)
    for _ in range(600):
        n = rnd.randint(1, 40)
        a_end = sorted({*rnd.sample(range(1, n + 1), rnd.randint(0, n)), n})
        b_end = sorted({*rnd.sample(range(1, n + 1), rnd.randint(0, n)), n})
        whole = A.Tokens([*range(len(a_end))], a_end, [*range(len(b_end))], b_end)
        want, groups = A.fragment_of(whole, 0)
        assert want.first == 0 and want.last == n and want.prefix == want.suffix == A.Tokens()
        edges = sorted({0, n, *rnd.sample(range(n + 1), rnd.randint(0, n))})
        parts, found = [], []
        for s, e in zip(edges, edges[1:]):
            pick = lambda ids, ends: ([i for i, x in zip(ids, ends) if s < x <= e], [x for x in ends if s < x <= e])
            f, closed = A.fragment_of(A.Tokens(*pick(whole.a, a_end), *pick(whole.b, b_end)), 0 if s == 0 else None)
            parts.append(A.Fragment.unpack(f.pack()))
            found += closed
        while len(parts) > 1:  # any order of composing neighbours
            i = rnd.randrange(len(parts) - 1)
            f, closed = A.compose(parts[i], parts[i + 1])
            parts[i:i + 2] = [f]
            found += [closed] if closed else []
        assert parts == [want]
        assert sorted((at, t.text()) for at, t in found) == sorted((at, t.text()) for at, t in groups)
    assert A.compose(A.EMPTY, want) == (want, None) and A.compose(want, A.EMPTY) == (want, None)


def test_stretches_cut_anywhere_compose(aligner, libraries):
    """Ranges of any size, cut inside units and tokens, give the groups of the whole text."""
    rnd = random.Random(4)
    for text in ["some wörds here, and 日本語 too", "q" * 300, "a\n\nb " * 20, "naïve " + "é" * 90 + " end"]:
        whole = A.Stretch(aligner, 0, " " + text)
        want, groups = whole.fragment(0, int(whole.ends[-1]))
        text_of = lambda closed: ";".join(t for _, t in sorted(closed))
        for size in (1, 2, 3, 7, 40):
            total = None
            closed = []
            for low in range(0, int(whole.ends[-1]), size):
                f, more = A.Stretch(aligner, 0, " " + text).fragment(low, min(low + size, int(whole.ends[-1])))
                closed += more
                if total is not None:
                    f, between = A.compose(total, f)
                    closed += [(between[0], between[1].text())] if between else []
                total = f
            assert total == want and text_of(closed) == text_of(groups)


def odd_texts():
    rnd = random.Random(12)
    words = ["the", "Wörter", "naïve", "x1", "日本語", "a,b", "it's", "(end)", "zzzzqqq", "🙂🙃"]
    some = lambda n, gap=" ": gap.join(rnd.choice(words) for _ in range(n))
    return ["", "a", " ", "two words", "two words", "a▁b and the rest", "tabs\tand  spaces \n here ", "\n\nlines\n\nof text\n", "<|endoftext|><s> x",
            some(700), some(300, "\n"), "q" * 9_000, some(200, "") + " " + some(50), "日本語" * 2_000, some(900) + "▁", " " * 3_000 + "x", some(40, "\t")]


@pytest.mark.parametrize("more", [{}, {"long": 500, "piece": 300, "size": 64, "fan": 2}, {"long": 900, "piece": 2_000, "size": 7, "fan": 3, "max_pairs": 0}])
def test_odd_rows_against_brute_force(spark, libraries, more):
    texts = odd_texts()
    rows = [(i, t, "n", 3) for i, t in enumerate(texts)] + [(len(texts), None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int").repartition(3)
    got = rows_of(A.align_documents(docs, A_PATH, B_PATH, **more))
    want = brute([*texts, ""], libraries)
    assert got == dict(enumerate(want))


def test_repeated_and_null_ids_and_empty_table(spark, libraries):
    rows = [(1, "same text twice"), (1, "same text twice"), (None, "no id " * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in A.align_documents(docs, A_PATH, B_PATH, long=1_000).select(*A.COUNTS, "groups_sha256").collect())
    assert got == sorted(brute([t for _, t in rows], libraries))
    assert A.align_documents(docs.limit(0), A_PATH, B_PATH).count() == 0


def test_query_against_brute_force(spark, libraries):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = rows_of(queries.QUERIES["op12_token_alignment"](spark, SF))
    assert got == dict(zip(docs, brute(list(docs.values()), libraries)))
