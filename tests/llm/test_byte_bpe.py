import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from orderlens.llm import byte_bpe as B
from orderlens.llm import queries

SF = "/root/testdata/sf0.01"
PATH = queries.byte_bpe_path()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return B.read_ranks(f.read())


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return B.Vocabulary(ranks, PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def naive(piece, ranks):
    """The lowest pair of neighbours, leftmost first, again and again."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_odd_texts(vocabulary, library):
    for t in ["", " ", "  a  b ", "I'll we'RE", "héllo\nworld\t x", "<|endoftext|>", "日本語 𝒳", "aaaa" * 300, " " * 50 + "x", "\n\n \n",
              "\x00\x1c\x85  　a", "1²½ ٣", "🙂🙃" * 9, "_" * 77, "é́ñ"]:
        assert vocabulary.encode(t) == library.encode_ordinary(t), t
        assert vocabulary.decode(vocabulary.encode(t)) == t.encode()


def test_random_texts(vocabulary, library):
    rnd = random.Random(3)
    pool = ["a", "b", "the", " ", "\n", "é", "中", "'s", "1", "😀", "  ", "ing", "x", "\t", "ou", "!", "--"]
    for _ in range(4000):
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60)))
        assert vocabulary.encode(t) == library.encode_ordinary(t), t


def test_every_code_point(vocabulary, library):
    for c in range(0, 0x110000, 11):
        if not 0xD800 <= c < 0xE000:
            t = f"a{chr(c)}b {chr(c)}{chr(c)} x1{chr(c)}! {chr(c)}"
            assert vocabulary.encode(t) == library.encode_ordinary(t), hex(c)


def test_very_long_pre_tokens(vocabulary, library):
    rnd = random.Random(5)
    for t in ["a" * 200_001, "ab" * 60_000, "".join(rnd.choice("abcdefgh") for _ in range(120_000)), "!" * 40_000, "x" + " " * 30_000 + "y"]:
        assert vocabulary.encode(t) == library.encode_ordinary(t)


def test_texts_read_in_parts(vocabulary, library, monkeypatch):
    monkeypatch.setattr(B, "WHOLE", 10)
    monkeypatch.setattr(B, "AT_ONCE", 3)
    t = "Many words, read three at a time: it's 1234  and\n\nso on."
    assert vocabulary.encode(t) == library.encode_ordinary(t)


def test_lower_rank_after_a_merge():
    """'ab' then 'c' gives 'abc', whose rank is below that of 'ab': the rest of the bucket has to wait."""
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bx": 257, b"ab": 300, b"ca": 301, b"cab": 299, b"abcab": 298}
    v = B.Vocabulary(ranks, r"[^ ]+")
    rnd = random.Random(9)
    for _ in range(3000):
        piece = bytes(rnd.choice(b"abcx") for _ in range(rnd.randint(1, 14)))
        assert v.merged([piece, piece[1:]])[0] == naive(piece, ranks), piece
        assert not any(v.words)  # nothing stays for the next one


def test_ranks_of_any_size():
    for top in (256, 70_000, 5_000_000):
        ranks = {bytes([i]): i for i in range(256)} | {b"ab": top, b"abab": top + 9, b"ba": top + 3}
        v = B.Vocabulary(ranks, r".+")
        for piece in (b"ababab", b"bababa", b"aabb", b"a"):
            assert v.merged([piece]) == [naive(piece, ranks)]


def test_kept_pre_tokens_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(B, "CACHE", 5)
    monkeypatch.setattr(B, "CACHE_CHARS", 6)
    v = B.Vocabulary(ranks, PATTERN)
    rnd = random.Random(6)
    for _ in range(300):
        texts = [" ".join(rnd.choice(["zorb", "quxly", "a", "longerwordthanothers", "fnord", "blah9"]) for _ in range(rnd.randint(0, 6))) for _ in range(3)]
        got = [[int(i) for part in parts for i in part.split(" ")] for parts in v.decimals(texts)]
        assert got == [library.encode_ordinary(t) for t in texts]
        assert len(v.known) + len(v.old) < 30


def test_vocabulary_must_hold_every_byte():
    with pytest.raises(ValueError):
        B.Vocabulary({b"a": 0}, ".")


def test_query_equals_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op13_byte_bpe"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        ids = library.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_odd_rows(spark, library):
    rows = [(1, None, "a", 5), (1, None, "a", 5), (None, "", "b", 6), (2, "two words", None, None), (3, "w" * 100_000, "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")
    got = B.encode_documents(docs, PATH, PATTERN, tokens=True)
    assert got.count() == 5
    for r in got.collect():
        text = {1: "", None: "", 2: "two words", 3: "w" * 100_000}[r.doc_id]
        assert list(r.ids) == library.encode_ordinary(text) and bytes(r.decoded) == text.encode() and r.n_tokens == len(r.ids)
    back = B.decode_documents(got, PATH, PATTERN).collect()
    assert sorted(len(r.decoded) for r in back) == [0, 0, 0, 9, 100_000]
    assert B.encode_documents(docs.limit(0), PATH, PATTERN).count() == 0
