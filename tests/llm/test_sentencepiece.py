import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from orderlens.llm import queries, sentencepiece_bpe as B

SF = "/root/testdata/sf0.01"
PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return B.Model(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(model, library, text):
    want = library.encode(text, add_bos=True, add_eos=True)
    assert model.encode(text) == want, text
    assert model.decode(want) == library.decode(want), text


def test_odd_texts(model, library):
    for t in ["", " ", "  a  b ", "héllo\nworld\t x", "①ﬁ", "<s>a</s>", "\x00a", "a▁b", "▁", "日本語 𝒳", "aaaa" * 300, " " * 50 + "x",
              "\n\n \n", "<0x41>", "é́ñ", "...com,\"and\"", "_" * 77, "x" * 20000, "🙂🙃" * 9]:
        same(model, library, t)


def test_random_texts(model, library):
    rnd = random.Random(1)
    pool = "aabbcc theingeston  \n\t▁ééßñ日本語𝒳\x00<>/s0123__.,!?'\"-"
    pieces = list(model.id)
    for _ in range(6000):
        same(model, library, "".join(rnd.choice(pool) for _ in range(rnd.choice([1, 2, 3, 5, 8, 13, 40]))))
        same(model, library, "".join(rnd.choice(pieces).replace(B.SPACE, " ") for _ in range(rnd.choice([1, 2, 3, 6]))))


def test_backtracking_equals_merging(model):
    rnd = random.Random(4)
    pieces = [p for p in model.id if len(p) > 1]
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(3))
        assert model.backtracked(text) == model.merged(text)


def test_query_equals_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op9_sentencepiece"](spark, SF).collect()}
    for i, t in docs.items():
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert got.keys() == docs.keys()


def test_odd_rows(spark, library):
    rows = [(1, None, "a", 5), (1, None, "a", 5), (None, "", "b", 6), (2, "two words", None, None), (3, "w" * 100_000, "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")
    got = B.encode_documents(docs, PATH, tokens=True).collect()
    assert len(got) == 5
    for r in got:
        text = {1: "", None: "", 2: "two words", 3: "w" * 100_000}[r.doc_id]
        assert list(r.ids) == library.encode(text, add_bos=True, add_eos=True) and r.decoded == text and r.n_tokens == len(r.ids)
    assert B.encode_documents(docs.limit(0), PATH).count() == 0
