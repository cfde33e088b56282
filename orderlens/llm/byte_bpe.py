"""Exact byte-level BPE encoding from merge ranks, and decoding.

A text is cut into pre-tokens by the tokenizer's pattern; each is encoded on its own.  A pre-token that
is a token is done.  Any other starts as a linked list of its bytes; those that some texts bring anew stand
in one list, with walls between them that no pair crosses.  Every pair of neighbours whose
bytes joined are a token waits in the bucket of that token's rank, by the position of its left part;
a hierarchical bitmap has a bit for each bucket that holds something, so the next rank is found by one
find-first-set a level, however many pairs wait.  A bucket is worked off from left to right.  A merge
only unlinks one node and files the two new pairs; entries whose pair has changed since are stale and
are skipped when met.  Work is thus in proportion to the merges, for a pre-token of millions of bytes as
for a word.  A merge can give a pair of a lower rank than its own: the rest of the bucket then goes back.

A worker keeps pre-tokens that it has met lately, at most about ``2 * CACHE`` short ones, from task to task.  A very long text is
read some pre-tokens at a time.  No shuffle: a row's result comes from the row and the vocabulary.

Defined results: a null or empty text has no tokens (``n_tokens`` 0, digests of the empty string); a
text of any length is encoded whole; rows repeated whole and tied ids give a row each; an empty table
gives no rows; only ``keep`` columns and the text are read, so other columns may have any names, and a
``keep`` column may be called like the text's.  A byte that is no token by itself is an error of the
vocabulary and raises when it is read.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

from pyspark.sql import DataFrame

#: Pre-tokens that a worker keeps in each of two generations, and the longest one that is kept.
CACHE, CACHE_CHARS = 300_000, 32
#: Characters of a text up to which its pre-tokens are listed at once, and pre-tokens listed at a time beyond.
WHOLE, AT_ONCE = 1_000_000, 50_000
#: Texts handled at a time.
ROWS = 256


class Vocabulary:
    """Merge ranks (token bytes -> id), the pre-token pattern, and tables made from them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a token: {missing}")
        if min(ranks.values()) < 0 or len(set(ranks.values())) < len(ranks):
            raise ValueError("ranks must be different and not negative")
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        # the bitmap: words of 2 ** shift bits, and a word that tells which of them have any; all are
        # empty between pre-tokens, so one bitmap serves all
        self.shift = max(1, -(-max(ranks.values()).bit_length() // 2))
        self.words = [0] * ((max(ranks.values()) >> self.shift) + 1)
        self.bits = [1 << i for i in range(max(len(self.words), 1 << self.shift))]
        # by decimal text, in which ids are digested
        self.token = {str(i): t for t, i in ranks.items()}
        self.known: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.passing: list[str] = []  # long pre-tokens, which are not kept

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each of ``pieces`` by applying the lowest merge again and again, leftmost first.

        The pieces stand in one linked list, and no pair crosses from one to the next; what is done to a
        piece does not depend on the others, so one queue serves all."""
        text = b"".join(pieces)
        n, rank, longest = len(text), self.ranks.get, self.longest
        words, bits, shift, low = self.words, self.bits, self.shift, (1 << self.shift) - 1
        begins = [0]
        for p in pieces:
            begins.append(begins[-1] + len(p))
        wall = bytearray(n + 1)  # where a piece starts
        for i in begins:
            wall[i] = 1
        after = list(range(1, n + 1))  # where the next part starts
        before = list(range(-1, n))
        pair = [rank(text[i:i + 2], -1) for i in range(n)]  # rank of a part with the next one
        buckets: dict[int, list[int]] = {}
        for i in begins[1:]:
            if i:
                pair[i - 1] = -1
        for i, r in enumerate(pair):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
        top = 0  # the bitmap's upper level
        for r in buckets:
            words[r >> shift] |= bits[r & low]
            top |= bits[r >> shift]
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            bit = word & -word
            r = w << shift | (bit.bit_length() - 1)
            words[w] = word = word ^ bit
            if not word:
                top ^= bits[w]
            waiting = buckets.pop(r)
            waiting.sort()
            for k, i in enumerate(waiting):
                if pair[i] != r:  # stale
                    continue
                gone = after[i]
                after[i] = end = after[gone]
                before[end] = i
                pair[gone] = pair[i] = -1
                lower = False
                if not wall[end]:
                    stop = after[end]
                    if stop - i <= longest and (q := rank(text[i:stop], -1)) >= 0:
                        pair[i] = q
                        if q in buckets:
                            buckets[q].append(i)
                        else:
                            buckets[q] = [i]
                            words[q >> shift] |= bits[q & low]
                            top |= bits[q >> shift]
                        lower = q < r
                if not wall[i]:
                    left = before[i]
                    if end - left <= longest and (q := rank(text[left:end], -1)) >= 0:
                        pair[left] = q
                        if q in buckets:
                            buckets[q].append(left)
                        else:
                            buckets[q] = [left]
                            words[q >> shift] |= bits[q & low]
                            top |= bits[q >> shift]
                        if q < r:
                            lower = True
                    else:
                        pair[left] = -1
                if lower:  # a merge below this rank comes first: the rest goes back
                    if rest := waiting[k + 1:]:
                        buckets[r] = rest
                        words[r >> shift] |= bits[r & low]
                        top |= bits[r >> shift]
                    break
        out, ranks = [], self.ranks
        for i, stop in zip(begins, begins[1:]):
            ids = []
            while i < stop:
                end = after[i]
                ids.append(ranks[text[i:end]])
                i = end
            out.append(ids)
        return out

    def learn(self, lists: list[list[str]]) -> None:
        """Make ``known`` hold every pre-token of ``lists``.  Short ones stay in two generations of at most about
        ``CACHE`` each: a full one becomes the old one, from which what is met again comes back."""
        known = self.known
        for p in self.passing:
            del known[p]
        self.passing = []
        if len(known) >= CACHE:
            self.old, self.known = known, {}
            known = self.known
        unknown = []
        for p in set().union(*lists).difference(known):
            if (got := self.old.get(p)) is not None:
                known[p] = got
            else:
                unknown.append(p)
                if len(p) > CACHE_CHARS:
                    self.passing.append(p)
        open_ = []
        for p in unknown:
            if (i := self.ranks.get(p.encode())) is not None:  # it is a token
                known[p] = str(i)
            else:
                open_.append(p)
        for p, ids in zip(open_, self.merged([p.encode() for p in open_])):
            known[p] = " ".join(map(str, ids))

    def decimals(self, texts: list[str]):
        """For each text, its ids as decimal texts with a space between, in parts."""
        lists = [self.pattern.findall(t) if len(t) <= WHOLE else None for t in texts]
        self.learn([w for w in lists if w])
        joined = [None if w is None else " ".join(map(self.known.__getitem__, w)) for w in lists]
        for t, ids in zip(texts, joined):
            yield self.parts(t) if ids is None else [ids] if ids else []

    def parts(self, text: str):
        """The ids of a very long text, some pre-tokens at a time."""
        found = self.pattern.finditer(text)
        while some := [m[0] for m in islice(found, AT_ONCE)]:
            self.learn([some])
            yield " ".join(map(self.known.__getitem__, some))

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in next(self.decimals([text])) for i in part.split(" ")]

    def decode(self, ids) -> bytes:
        return b"".join(self.token[str(i)] for i in ids)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a file that has a token in base64 and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(data: bytes, pattern: str) -> Vocabulary:
    """The worker's vocabulary: its tables are built once a process."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(read_ranks(data), pattern)
    return _VOCABULARIES[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                     keep: tuple[str, ...] = ("doc_id",), tokens: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens, ids_sha256`` (of the decimal ids with a space between),
    ``decoded_sha256`` and, with ``tokens``, ``ids array<int>`` and ``decoded binary`` of every row."""
    with open(ranks_path, "rb") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)  # the vocabulary's file: as large as it is, whatever the corpus
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    fields += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    if tokens:
        fields += ["ids array<int>", "decoded binary"]
    keep = list(keep)

    def encode(batches):
        v = vocabulary(shared.value, pattern)
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                yield encoded(v, b.slice(i, ROWS))

    def encoded(v, b):
        import numpy as np
        import pyarrow as pa
        token = v.token.__getitem__
        counts, id_sums, text_sums, all_ids, texts = [], [], [], [], []
        for parts in v.decimals([t or "" for t in b.column(len(keep)).to_pylist()]):
            n, id_sum, text_sum, kept, raw = 0, hashlib.sha256(), hashlib.sha256(), [], []
            for part in parts:
                ids = part.split(" ")
                back = b"".join(map(token, ids))
                id_sum.update((" " + part if n else part).encode())
                text_sum.update(back)
                n += len(ids)
                if tokens:
                    kept.append(np.array(ids, np.int32))
                    raw.append(back)
            counts.append(n)
            id_sums.append(id_sum.hexdigest())
            text_sums.append(text_sum.hexdigest())
            if tokens:
                all_ids.append(np.concatenate(kept) if kept else np.empty(0, np.int32))
                texts.append(b"".join(raw))
        cols = [*b.columns[:len(keep)], pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
        names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
        if tokens:
            cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.binary())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(*keep, docs[text_col].cast("string").alias("_text")).mapInArrow(encode, ", ".join(fields))


def decode_documents(rows: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded binary``: the bytes of each row's ids (null ids: none)."""
    with open(ranks_path, "rb") as f:
        data = f.read()
    shared = rows.sparkSession.sparkContext.broadcast(data)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
    n = len(keep)

    def decode(batches):
        import pyarrow as pa
        v = vocabulary(shared.value, pattern)
        for b in batches:
            out = [v.decode(ids.as_py() or ()) for ids in b.column(n)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(out, pa.binary())], names=[*keep, "decoded"])

    return rows.select(*keep, rows[ids_col].alias("_ids")).mapInArrow(decode, ", ".join([*fields, "decoded binary"]))
