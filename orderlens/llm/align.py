"""Alignment of two tokenizers' tokens of the same bytes, and corpus-wide counts of linked ids.

A text is taken with a space before it.  Byte offsets where a token of A and one of B both end cut the
tokens into groups; tokens whose byte ranges overlap are linked.

*Fragments.*  What a byte range knows is a fragment: an open prefix (tokens up to the first common end in
the range), closed groups, and an open suffix (tokens after the last one); without a common end all is
open.  Tokens belong to the range in which they end.  Two neighbouring fragments compose into one: the
suffix of the left and the prefix of the right close a group.  Composing is associative, so a very long
document is dealt to tasks: stretches of it are encoded apart, their tokens are cut into byte ranges of
``RANGE`` bytes wherever those fall, and the ranges are composed by a tree of ``FAN`` at a node.  Closed
groups leave as rows of their own; what climbs the tree is two open ends.

*Units.*  Both tokenizers start anew before a space that stands between two other characters, and around
runs of new lines.  Texts fall into units there, which are encoded apart with the same result; any other
white space stays inside a unit.  A worker keeps units it has met lately, at most about ``CACHE``.

*Counts.*  A task encodes and aligns its documents once, and writes them in chunks: what is known of each document, its
units by number, and the linked pairs of each unit.  Chunks give the links by id pair, which Spark sums; the pairs with their counts, and whether a pair
is its B id's highest, are sent to the tasks, which read the chunks again, while they are at most ``MAX_PAIRS``, which is checked.  Beyond it
the documents' pairs are joined with them, with the same result.

Defined results: a null or empty text, and one whose tokens' joined bytes are not the space and the text
(as with U+2581, which B reads as a space), has no tokens: zeros and an empty ``groups_sha256``, and nothing of
it is counted; texts of any length are aligned whole; rows repeated whole, and ids that are tied or null, give a
row each and count each; a B id whose pairs tie has several highest ones; an empty table gives no rows;
only ``keep`` columns and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import copy
import gc
import hashlib
import json
import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sentencepiece_bpe
from .common import discard, written

#: Characters from which a document is dealt to tasks, bytes of the stretches that are encoded apart and of the
#: ranges that make a fragment, and fragments that are composed at a node.
LONG, PIECE, RANGE, FAN = 32_768, 65_536, 16_384, 32
#: Units that a worker keeps, documents handled at a time, and units aligned at a time.
CACHE, ROWS, AT_ONCE = 250_000, 128, 20_000
#: Id pairs that are sent to the tasks: 17 bytes each, 51 MB at most.
MAX_PAIRS = 3_000_000

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


# ---- units ---------------------------------------------------------------------------------------

PLAIN = re.compile(r" ?\S+|\n+\S*")
#: White space for which the plain rule does not hold.
OTHER = re.compile(r"[^\S \n]|  | \n| \Z")
#: Where even then both tokenizers start anew.
ANYHOW = re.compile(r"(?<=\S)(?= \S)")


def units_of(text: str, before: str = " ") -> list[str]:
    """Units of a text with its space before it, or of a stretch that begins and ends where units do."""
    spaced = before + text
    return ANYHOW.split(spaced) if OTHER.search(spaced) else PLAIN.findall(spaced)


# ---- fragments -----------------------------------------------------------------------------------

@dataclass
class Tokens:
    """Neighbouring tokens of both kinds: ids and byte offsets of their ends."""
    a: list = field(default_factory=list)
    a_end: list = field(default_factory=list)
    b: list = field(default_factory=list)
    b_end: list = field(default_factory=list)

    def __add__(self, other: "Tokens") -> "Tokens":
        return Tokens(self.a + other.a, self.a_end + other.a_end, self.b + other.b, self.b_end + other.b_end)

    def text(self) -> str:
        return ",".join(map(str, self.a)) + "|" + ",".join(map(str, self.b))


@dataclass
class Fragment:
    """A byte range's open ends.  ``first`` and ``last`` are its first and last common ends (-1: none, and all
    tokens are in ``prefix``)."""
    first: int
    last: int
    prefix: Tokens
    suffix: Tokens

    def pack(self) -> bytes:
        lists = [getattr(t, c) for t in (self.prefix, self.suffix) for c in ("a", "a_end", "b", "b_end")]
        return np.array([self.first, self.last, *map(len, lists), *(x for values in lists for x in values)], np.int64).tobytes()

    @staticmethod
    def unpack(data: bytes) -> "Fragment":
        x = np.frombuffer(data, np.int64).tolist()
        at, lists = 10, []
        for n in x[2:10]:
            lists.append(x[at:at + n])
            at += n
        return Fragment(x[0], x[1], Tokens(*lists[:4]), Tokens(*lists[4:]))


EMPTY = Fragment(-1, -1, Tokens(), Tokens())


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of two neighbouring ranges, and the group that they close (where it starts, its tokens)."""
    if x.first < 0:
        return Fragment(y.first, y.last, x.prefix + y.prefix, y.suffix), None
    if y.first < 0:
        return Fragment(x.first, x.last, x.prefix, x.suffix + y.prefix), None
    between = x.suffix + y.prefix
    # both may know the same common end: then nothing lies between
    return Fragment(x.first, y.last, x.prefix, y.suffix), (x.last, between) if between.a else None


def fragment_of(t: Tokens, start: int | None = None) -> tuple[Fragment, list[tuple[int, Tokens]]]:
    """The fragment of a range's tokens, and its closed groups.  ``start``: where its tokens begin, if that is a
    common end."""
    cuts = sorted(set(t.a_end).intersection(t.b_end))
    if start is not None:
        cuts = [start, *cuts]
    if not cuts:
        return Fragment(-1, -1, t, Tokens()), []
    i = np.searchsorted(t.a_end, cuts, "right").tolist()
    j = np.searchsorted(t.b_end, cuts, "right").tolist()
    part = lambda i0, i1, j0, j1: Tokens(t.a[i0:i1], t.a_end[i0:i1], t.b[j0:j1], t.b_end[j0:j1])
    groups = [(cuts[k], part(i[k], i[k + 1], j[k], j[k + 1])) for k in range(len(cuts) - 1)]
    return Fragment(cuts[0], cuts[-1], part(0, i[0], 0, j[0]), part(i[-1], len(t.a), j[-1], len(t.b))), groups


# ---- tokenizers ----------------------------------------------------------------------------------

def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte that prints as itself, and the others, in order, from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers (bytes of their files), the bytes of their tokens, and units met lately."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tokenizers
        kind = json.loads(a_file)
        if kind.get("normalizer") or (kind.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or kind["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("A must be a byte-level tokenizer without normaliser that adds no space")
        self.a = tokenizers.Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        letters = byte_of_letter()
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b_model = sentencepiece_bpe.Model(b_file)
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_size[i] = len(t)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace(sentencepiece_bpe.SPACE, " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.reset()

    def reset(self) -> None:
        self.row: dict[str, int] = {}  # unit -> its row
        self.texts: list[str] = []
        self.good = np.empty(0, bool)
        self.stats = np.empty((0, 3), np.int64)  # tokens of A, of B, groups
        self.pairs = np.empty(0, np.int64)
        self.ends = np.zeros(1, np.int64)  # a unit's pairs end here
        self.scored_by = None

    def encode(self, units: list[str]) -> list[tuple[list[int], list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        plain = [u[0] == " " and len(u) > 1 for u in units]
        b = iter(self.b.encode([u[1:] for u, p in zip(units, plain) if p], num_threads=1))  # which adds the space
        model = self.b_model
        return [(x, next(b) if p else [i for s in sentencepiece_bpe.STRETCH.findall(u.replace(sentencepiece_bpe.SPACE, " "))
                                       for i in memoryview(model.stretches[s]).cast("I")])
                for u, p, x in zip(units, plain, a)]

    def walk(self, a: list[int], b: list[int]) -> list[int]:
        """Linked id pairs of tokens whose bytes are the same."""
        a_bytes, b_bytes, pairs = self.a_bytes, self.b_bytes, []
        i = j = 0
        ahead = len(a_bytes[a[0]]) - len(b_bytes[b[0]]) if a else 0  # end of token i less that of token j
        while i < len(a):
            pairs.append(a[i] << 32 | b[j])
            step = ahead
            if step <= 0:
                i += 1
                if i < len(a):
                    ahead += len(a_bytes[a[i]])
            if step >= 0:
                j += 1
                if j < len(b):
                    ahead -= len(b_bytes[b[j]])
        return pairs

    def learn(self, units: list[str]) -> None:
        """Rows for units that have none.  All are aligned at once, in offsets of their joined bytes: between two
        neighbouring token ends of either kind lie one token of A and one of B, which is a link."""
        encoded = self.encode(units)
        good = self._lossless(units, encoded)
        known = [x if ok else ([], []) for ok, x in zip(good.tolist(), encoded)]
        n_a, n_b = (np.array([len(x[i]) for x in known], np.int64) for i in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(x[i] for x in known), np.int64, int(n.sum())) for i, n in ((0, n_a), (1, n_b)))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")  # two rising runs
        again = np.diff(both, prepend=-1) == 0  # an end of both
        ends, common = both[~again], both[again]
        pairs = a[np.searchsorted(a_end, ends)] << 32 | b[np.searchsorted(b_end, ends)] if len(ends) else np.empty(0, np.int64)
        a_upto, b_upto = np.cumsum(n_a), np.cumsum(n_b)
        unit_end = np.concatenate([[0], a_end])[a_upto]  # where each unit's bytes end
        upto = lambda x: np.searchsorted(x, unit_end, "right")
        groups = np.diff(upto(common), prepend=0)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        i = np.searchsorted(a_end, common, "right").tolist()
        j = np.searchsorted(b_end, common, "right").tolist()
        texts = [",".join(a_text[i0:i1]) + "|" + ",".join(b_text[j0:j1]) for i0, i1, j0, j1 in zip([0, *i], i, [0, *j], j)]
        self.row.update(zip(units, range(len(self.texts), len(self.texts) + len(units))))
        self.texts += [texts[j - 1] if n == 1 else ";".join(texts[j - n:j]) for j, n in zip(np.cumsum(groups).tolist(), groups.tolist())]
        self._add(good, np.column_stack([n_a, n_b, groups]), pairs, np.diff(upto(ends), prepend=0))

    def _lossless(self, units: list[str], encoded: list) -> np.ndarray:
        """Whether the bytes of a unit's tokens, of A and of B, are the unit's."""
        raws = [u.encode() for u in units]
        whole, size = b"".join(raws), np.array(list(map(len, raws)))
        same = True
        for i, (table, sizes) in enumerate(((self.a_bytes, self.a_size), (self.b_bytes, self.b_size))):
            ids = list(chain.from_iterable(x[i] for x in encoded))
            upto = np.concatenate([[0], np.cumsum(sizes[ids])])[np.cumsum([len(x[i]) for x in encoded])] if ids else np.zeros(len(units), np.int64)
            same = same and b"".join(map(table.__getitem__, ids)) == whole and (upto == np.cumsum(size)).all()
        if same:  # as a rule
            return np.ones(len(units), bool)
        joined = lambda table, i: [b"".join(map(table.__getitem__, x[i])) for x in encoded]
        return np.array([u == x == y for u, x, y in zip(raws, joined(self.a_bytes, 0), joined(self.b_bytes, 1))], bool)

    def learn_groups(self, groups: list[str]) -> None:
        """As ``learn``, of groups by their texts."""
        stats, pairs, sizes = [], [], []
        for g in groups:
            a, b = ([int(i) for i in ids.split(",")] for ids in g.split("|"))
            self.row[g] = len(self.texts)
            self.texts.append(g)
            linked = self.walk(a, b)
            stats.append((len(a), len(b), 1))
            pairs += linked
            sizes.append(len(linked))
        self._add(np.ones(len(stats), bool), np.array(stats, np.int64).reshape(-1, 3), np.array(pairs, np.int64), np.array(sizes, np.int64))

    def _add(self, good, stats, pairs, sizes) -> None:
        self.good = np.concatenate([self.good, good])
        self.stats = np.concatenate([self.stats, stats])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def rows(self, lists: list[list[str]], groups: bool = False) -> list[np.ndarray]:
        """The rows of lists of units (or of groups)."""
        unknown = set().union(*lists).difference(self.row)
        unknown = list(unknown)
        for i in range(0, len(unknown), AT_ONCE):
            (self.learn_groups if groups else self.learn)(unknown[i:i + AT_ONCE])
        get = self.row.__getitem__
        return [np.fromiter(map(get, units), np.int64, len(units)) for units in lists]

    def taken(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pairs of the rows one after another, how many each has)."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum(sizes)
        return self.pairs[np.repeat(self.ends[rows] - ends + sizes, sizes) + np.arange(int(sizes.sum()))], sizes

    def scores(self, table) -> np.ndarray:
        """Of every row: tokens of A and B, groups, links, links that are the highest, sum of the links' counts
        (the last two 0 if ``table`` has no pairs)."""
        name, keys, n, best = table
        if self.scored_by != name:
            self.scored_by, self.scored = name, np.empty((0, 6), np.int64)
        done = len(self.scored)
        if done < len(self.texts) and not len(keys):
            more = np.column_stack([self.stats[done:], np.diff(self.ends[done:]), np.zeros((len(self.texts) - done, 2), np.int64)])
            self.scored = np.concatenate([self.scored, more])
        elif done < len(self.texts):
            at = np.searchsorted(keys, self.pairs[self.ends[done]:])
            ends = self.ends[done:] - self.ends[done]
            total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[ends])
            more = np.column_stack([self.stats[done:], np.diff(ends), total(best[at].astype(np.int64)), total(n[at])])
            self.scored = np.concatenate([self.scored, more])
        return self.scored


_ALIGNERS: dict[str, dict[str, Aligner]] = {}


def _aligner(files: tuple[bytes, bytes], use: str) -> Aligner:
    """The worker's aligner: one for units, one for groups, one for stretches of long documents."""
    key = hashlib.sha256(files[0] + files[1]).hexdigest()
    held = _ALIGNERS.setdefault(key, {})
    if use not in held:  # the tables of the vocabularies are shared
        held[use] = copy.copy(next(iter(held.values()))) if held else Aligner(*files)
        held[use].reset()
    if len(held[use].row) > CACHE:
        held[use].reset()
    return held[use]


# ---- very long documents -------------------------------------------------------------------------

def _pieces(long: DataFrame, piece: int) -> DataFrame:
    """(rid, at, text) of stretches of about ``piece`` bytes that begin and end where units do."""
    def cut(batches):
        import pyarrow as pa
        for b in batches:
            for rid, text in zip(*(b.column(i).to_pylist() for i in range(2))):
                at, held, size = 0, [], 0
                for u in units_of(text):
                    held.append(u)
                    size += len(u.encode())
                    if size >= piece:
                        yield pa.RecordBatch.from_pydict({"rid": [rid], "at": [at], "text": ["".join(held)]})
                        at, held, size = at + size, [], 0
                if held:
                    yield pa.RecordBatch.from_pydict({"rid": [rid], "at": [at], "text": ["".join(held)]})

    return long.select("rid", "text").mapInArrow(cut, "rid long, at long, text string")


#: A row is the fragment of a node (``packed``), or a text of closed groups that starts at ``at``.
NODE = "rid long, node long, at long, packed binary, groups string, good boolean"


def _batch(rows: list[tuple]):
    import pyarrow as pa
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["rid", "node", "at", "packed", "groups", "good"])


class Stretch:
    """A stretch of a document from offset ``at`` on: its units, their rows, and where each ends."""

    def __init__(self, a: Aligner, at: int, text: str):
        self.a, self.at, self.units = a, at, units_of(text, "")
        self.rows = a.rows([self.units])[0]
        self.good = bool(a.good[self.rows].all())
        self.ends = at + np.cumsum([len(u.encode()) for u in self.units])
        self.starts = np.concatenate([[at], self.ends[:-1]])
        self.cut: dict[int, Tokens] = {}  # tokens of units that a range cuts

    def tokens(self, unit: int, low: int, high: int) -> Tokens:
        """Tokens of a unit that end in (low, high]."""
        if unit not in self.cut:
            (x, y), begin = self.a.encode([self.units[unit]])[0], self.starts[unit]
            self.cut[unit] = Tokens(x, (begin + np.cumsum(self.a.a_size[x])).tolist(), y, (begin + np.cumsum(self.a.b_size[y])).tolist())
        t = self.cut[unit]
        (i, j), (k, m) = (np.searchsorted(e, [low, high], "right").tolist() for e in (t.a_end, t.b_end))
        return Tokens(t.a[i:j], t.a_end[i:j], t.b[k:m], t.b_end[k:m])

    def fragment(self, low: int, high: int) -> tuple[Fragment, list[tuple[int, str]]]:
        """The fragment of what ends in (low, high], and its closed groups as (start, text): units that lie inside are
        closed, a unit that an edge cuts gives its tokens."""
        first = int(np.searchsorted(self.starts, low))          # units from here on begin in the range
        last = int(np.searchsorted(self.ends, high, "right"))   # and up to here end in it
        parts: list[tuple[Fragment, list]] = []
        if first and self.ends[first - 1] > low:
            f, groups = fragment_of(self.tokens(first - 1, low, high))
            parts.append((f, [(i, t.text()) for i, t in groups]))
        if first < last:
            begin, end = int(self.starts[first]), int(self.ends[last - 1])
            text = ";".join(map(self.a.texts.__getitem__, self.rows[first:last].tolist()))
            parts.append((Fragment(begin, end, Tokens(), Tokens()), [(begin, text)]))
        cut = max(last, first)
        if cut < len(self.units) and self.starts[cut] < high:
            f, groups = fragment_of(self.tokens(cut, low, high), int(self.starts[cut]))
            parts.append((f, [(i, t.text()) for i, t in groups]))
        whole, closed = parts[0] if parts else (EMPTY, [])
        for f, groups in parts[1:]:
            whole, between = compose(whole, f)
            closed = closed + ([(between[0], between[1].text())] if between else []) + groups
        return whole, closed


def _leaves(pieces: DataFrame, files, size: int) -> DataFrame:
    """Fragments of byte ranges (``node`` is the range's number), and their closed groups."""
    def leaf(batches):
        for b in batches:
            for rid, at, text in zip(*(b.column(i) for i in range(3))):
                gc.disable()
                rid, at = rid.as_py(), at.as_py()
                part = Stretch(_aligner(files.value, "units"), at, text.as_py())
                out = [] if part.good else [(rid, at // size, at, None, None, False)]
                end = int(part.ends[-1])
                for node in range(at // size, (end - 1) // size + 1) if part.good else ():
                    low, high = max(at, node * size), min(end, (node + 1) * size)
                    f, closed = part.fragment(low, high)
                    out.append((rid, node, low, f.pack(), None, True))
                    out += [(rid, node, i, None, text, True) for i, text in closed]
                gc.enable()
                yield _batch(out)

    return pieces.repartition("rid", "at").mapInArrow(leaf, NODE)


def _composed(fragments: DataFrame, fan: int) -> DataFrame:
    """One level of the tree: fragments in order, ``fan`` nodes to one; and the groups that close."""
    def up(batches):
        held = None  # (rid, node, at, fragment)
        for b in batches:
            out = []
            for rid, node, at, packed in zip(*(b.column(i).to_pylist() for i in range(4))):
                y = Fragment.unpack(packed)
                if held is None or held[:2] != (rid, node):
                    if held is not None:
                        out.append((*held[:3], held[3].pack(), None, True))
                    held = (rid, node, at, y)
                    continue
                f, closed = compose(held[3], y)
                held = (*held[:3], f)
                if closed is not None:
                    out.append((rid, node, closed[0], None, closed[1].text(), True))
            if out:
                yield _batch(out)
        if held is not None:
            yield _batch([(*held[:3], held[3].pack(), None, True)])

    return (fragments.select("rid", F.expr(f"node div {fan}").alias("node"), "at", "packed")
            .repartition("rid", "node").sortWithinPartitions("rid", "node", "at").mapInArrow(up, NODE))


def _long_groups(long: DataFrame, files, piece: int, size: int, fan: int) -> DataFrame:
    """(rid, at, groups) of the documents of ``long`` (rid, text): texts of closed groups by where they start.
    Every level of the tree is written, so a lost executor repeats one level only."""
    leaves = written(_leaves(_pieces(long, piece), files, size), "leaves")
    bad = leaves.filter(~F.col("good")).select("rid").distinct()
    good = leaves.join(bad, "rid", "left_anti")
    closed, levels = [good.filter("groups is not null").select("rid", "at", "groups")], []
    level = good.filter("packed is not null")
    top = level.agg(F.max("node")).first()[0] or 0
    while True:
        levels.append(written(_composed(level, fan), "composed"))
        closed.append(levels[-1].filter("groups is not null").select("rid", "at", "groups"))
        level = levels[-1].filter("packed is not null")
        top //= fan
        if not top:  # a document is one fragment, which begins and ends with a common end: all groups are closed
            break
    out = written(_union(closed), "groups")
    discard(leaves, *levels)
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---- counts and results --------------------------------------------------------------------------

def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, sum of n of each), exact in integers."""
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, n)
    return keys, out


def _slices(batches, key: int, groups: bool):
    """(rows of the batch, lists of units or groups), some rows at a time."""
    with _without_cycles():
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                texts = part.column(key).to_pylist()
                yield part, [t.split(";") if groups else units_of(t) if t else [] for t in texts]


@contextmanager
def _without_cycles():
    """Without the search for cycles: there are none here, and it walks through all units that are known."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def packed(x) -> bytes:
    """Compressed here, as large cells are a burden to the executor's heap."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(x if isinstance(x, bytes) else x.tobytes())


def unpacked(cell, kind=np.int64) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_buffer()), kind)


#: A chunk of documents, each cell compressed: Arrow bytes of the kept columns, the digests and what is counted without the corpus; the units
#: of each document by number (``units``, up to ``unit_ends``); the pairs of each unit (``pairs``, up to ``pair_ends``).
CHUNK = "docs binary, units binary, unit_ends binary, pairs binary, pair_ends binary"


def _chunks(docs: DataFrame, keep: list[str], files) -> DataFrame:
    """Documents (kept columns, text) that one task aligns, in chunks."""
    n = len(keep)

    def of(batches):
        import pyarrow as pa
        for part, lists in _slices(batches, n, False):
            a = _aligner(files.value, "units")
            found = [rows if len(rows) and a.good[rows].all() else rows[:0] for rows in a.rows(lists)]
            sizes = np.array([len(rows) for rows in found], np.int64)
            used, unit = np.unique(np.concatenate([*found, np.empty(0, np.int64)]), return_inverse=True)
            pairs, linked = a.taken(used)
            stats = np.column_stack([a.stats[used], linked])  # tokens of A and B, groups, links
            ends = np.concatenate([[0], np.cumsum(sizes)])
            counts = np.diff(np.vstack([np.zeros((1, 4), np.int64), np.cumsum(stats[unit], axis=0)])[ends], axis=0)
            shas = [hashlib.sha256(";".join(map(a.texts.__getitem__, rows.tolist())).encode()).hexdigest() if len(rows) else "" for rows in found]
            known = pa.RecordBatch.from_arrays([*part.columns[:n], *(pa.array(counts[:, i]) for i in range(4)), pa.array(shas, pa.string())],
                                               names=[*(f"k{i}" for i in range(n)), *COUNTS[:4], "groups_sha256"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, known.schema) as stream:
                stream.write_batch(known)
            cells = [packed(x) for x in (sink.getvalue().to_pybytes(), unit.astype(np.int32), ends[1:], pairs, np.cumsum(linked))]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["docs", "units", "unit_ends", "pairs", "pair_ends"])

    return docs.mapInArrow(of, CHUNK)


def _chunk_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n) of each chunk: links by id pair."""
    def of(batches):
        import pyarrow as pa
        for b in batches:
            for units, pairs, pair_ends in zip(*(b.column(i) for i in range(3))):
                pairs, ends = unpacked(pairs), unpacked(pair_ends)
                times = np.bincount(unpacked(units, np.int32), minlength=len(ends))
                keys, n = summed(pairs, np.repeat(times, np.diff(ends, prepend=0)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    return chunks.select("units", "pairs", "pair_ends").mapInArrow(of, "pair long, n long")


def _group_counts(groups: DataFrame, files) -> DataFrame:
    """(pair, n) of texts of groups."""
    def of(batches):
        import pyarrow as pa
        for _, lists in _slices(batches, 0, True):
            a = _aligner(files.value, "groups")
            pairs, _ = a.taken(np.concatenate(a.rows(lists, True)))
            keys, n = summed(pairs, np.ones(len(pairs), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    return groups.select("groups").mapInArrow(of, "pair long, n long")


def _short_results(chunks: DataFrame, kinds: list, table) -> DataFrame:
    """``_rid``, the kept columns ``k0, k1, ...`` of the types ``kinds``, and the results of the documents of chunks;
    scores are 0 where ``table`` has no pairs."""
    n = len(kinds)

    def of(batches):
        import pyarrow as pa
        _, keys, count, best = table.value
        for b in batches:
            for chunk, docs, units, unit_ends, pairs, pair_ends in zip(*(b.column(i) for i in range(6))):
                known = pa.ipc.open_stream(unpacked(docs, np.uint8)).read_next_batch()
                units, ends = unpacked(units, np.int32), np.concatenate([[0], unpacked(unit_ends)])
                scores = [np.zeros(len(ends) - 1, np.int64)] * 2
                if len(keys):
                    at = np.searchsorted(keys, unpacked(pairs))
                    of_unit = np.concatenate([[0], unpacked(pair_ends)])
                    sums = lambda v, e: np.diff(np.concatenate([[0], np.cumsum(v)])[e])
                    scores = [sums(sums(v[at].astype(np.int64), of_unit)[units], ends) for v in (best, count)]
                rid = (chunk.as_py() << 20) + np.arange(known.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(rid), *known.columns[:n + 4], *map(pa.array, scores), known.column(n + 4)],
                                                 names=["_rid", *known.schema.names[:n + 4], *COUNTS[4:], "groups_sha256"])

    fields = ["_rid long", *(f"k{i} {t}" for i, t in enumerate(kinds)), *(f"{c} long" for c in COUNTS), "groups_sha256 string"]
    return chunks.select("chunk", *(c.split()[0] for c in CHUNK.split(", "))).mapInArrow(of, ", ".join(fields))


def _chunk_pairs(chunks: DataFrame) -> DataFrame:
    """(rid, pair, m): how often a document links a pair."""
    def of(batches):
        import pyarrow as pa
        for b in batches:
            for chunk, units, unit_ends, pairs, pair_ends in zip(*(b.column(i) for i in range(5))):
                units, pairs, of_unit = unpacked(units, np.int32), unpacked(pairs), np.concatenate([[0], unpacked(pair_ends)])
                start = 0
                for k, end in enumerate(unpacked(unit_ends).tolist()):
                    if end > start:
                        unit, times = np.unique(units[start:end], return_counts=True)
                        keys, m = summed(np.concatenate([pairs[of_unit[u]:of_unit[u + 1]] for u in unit.tolist()]), np.repeat(times, np.diff(of_unit)[unit]))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), (chunk.as_py() << 20) + k)), pa.array(keys), pa.array(m)], names=["rid", "pair", "m"])
                    start = end

    return chunks.select("chunk", "units", "unit_ends", "pairs", "pair_ends").mapInArrow(of, "rid long, pair long, m long")


def _long_results(groups: DataFrame, files, table) -> DataFrame:
    """(rid, counts, digest) of documents whose groups lie in several rows, read in order."""
    def of(batches):
        import pyarrow as pa

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now]), *(pa.array([int(x)]) for x in sums), pa.array([sha.hexdigest()])],
                                              names=["rid", *COUNTS, "groups_sha256"])

        now = sums = sha = None
        for part, lists in _slices(batches, 2, True):
            a = _aligner(files.value, "groups")
            found = a.rows(lists, True)
            scores = a.scores(table.value)
            for rid, text, rows in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), found):
                if rid != now:
                    if now is not None:
                        yield row()
                    now, sums, sha = rid, np.zeros(6, np.int64), hashlib.sha256()
                else:
                    text = ";" + text
                sums += scores[rows].sum(0)
                sha.update(text.encode())
        if now is not None:
            yield row()

    ordered = groups.select("rid", "at", "groups").repartition("rid").sortWithinPartitions("rid", "at")
    return ordered.mapInArrow(of, ", ".join(["rid long", *(f"{c} long" for c in COUNTS), "groups_sha256 string"]))


def _group_pairs(groups: DataFrame, files) -> DataFrame:
    """(rid, pair, m) of texts of groups."""
    def of(batches):
        import pyarrow as pa
        for part, lists in _slices(batches, 1, True):
            a = _aligner(files.value, "groups")
            for rid, rows in zip(part.column(0).to_pylist(), a.rows(lists, True)):
                pairs, _ = a.taken(rows)
                keys, m = summed(pairs, np.ones(len(pairs), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), rid)), pa.array(keys), pa.array(m)], names=["rid", "pair", "m"])

    return groups.select("rid", "groups").mapInArrow(of, "rid long, pair long, m long")


def _joined_scores(linked: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rid, n_best, count_sum) of documents' pairs (rid, pair, m) by a join."""
    return (linked.join(pairs, "pair").groupBy("rid")
            .agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum")))


def align_documents(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                    long: int = LONG, piece: int = PIECE, size: int = RANGE, fan: int = FAN, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``keep`` columns, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    spark = docs.sparkSession
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))  # as large as the vocabularies, whatever the corpus
    keep = list(keep)
    source = docs.select(*keep, F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    short = source.filter(F.length("_text") <= long)
    # written, so the numbers stay
    far = written(source.filter(F.length("_text") > long).withColumn("_rid", F.monotonically_increasing_id()), "long")
    groups = _long_groups(far.select(F.col("_rid").alias("rid"), F.col("_text").alias("text")), files, piece, size, fan)
    kinds = [f.dataType.simpleString() for f in docs.select(*keep).schema.fields]
    chunks = written(_chunks(short, keep, files).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    counted = _chunk_counts(chunks).unionByName(_group_counts(groups, files))
    pairs = written(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pairs").withColumn("b", F.expr("pair & 4294967295"))
    highest = pairs.groupBy("b").agg(F.max("n").alias("most"))
    pairs = written(pairs.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs-best")
    named = lambda df: df.toDF("_rid", *(f"_keep_{c}" for c in keep), *COUNTS, "groups_sha256")
    if pairs.count() > max_pairs:
        empty = spark.sparkContext.broadcast((uuid.uuid4().hex, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)))
        near = named(_short_results(chunks, kinds, empty)).drop("n_best", "count_sum")
        scores = _joined_scores(_chunk_pairs(chunks), pairs).withColumnRenamed("rid", "_rid")
        near = _selected(near.join(scores, "_rid", "left"), keep)
        return near.unionByName(_completed(far, keep, _long_results(groups, files, empty), _joined_scores(_group_pairs(groups, files), pairs)))
    found = pairs.toArrow()
    order = np.argsort(found["pair"].to_numpy())
    table = spark.sparkContext.broadcast((uuid.uuid4().hex, *(found[c].to_numpy()[order] for c in ("pair", "n", "best"))))
    return _selected(named(_short_results(chunks, kinds, table)), keep).unionByName(_completed(far, keep, _long_results(groups, files, table)))


def _selected(out: DataFrame, keep: list[str]) -> DataFrame:
    return out.select(*(F.col(f"_keep_{c}").alias(c) for c in keep), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def _completed(rows: DataFrame, keep: list[str], counts: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Results by row number (the first column of ``counts`` and ``scores``) given to all ``rows``."""
    counts = counts.withColumnRenamed(counts.columns[0], "_rid")
    if scores is not None:
        counts = counts.drop("n_best", "count_sum").join(scores.withColumnRenamed("rid", "_rid"), "_rid", "left")
    return _selected(rows.select("_rid", *(F.col(c).alias(f"_keep_{c}") for c in keep)).join(counts, "_rid", "left"), keep)
